"""Packing, ordering and mixing against brute force."""

import hashlib

from pyspark.sql import functions as F

from quarry.operators import mixing, packing
from quarry.plans.ordering import prefix_sum, row_rank


def ids_df(spark, seqs):
    return spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "doc_id long, ids array<int>")


def brute_pack(seqs, block, eos):
    stream = [t for s in seqs for t in s + [eos]]
    n = len(stream) // block
    return [stream[i * block:(i + 1) * block] for i in range(n)]


def packed(spark, seqs, block, eos=999):
    out = packing.pack_tokens(ids_df(spark, seqs), block, eos, n_buckets=3).orderBy("block_id")
    return [(r.block_id, r.tokens) for r in out.collect()]


def test_pack_matches_concatenation(spark):
    seqs = [list(range(i % 7 + 1)) for i in range(50)] + [list(range(40))] + [[]]
    got = packed(spark, seqs, 16)
    want = brute_pack(seqs, 16, 999)
    assert [b for _, b in got] == want
    assert [i for i, _ in got] == list(range(len(want)))


def test_pack_short_and_exact(spark):
    assert packed(spark, [[1, 2, 3]], 8) == []
    assert packed(spark, [[1, 2, 3]], 4) == [(0, [1, 2, 3, 999])]


def test_pack_report(spark):
    df = spark.createDataFrame([(10,), (0,), (5,)], "n_tokens int")
    r = packing.pack_report(df, 4, eos_id=1).first()
    assert (r.n_docs, r.total_tokens, r.n_blocks, r.dropped_tokens) == (3, 18, 4, 2)


def test_prefix_sum_independent_of_buckets(spark):
    df = spark.createDataFrame([(i * 3, i % 5) for i in range(300)], "k long, w long")
    for nb in (1, 4, 17):
        got = {r.k: r.prefix for r in prefix_sum(df, ["k"], F.col("w"), n_buckets=nb).collect()}
        run, want = 0, {}
        for i in range(300):
            want[i * 3] = run
            run += i % 5
        assert got == want


def test_row_rank_partitioned(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(100)], "k long, g string")
    got = {(r.g, r.k): r.rank for r in row_rank(df, ["k"], ["g"], n_buckets=5).collect()}
    for g in "ab":
        ks = sorted(k for (gg, k) in got if gg == g)
        assert [got[(g, k)] for k in ks] == list(range(1, len(ks) + 1))


def brute_mix(sizes, names, probs, seed):
    cuts = mixing.thresholds(probs)
    taken = {n: 0 for n in names}
    out, pos = [], 0
    while True:
        u = int(hashlib.md5(f"{seed}:{pos}".encode()).hexdigest()[:8], 16)
        k = next(i for i, c in enumerate(cuts + [1 << 40]) if u < c)
        k = min(k, len(names) - 1)
        s = names[k]
        taken[s] += 1
        out.append((pos, s, taken[s]))
        if taken[s] == sizes[s]:
            return out
        pos += 1


def test_mix_matches_simulation(spark):
    sizes = {"web": 40, "knowledge": 9, "code": 1}
    rows = [(i * 10 + j, s) for j, s in enumerate(sizes) for i in range(sizes[s])]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = [(r.pos, r.source, r.doc_id) for r in mixing.mix_sources(df).orderBy("pos").collect()]
    want = brute_mix(sizes, mixing.MIX_SOURCES, mixing.MIX_PROBABILITIES, 42)
    order = {s: sorted(d for d, ss in rows if ss == s) for s in sizes}
    assert got == [(p, s, order[s][k - 1]) for p, s, k in want]


def test_seeded_shuffle_is_a_permutation(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "doc_id long")
    got = mixing.seeded_shuffle(df).collect()
    assert sorted(r.pos for r in got) == list(range(500))
    again = {r.doc_id: r.pos for r in mixing.seeded_shuffle(df).collect()}
    assert all(again[r.doc_id] == r.pos for r in got)


def test_join_small_broadcasts_only_with_a_bound(spark):
    from quarry.plans.joins import join_small
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        bounded = join_small(big, small, "k", max_rows=10)._jdf.queryExecution().sparkPlan().toString()
        unbounded = join_small(big, small, "k")._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in bounded
        assert "BroadcastHashJoin" not in unbounded
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_null_groups_and_string_keys(spark):
    df = spark.createDataFrame([(f"k{i:03}", None if i % 3 == 0 else "g") for i in range(40)], "k string, g string")
    got = {(r.g, r.k): r.rank for r in row_rank(df, ["k"], ["g"], n_buckets=5).collect()}
    assert len(got) == 40
    for g in (None, "g"):
        assert [got[x] for x in sorted((x for x in got if x[0] == g), key=lambda x: x[1])] == list(range(1, sum(x[0] == g for x in got) + 1))


def test_pack_string_ids_and_late_tokens(spark):
    seqs = [list(range(i % 5 + 1)) for i in range(30)]
    df = spark.createDataFrame([(f"<urn:uuid:{i:02}>", s) for i, s in enumerate(seqs)], "doc_id string, ids array<int>")
    got = [r.tokens for r in packing.pack_tokens(df, 8, 999).orderBy("block_id").collect()]
    assert got == brute_pack(seqs, 8, 999)


def test_mix_with_an_empty_source(spark):
    rows = [(i, "web" if i % 2 else "knowledge") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = sorted((r.pos, r.source) for r in mixing.mix_sources(df).collect())
    cuts = mixing.thresholds(mixing.MIX_PROBABILITIES)
    want, pos = [], 0
    while True:
        u = int(hashlib.md5(f"42:{pos}".encode()).hexdigest()[:8], 16)
        name = next(n for n, c in zip(mixing.MIX_SOURCES, cuts + [1 << 40]) if u < c)
        if name == "code":
            break
        want.append((pos, name))
        pos += 1
    assert got == want and got


def test_mix_carries_other_columns(spark):
    df = spark.createDataFrame([(i, ["web", "knowledge", "code"][i % 3], f"t{i}") for i in range(30)], "doc_id long, source string, text string")
    assert all(r.text == f"t{r.doc_id}" for r in mixing.mix_sources(df).collect())


def simulated_buffer(n, size, seed):
    """The iterator with a buffer that ``buffered_shuffle`` stands for."""
    import hashlib
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:8], 16)
    held, out = list(range(min(n, size))), []
    for i in range(size, n):
        slot = number(f"{seed}:buffer:{i}") % size
        out.append(held[slot])
        held[slot] = i
    return out + [held[s] for s in sorted(range(len(held)), key=lambda s: (number(f"{seed}:rest:{s}"), s))]


def test_buffered_shuffle_equals_the_iterator(spark):
    for n, size, seed in ((0, 10, 1), (7, 10, 2), (10, 10, 3), (11, 10, 4), (500, 20, 5), (300, 1, 6)):
        df = spark.range(n).select((F.col("id") * 3).alias("doc_id"), F.col("id").cast("string").alias("more")).repartition(3)
        rows = sorted((r.pos, r.doc_id // 3, r.more) for r in mixing.buffered_shuffle(df, seed, size).collect())
        want = simulated_buffer(n, size, seed)
        assert rows == [(p, i, str(i)) for p, i in enumerate(want)]
        assert all(p >= i - size for p, i in enumerate(want))
        assert rows == sorted((r.pos, r.doc_id // 3, r.more) for r in mixing.buffered_shuffle(df.repartition(5), seed, size).collect())
