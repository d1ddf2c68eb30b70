"""Deduplication: exact, MinHash clusters, and connected components against
a brute-force union-find."""

import random

from pyspark.sql import functions as F

from quarry.operators import dedup
from quarry.plans.components import connected_components
from tests.conftest import docs_df

BASE = ("the quick brown fox jumps over the lazy dog while the cat watches from the warm "
        "window and the birds sing in the tall green trees near the quiet river bank")


def test_exact_dedup_keeps_first_normalised(spark):
    df = docs_df(spark, ["Hello, World!", "hello world", "other", "HELLO   WORLD"])
    assert sorted(r.doc_id for r in dedup.exact_dedup(df).collect()) == [0, 2]


def test_minhash_clusters_and_keep_smallest(spark):
    texts = [BASE, BASE.upper() + "!!", BASE + " today", "completely different words here now ok",
             "four words only here", BASE.replace("quick", "slow")]
    df = docs_df(spark, texts)
    cl = {r.doc_id: r.cluster_id for r in dedup.duplicate_clusters(df).collect()}
    assert cl.get(1) == 0 and cl.get(2) == 0
    kept = sorted(r.doc_id for r in dedup.minhash_dedup(df).collect())
    assert 0 in kept and 3 in kept and 4 in kept and 1 not in kept and 2 not in kept
    removed = dedup.duplicates_removed(df).count()
    assert len(kept) + removed == len(texts)


def test_hot_bucket_of_copies(spark):
    df = docs_df(spark, [BASE] * 300 + ["another text that is not like the rest at all"])
    kept = sorted(r.doc_id for r in dedup.minhash_dedup(df).collect())
    assert kept == [0, 300]


def union_find(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def test_components_match_union_find(spark):
    rng = random.Random(7)
    for trial in range(3):
        edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
        edges += [(i, i + 1) for i in range(500, 560)]  # a long chain
        edges = [(a, b) for a, b in edges if a != b]
        nodes = {x for e in edges for x in e}
        want = union_find(edges, nodes)
        df = spark.createDataFrame(edges, "src long, dst long")
        got = {r.node: r.component for r in connected_components(df).collect()}
        assert got == want


def test_signature_shape(spark):
    df = docs_df(spark, [BASE, "too short"])
    sig = dedup.minhash_signatures(df).collect()
    assert len(sig) == 1 and len(sig[0].signature) == 160
    assert all(0 <= v < dedup.PRIME for v in sig[0].signature)


def test_components_with_a_hub(spark):
    # One node linked to a third of all nodes, plus a separate chain.
    edges = [(0, i) for i in range(1, 3001)] + [(i, i + 1) for i in range(5000, 5100)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert all(got[i] == 0 for i in range(0, 3001))
    assert all(got[i] == 5000 for i in range(5000, 5101))
    assert len(got) == 3001 + 101


def test_texts_without_words_are_compared_as_they_are(spark):
    df = docs_df(spark, ["!!!", "###", None, "", "!!!", "a"])
    assert sorted(r.doc_id for r in dedup.exact_dedup(df).collect()) == [0, 1, 2, 5]


def test_string_ids(spark):
    texts = [BASE, BASE.upper(), "entirely other words stand in this line of text", BASE + " today"]
    df = spark.createDataFrame([(f"<urn:uuid:{i}>", t) for i, t in enumerate(texts)], "doc_id string, text string")
    kept = sorted(r.doc_id for r in dedup.minhash_dedup(df).collect())
    assert kept == ["<urn:uuid:0>", "<urn:uuid:2>"]
    assert {r.cluster_id for r in dedup.duplicates_removed(df).collect()} == {"<urn:uuid:0>"}


def test_removal_does_not_shuffle_texts(spark):
    plan = dedup.minhash_dedup(docs_df(spark, [BASE, BASE, "x"]))._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_signatures_of_a_large_batch_come_in_parts():
    import pyarrow as pa
    cfg = dedup.MinhashConfig()
    texts = [" ".join(f"w{i % 97}x{k}" for i in range(20_000)) for k in range(8)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([*texts, "four words are few"])], ["doc_id", "plain"])
    out = list(dedup._minhash_batches(dedup.hash_coefficients(cfg), cfg.n_grams)([batch]))
    assert len(out) > 1 and [i for b in out for i in b.column("doc_id").to_pylist()] == list(range(8))


def test_edges_compute_the_keys_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = docs_df(spark, ["one two three four five six"] * 3 + ["one two three"])
    keys = dedup.band_keys(dedup.minhash_signatures(df.mapInArrow(seen, df.schema)))
    assert {(r.src, r.dst) for r in dedup.candidate_edges(keys).collect()} == {(1, 0), (2, 0)}
    assert read.value == 4
