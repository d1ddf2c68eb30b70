import random

from quarry.llm import chat_collapse

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(convs):
    """``convs``: id -> turns. Ids that stay, by comparing all pairs."""
    keep = []
    for i, a in convs.items():
        beaten = any(j != i and b[: len(a)] == a and (len(b) > len(a) or (j is not None and (i is None or j < i))) for j, b in convs.items())
        if not beaten:
            keep.append(i)
    return sorted(keep, key=repr)


def test_equal_to_all_pairs(spark):
    rnd = random.Random(7)
    convs = {}
    for i in range(120):
        base = convs[rnd.choice(list(convs))] if convs and rnd.random() < 0.6 else []
        turns = base[: rnd.randrange(len(base) + 1)] + [(rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "", "long text"])) for _ in range(rnd.randrange(1 if base else 1, 4))]
        convs[i] = turns
    rows = [(i, t, r, x) for i, turns in convs.items() for t, (r, x) in enumerate(turns)]
    rnd.shuffle(rows)
    got = chat_collapse.collapse(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted({r.conv_id for r in got}, key=repr) == brute(convs)
    for i in brute(convs):
        mine = sorted((r for r in got if r.conv_id == i), key=lambda r: r.place)
        assert [r.place for r in mine] == list(range(1, len(convs[i]) + 1)) and {r.n_turns for r in mine} == {len(convs[i])}
        assert "".join(r.rendered for r in mine) == "".join(f"<|im_start|>{r or 'user'}\n{x}<|im_end|>\n" for r, x in convs[i])


def test_edges(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "yo"), (None, 0, "user", "alone"),
            (4, None, "user", "first"), (4, 0, "user", "second"), (5, 0, None, "x"), (6, 0, "user", "x"), (7, 0, "user", None), (8, 0, "user", ""), (9, 0, "u", "dup"), (9, 0, "u", "dup")]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("rid", "conv", "place", "a", "b", "before", "digest", "n_turns"):
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit("x"))
    got = sorted(((r.conv_id, r.place, r.rendered.split("\n")[1].removesuffix("<|im_end|>")) for r in chat_collapse.collapse(df).collect()), key=repr)
    assert got == sorted([(1, 1, "hi"), (1, 2, "yo"), (None, 1, "alone"), (4, 1, "first"), (4, 2, "second"), (5, 1, "x"), (6, 1, "x"), (7, 1, ""), (9, 1, "dup"), (9, 2, "dup")], key=repr)
    assert chat_collapse.collapse(df.limit(0)).collect() == []
