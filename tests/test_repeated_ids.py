"""Rows, not ids, are removed and packed: ids may repeat or be missing."""

import random
from collections import Counter

from pyspark.sql import functions as F

from quarry.operators import dedup, packing, quality
from tests.conftest import docs_df

SCHEMA = "doc_id long, text string, lang string"
LONG = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def kept_rows(rows):
    """One row for each normalised text: smallest id, NULL last."""
    best = {}
    for i, text, _ in rows:
        key = " ".join("".join(c if c.isalnum() else " " for c in (text or "").lower()).split()) or ("", text or "")
        rank = (i is None, i or 0)
        best[key] = min(best.get(key, rank), rank)
    return sorted(((None if none else i) for none, i in best.values()), key=repr)


def test_exact_dedup_loses_no_text(spark):
    rows = [(1, "Same text", "en"), (5, "Same text", "en"), (5, "another text unique", "en")]
    assert rows_of(dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA)), "doc_id", "text") == [(1, "Same text"), (5, "another text unique")]


def test_exact_dedup_of_any_rows(spark):
    rng = random.Random(3)
    for n_ids in (3, 200):
        rows = [(rng.choice([None, *range(n_ids)]), rng.choice(["a b", "A, b!", "c", None, "", "...", "d e f", f"u{i}"]), rng.choice(["en", None])) for i in range(80)]
        got = dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA).repartition(4))
        assert sorted((r.doc_id for r in got.collect()), key=repr) == kept_rows(rows)
        assert not Counter(map(tuple, got.collect())) - Counter(rows)


def test_copies_without_an_id(spark):
    rows = [(None, "x y", "en")] * 50 + [(None, "z", "en")]
    assert rows_of(dedup.exact_dedup(spark.createDataFrame(rows, SCHEMA)), "doc_id", "text") == [(None, "x y"), (None, "z")]


def test_minhash_dedup_loses_no_text(spark):
    rows = [(1, LONG, "en"), (5, LONG + ".", "en"), (5, "another text with more than five words in it", "en"), (None, LONG, "en"),
            (None, "short", "en"), (5, "another text with more than five words in it", "en")]
    got = dedup.minhash_dedup(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["doc_id", "text", "lang"]
    assert rows_of(got, "doc_id", "text") == sorted([(1, LONG), (5, "another text with more than five words in it"), (None, "short")], key=repr)


def test_packing_with_repeated_keys(spark):
    ids = F.transform(F.split("text", ""), lambda c: F.ascii(c))
    for rows in ([(1, "abc", ""), (1, "de", ""), (1, "fghij", "")], [(None, "abcd", "")] * 5, [(i % 3 or None, "xy" * (i % 4) + "z", "") for i in range(60)]):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        size = sum(len(t) for _, t, _ in rows)
        blocks = {r.block_id: r.tokens for r in packing.pack_tokens(df, 2, ids=ids, n_buckets=4).collect()}
        assert sorted(blocks) == list(range(size // 2)) and all(len(t) == 2 for t in blocks.values())
        whole = Counter(t for b in blocks.values() for t in b)
        assert not whole - Counter(ord(c) for _, t, _ in rows for c in t)
        again = {r.block_id: r.tokens for r in packing.pack_tokens(df.repartition(7), 2, ids=ids, n_buckets=2).collect()}
        assert again == blocks


def test_long_rule_counts_every_word(spark):
    text = "the words of and " * 25_001
    df = docs_df(spark, [text, text[:len("the words of and ") * 25_000], None])
    assert [r.reason for r in quality.gopher_annotate(df).orderBy("doc_id").collect()] == ["long_doc", None, "short_doc"]
