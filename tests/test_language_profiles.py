"""Profiles against plain counting, accuracy on documents kept out of them."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import language_profiles as lp

SCHEMA = "doc_id long, text string, lang string"


def plain_grams(text):
    grams = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        padded = f"_{word}_"
        grams.update(word)
        grams.update(padded[i:i + m] for m in (2, 3) for i in range(len(padded) - m + 1))
    return grams


def ranking(grams, size):
    return {g: i for i, (g, _) in enumerate(sorted(grams.items(), key=lambda x: (-x[1], x[0].encode()))[:size], 1)}


def test_profiles_and_distances_equal_plain(spark):
    texts = [("en", "The cat and the hat. THE end"), ("en", "of that, and then"), ("fr", "le chat et la fête à l'été"), ("de", "der Hund über die Straße 3x"), (None, "the unlabelled dog"), ("de", None), ("fr", ""), (None, "12 _ !")]
    df = spark.createDataFrame([(i, t, l) for i, (l, t) in enumerate(texts)], SCHEMA).repartition(3)
    for size in (5, 300):
        counts = {}
        for lang, t in texts:
            if lang:
                counts.setdefault(lang, Counter()).update(plain_grams(t))
        want = {lang: ranking(c, size) for lang, c in counts.items()}
        known = lp.collected(lp.language_profiles(df, size=size), size=size)
        assert known == want
        got = {r.doc_id: tuple(r.f) for r in df.select("doc_id", lp.identify(F.col("text"), known, size).alias("f")).collect()}
        for i, (_, t) in enumerate(texts):
            own = ranking(plain_grams(t), size)
            best = min((sum(abs(p - of[g]) if g in of else size for g, p in own.items()), name) for name, of in want.items()) if own else (None, None)
            assert got[i] == (best[1], best[0], len(own))


def test_accuracy_on_documents_kept_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang IS NOT NULL")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    known = lp.collected(lp.language_profiles(docs.filter(~out)))
    scored = docs.filter(out).select("lang", lp.identify(F.col("text"), known)["predicted"].alias("predicted")).filter("predicted IS NOT NULL")
    rows = scored.collect()
    assert len(rows) > 150 and sum(r.lang == r.predicted for r in rows) / len(rows) > 0.98


def test_filter_and_limits(spark):
    df = spark.createDataFrame([(1, "the cat and the hat", "en"), (2, "le chat et la", "fr"), (3, None, "en")], SCHEMA)
    known = lp.collected(lp.language_profiles(df))
    assert [r.doc_id for r in lp.profile_filter(df, known, ["en"]).collect()] == [1]
    assert lp.profile_filter(df, known, ["en"], most_distance=-1.0).count() == 0
    with pytest.raises(ValueError):
        lp.collected(lp.language_profiles(df), most_languages=0)
    empty = lp.collected(lp.language_profiles(df.limit(0)))
    assert empty == {} and df.select(lp.identify(F.col("text"), empty)["predicted"].alias("p")).distinct().collect() == [(None,)]


def test_scores_of_odd_texts_equal_plain():
    rng = random.Random(7)
    texts = ["", " ", " a ", "𝔘𝔫 한국 ｱ"] + [" ".join("".join(rng.choice("abé한𐐷ｚλ") for _ in range(rng.choice([1, 2, 3, 9]))) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    for size in (5, 300):
        two = {lang: ranking(plain_grams(" ".join(texts[i::2])), size) for i, lang in enumerate("yx")}
        for known in (two, {}, {"a": {}}, {"b": two["x"], "a": two["x"], "c": {"e": 1, "longer": 2}}):
            for text, got in zip(texts, lp._nearest(texts, lp._postings(known), size), strict=True):
                own = ranking(plain_grams(text), size)
                best = min((sum(abs(p - of[g]) if g in of else size for g, p in own.items()), name) for name, of in known.items()) if own and known else (None, None)
                assert got == (best[1], best[0], len(own))


def test_filter_scores_a_text_once(spark):
    df = spark.createDataFrame([(1, "the cat and the hat", "en"), (2, "le chat et la", "fr")], SCHEMA)
    known = lp.collected(lp.language_profiles(df))
    plan = lp.profile_filter(df, known, ["en"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
