"""The automaton against the regular expression it stands for."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions.text import whole_word_pattern
from quarry.operators import keywords, quality
from tests.conftest import docs_df

ALPHABET = "ab_é1İß漢 -.\n"


def random_text(rng, n):
    return "".join(rng.choice(ALPHABET + "AB") for _ in range(rng.randrange(n)))


def test_equals_regex_for_every_keyword(spark):
    rng = random.Random(5)
    words = sorted({random_text(rng, 4).lower() for _ in range(60)} - {""} | {"a b", "a.b", "b-", "-", "+a", "a|b"})
    texts = [random_text(rng, 60) for _ in range(120)] + [None, "", "a", "a b", "xa bx", "A|B"]
    df = docs_df(spark, texts).repartition(3)
    got = {r.doc_id: {words[i] for i in r.found} for r in df.select("doc_id", keywords.matched_keywords(F.col("text"), words).alias("found")).collect()}
    low = F.lower(F.coalesce("text", F.lit("")))
    flags = df.select("doc_id", *[low.rlike(whole_word_pattern([w])).alias(f"k{i}") for i, w in enumerate(words)]).collect()
    assert got == {r.doc_id: {w for i, w in enumerate(words) if r[f"k{i}"]} for r in flags}


def test_ten_thousand_keywords_in_one_pass(spark):
    rng = random.Random(6)
    words = sorted({f"w{i}x" for i in range(10_000)})
    texts = [" ".join(f"W{rng.randrange(12_000)}x" for _ in range(50)) for _ in range(300)]
    df = docs_df(spark, texts)
    want = {}
    for t in texts:
        for w in {x.lower() for x in t.split()}:
            want[w] = want.get(w, 0) + 1
    hits = {r.keyword: r.n_docs for r in quality.topic_hits(df, words).collect()}
    assert hits == {w: want.get(w, 0) for w in words}
    chosen = rng.sample(words, 400)
    kept = [r.doc_id for r in quality.topic_extract(df, chosen).collect()]
    assert sorted(kept) == [i for i, t in enumerate(texts) if set(t.lower().split()) & set(chosen)]
    plan = quality.topic_hits(df, words)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_limits(spark):
    with pytest.raises(ValueError):
        keywords.automaton(["a", ""])
    with pytest.raises(ValueError):
        keywords.automaton(["a", "a"])
    df = docs_df(spark, ["b", "a", None, "a", ""])
    assert keywords.keyword_list(df, "text") == ["a", "b"]
    with pytest.raises(ValueError):
        keywords.keyword_list(df, "text", most=1)
    assert [r.found for r in df.select(keywords.matched_keywords(F.col("text"), []).alias("found")).collect()] == [[]] * 5
