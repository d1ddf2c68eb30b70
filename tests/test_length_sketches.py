"""Percentiles from sketches against exact ranks; runs stored, merged and repeated."""

import numpy as np
import pytest

from quarry.operators import length_sketches as ls

SHARES = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]


def lengths(spark, n=60_000, seed=0):
    rng = np.random.default_rng(seed)
    values = np.floor(rng.lognormal(6, 1.2, n)).astype(int)
    groups = [["en", "de", None][i] for i in rng.choice(3, n, p=[0.7, 0.25, 0.05])]
    return spark.createDataFrame(list(zip(groups, values.tolist())), "lang string, n_tokens long"), groups, values


def worst(answers, groups, values):
    """Largest distance of an answer's exact rank from the share asked for."""
    out = 0.0
    for r in answers:
        own = np.array([v for g, v in zip(groups, values) if g == r.lang])
        assert r.n == len(own)
        out = max(out, (own < r.n_tokens).mean() - r.p, r.p - (own <= r.n_tokens).mean())
    return out


def test_rank_error_and_merged_runs(spark, tmp_path):
    df, groups, values = lengths(spark)
    one = ls.percentiles(ls.sketch_lengths(df, by=["lang"]), SHARES).collect()
    assert len(one) == 3 * len(SHARES) and worst(one, groups, values) <= ls.rank_error()
    path = str(tmp_path / "runs")
    for run, part in zip("abc", df.randomSplit([1.0, 2.0, 3.0], seed=1)):
        ls.store_run(ls.sketch_lengths(part, by=["lang"]), path, run)
        ls.store_run(ls.sketch_lengths(part, by=["lang"]), path, run)  # a repeated run counts once
    stored = ls.stored_runs(spark, path)
    merged = ls.percentiles(ls.merge_runs(stored, ["lang"]), SHARES).collect()
    assert worst(merged, groups, values) <= ls.rank_error()
    (every,) = ls.merge_runs(stored).collect()
    assert (every.n, every.least, every.most) == (len(values), values.min(), values.max())
    only = ls.merge_runs(ls.stored_runs(spark, path, ["a", "c"]), ["lang"]).agg({"n": "sum"}).first()[0]
    assert 0 < only < len(values)


def test_small_groups_are_exact(spark):
    values = [5, 5, 7, 100, 3]
    df = spark.createDataFrame([("x", v) for v in values] + [("x", None), (None, 9)], "lang string, n_tokens int")
    sketches = ls.sketch_lengths(df, by=["lang"])
    got = {(r.lang, r.p): r.n_tokens for r in ls.percentiles(sketches, [0.2, 0.4, 0.8, 1.0]).collect()}
    assert [got["x", p] for p in (0.2, 0.4, 0.8, 1.0)] == [3, 5, 7, 100] and got[None, 0.2] == 9
    shares = {(r.lang, r.max_len): r.share for r in ls.share_within(sketches, [2, 5, 99, 100]).collect()}
    assert [round(shares["x", x], 9) for x in (2, 5, 99, 100)] == [0, 0.6, 0.8, 1]


def test_bounds_counted_exactly(spark):
    df, groups, values = lengths(spark, 20_000, 3)
    answers = ls.percentiles(ls.sketch_lengths(df, by=["lang"]), SHARES)
    for r in ls.rank_bounds(df, answers, by=["lang"]).collect():
        own = np.array([v for g, v in zip(groups, values) if g == r.lang])
        assert r.below == (own < r.n_tokens).mean() and r.upto == (own <= r.n_tokens).mean()
        assert r.below - ls.rank_error() <= r.p <= r.upto + ls.rank_error()


def test_nothing_and_wrong_shares(spark):
    df, _, _ = lengths(spark, 10)
    assert ls.percentiles(ls.sketch_lengths(df.limit(0), by=["lang"]), [0.5]).collect() == []
    assert ls.percentiles(ls.sketch_lengths(df.limit(0)), [0.5]).collect() == []
    with pytest.raises(ValueError):
        ls.percentiles(ls.sketch_lengths(df), [1.5])
