"""Percentiles of token lengths from mergeable sketches, kept run by run.

Which context length a corpus needs is a question about percentiles, asked
again whenever documents are added. A KLL sketch of the lengths of each group
is a few kilobytes, whatever the number of documents, and sketches merge: a
run stores those of its own documents, and any set of runs is answered from
the stored sketches without reading a document again. Spark builds them by
partial aggregation, so a group that holds a third of all rows is one sketch
for each task before the shuffle.

Sketches are random: two over the same documents differ, so store one before
it is asked twice. The rank of an answer is off by at most ``rank_error(k)`` of the documents
(99 % confidence); up to about ``k`` documents answers are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.plans.joins import null_safe_join
from quarry.session import written

#: Size of a sketch; more is more exact.
K = 800
_COLUMNS = ("sketch", "n", "least", "most")


def rank_error(k: int = K) -> float:
    """Share of the documents by which a rank may be off (the published bound of the sketch)."""
    return 2.296 / k**0.9021


def sketch_lengths(df: DataFrame, n_tokens: str = "n_tokens", by: list[str] | None = None, k: int = K) -> DataFrame:
    """``by..., sketch, n, least, most``: one row for each group; NULL lengths do not count, NULL is a group like any other."""
    length = F.col(n_tokens).cast("long")
    return df.filter(length.isNotNull()).groupBy(*(by or [])).agg(
        F.kll_sketch_agg_bigint(length, F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n"), F.min(length).alias("least"), F.max(length).alias("most")).filter("n > 0")


def store_run(sketches: DataFrame, path: str, run: str) -> None:
    """Keeps a run's sketches in its own folder ``run=...``; a run that is repeated replaces what it wrote."""
    sketches.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


def stored_runs(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """Sketches of all stored runs, or of those named, with their ``run``."""
    kept = spark.read.option("basePath", path).parquet(path).withColumn("run", F.col("run").cast("string"))
    return kept if runs is None else kept.filter(F.col("run").isin(runs))


def merge_runs(stored: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One sketch for each group over all rows of ``stored``; with fewer columns in ``by`` than stored, groups merge too."""
    return stored.groupBy(*(by or [])).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).filter("n > 0")


def percentiles(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """``by..., n, p, n_tokens``: the length that a share ``p`` of each group's documents does not exceed."""
    if any(not 0 <= p <= 1 for p in shares):
        raise ValueError("shares lie between 0 and 1")
    by = [c for c in sketches.columns if c not in _COLUMNS]
    asked = F.lit([float(p) for p in shares])
    answers = F.arrays_zip(asked.alias("p"), F.kll_sketch_get_quantile_bigint("sketch", asked).alias("n_tokens"))
    return sketches.select(*by, "n", F.inline(answers))


def share_within(sketches: DataFrame, max_lengths: list[int]) -> DataFrame:
    """``by..., n, max_len, share``: the share of each group's documents with at most ``max_len`` tokens."""
    by = [c for c in sketches.columns if c not in _COLUMNS]
    asked = F.lit([int(x) for x in max_lengths])
    ranks = F.arrays_zip(asked.cast("array<bigint>").alias("max_len"), F.kll_sketch_get_rank_bigint("sketch", asked.cast("array<bigint>")).alias("_rank"))
    each = sketches.select(*by, "n", "least", "most", F.inline(ranks))
    rank = F.when(F.col("max_len") >= F.col("most"), 1.0).when(F.col("max_len") < F.col("least"), 0.0).otherwise(F.col("_rank"))
    return each.select(*by, "n", "max_len", rank.alias("share"))


def rank_bounds(df: DataFrame, answers: DataFrame, n_tokens: str = "n_tokens", by: list[str] | None = None) -> DataFrame:
    """``answers`` (of :func:`percentiles`) with ``below`` and ``upto``: the exact shares of the documents that are shorter than the answer, and that are not longer."""
    keys = list(by or [])
    answers = written(answers, "percentiles")
    per = answers.groupBy(*keys).agg(F.collect_list(F.struct("p", "n_tokens")).alias("_asked"))  # one entry for each share
    lengths = df.select(*keys, F.col(n_tokens).cast("long").alias("_len")).filter("_len IS NOT NULL")
    lengths = lengths.groupBy(*keys, "_len").agg(F.count(F.lit(1)).alias("_docs"))
    joined = null_safe_join(lengths, per, keys) if keys else lengths.crossJoin(F.broadcast(per))  # one row
    asked = joined.select(*keys, "_len", "_docs", F.inline("_asked"))
    counted = asked.groupBy(*keys, "p").agg(F.sum(F.when(F.col("_len") < F.col("n_tokens"), F.col("_docs")).otherwise(0)).alias("_below"),
                                            F.sum(F.when(F.col("_len") <= F.col("n_tokens"), F.col("_docs")).otherwise(0)).alias("_upto"))
    return null_safe_join(answers, counted, [*keys, "p"]).select(*answers.columns, (F.col("_below") / F.col("n")).alias("below"), (F.col("_upto") / F.col("n")).alias("upto"))
