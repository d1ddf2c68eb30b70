"""Parallelism for CPU-heavy row-local work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Make sure row-local text work has at least one task per core.

    A large corpus already scans as thousands of splits and this is a no-op.
    A small file (a single Parquet row group) scans as one task; then the
    rows are redistributed round-robin (sorted first by Spark, so a retried
    task sees the same rows) before the expensive per-row expressions.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def filter_fenced(df: DataFrame, condition_col: str) -> DataFrame:
    """Filter on a computed boolean column without letting Catalyst push the
    predicate below the projections that compute it.

    Pushing a filter through projections inlines the projected expressions
    into the condition; for expressions built from shared arrays (the word
    split of a text) every reference then recomputes the array. Reading the
    flag through a one-element ``explode`` (a Generate, which predicates are
    not pushed below) keeps each array computed once per row.
    """
    cols = [c for c in df.columns if c != condition_col]
    fenced = df.select(*cols, F.explode(F.array(F.col(condition_col))).alias("_keep"))
    return fenced.filter(F.col("_keep")).drop("_keep")
