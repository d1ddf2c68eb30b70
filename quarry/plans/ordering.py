"""Global order positions without a one-partition window.

A bare ``Window.orderBy(k)`` moves every row to one task. Instead rows are
range-partitioned by the order key (Spark samples the bounds, so keys may
have any type), per-partition totals form a tiny table whose running sum is
the offset of each partition, and a window *within* each partition finishes
the job. Within groups, the group's first global position is subtracted, so
a group that holds most rows is spread like any other range. A caller may
give bucket numbers instead. Boundaries only change the balance of work,
never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.plans.joins import null_safe_join
from quarry.session import checkpointed, written

BUCKET = "_bucket"
# Rows that one window task sorts on average, at most.
ROWS_PER_PART = 2_000_000


def default_parts(df: DataFrame) -> int:
    """Partitions for ``df``: by its row count, at least the session's."""
    rows = df.select(F.lit(1)).count()
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PART))


def prefix_sum(df: DataFrame, order_by: list[str], weight: Column | None = None,
               partition_by: list[str] | None = None, bucket: Column | None = None,
               n_buckets: int | None = None, out: str = "prefix") -> DataFrame:
    """Adds ``out`` = sum of ``weight`` (not negative) over all earlier rows
    (exclusive) in ``order_by`` order within ``partition_by``; NULL is a
    group like any other. With weight 1 it is the 0-based row number.
    ``order_by`` must be unique within a partition. ``bucket``, if given,
    must ascend with ``order_by``. Pass narrow rows: they are written once."""
    parts = list(partition_by or [])
    w = (weight if weight is not None else F.lit(1)).cast("long")
    if bucket is None:
        ranged = range_prefix(df, [*parts, *order_by], {out: w}, n_buckets)
        if not parts:
            return ranged
        start = ranged.groupBy(*parts).agg(F.min(out).alias("_start"))
        return null_safe_join(ranged, start, parts).withColumn(out, F.col(out) - F.col("_start")).drop("_start")
    rows = df.withColumn(BUCKET, bucket).withColumn("_w", w)
    totals = rows.groupBy(*parts, BUCKET).agg(F.sum("_w").alias("_tot"))
    before = Window.partitionBy(*parts).orderBy(BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(*parts, BUCKET,
                            F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_boff"))
    within = Window.partitionBy(*parts, BUCKET).orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_w").over(within), F.lit(0)))
    joined = null_safe_join(rows, offsets, [*parts, BUCKET])
    return joined.withColumn(out, F.col("_boff") + F.col("_in")).drop(
        BUCKET, "_w", "_boff", "_in")


def row_rank(df: DataFrame, order_by: list[str], partition_by: list[str] | None = None,
             bucket: Column | None = None, n_buckets: int | None = None,
             out: str = "rank") -> DataFrame:
    """1-based row number in ``order_by`` order within ``partition_by``."""
    ranked = prefix_sum(df, order_by, None, partition_by, bucket, n_buckets, out="_p")
    return ranked.withColumn(out, F.col("_p") + 1).drop("_p")


def range_prefix(df: DataFrame, order_by: list[str], sums: dict[str, Column],
                 n_parts: int | None = None) -> DataFrame:
    """Adds, for each ``name: value`` of ``sums``, the sum of ``value`` over
    all rows before this one in the global ``order_by`` order (null first).

    Rows are range-partitioned (Spark samples the bounds, so any key type
    works), written once to the checkpoint folder with their partition's
    number, summed per partition (``n_parts`` rows), and finished by a window
    inside each partition. Rows equal in ``order_by`` stay in one partition.
    """
    held = written(df.withColumns({f"_v_{k}": v for k, v in sums.items()}), "unranked")  # counted, sampled and ranged from there
    n = n_parts or default_parts(held)
    held = checkpointed(held.repartitionByRange(n, *order_by).withColumn("_pid", F.spark_partition_id()))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy("_pid").agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in sums])
    within = Window.partitionBy("_pid").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, -1)
    inner = held.withColumns({f"_i_{k}": F.coalesce(F.sum(f"_v_{k}").over(within), F.lit(0)) for k in sums})
    joined = inner.join(F.broadcast(offsets), "_pid")  # n_parts rows
    return joined.withColumns({k: F.col(f"_o_{k}") + F.col(f"_i_{k}") for k in sums}).drop(
        "_pid", *[f"_{x}_{k}" for k in sums for x in "vio"])


def running_offsets(df: DataFrame, order_by: list[str], weight: Column, out: str = "offset", n_parts: int | None = None) -> DataFrame:
    """The rows of ``df`` with ``out`` = sum of ``weight`` (not negative) over
    all earlier rows in ``order_by`` order (null first), for rows that need no
    unique key: ties go by a hash of the row, and equal rows are
    interchangeable. The rows, texts included, are shuffled once, by range, and
    nothing is joined back; a key that a third of all rows share is spread by
    the tie. The sorted partitions are checkpointed, summed, and read through
    with their partition's offset (``n_parts`` numbers)."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T

    names = df.columns
    rows = df.select("*", weight.cast("long").alias("_w"), F.xxhash64(*names).alias("_tie"), F.monotonically_increasing_id().alias("_nth"))
    order = [*order_by, "_tie", "_nth"]
    n = n_parts or default_parts(df)
    held = checkpointed(rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*names, "_w", F.spark_partition_id().alias("_pid")))
    sums = dict(held.groupBy("_pid").agg(F.sum("_w").alias("_t")).orderBy("_pid").collect())  # n_parts rows
    starts, total = {}, 0
    for pid, own in sums.items():
        starts[pid], total = total, total + own

    def add(batches):
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = starts[batch.column("_pid")[0].as_py()] if at is None else at
            ends = at + np.cumsum(batch.column("_w").to_numpy())
            before = np.concatenate([[at], ends[:-1]])
            at = int(ends[-1])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(before, pa.int64())], [*names, out])

    return held.mapInArrow(add, T.StructType([*df.schema.fields, T.StructField(out, T.LongType())]))
