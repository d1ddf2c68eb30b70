"""Mixing sources by probability, seeded shuffles, mixture reports.

Randomness is ``md5('<seed>:<position>')`` so a draw table is a pure
function of (seed, position): any executor recomputes the same draws, and a
rerun reproduces the same mixture. Row order inside each source is an
explicit key (default ``doc_id``); positions are computed with bucketed
prefix sums (``plans.ordering``), never with a one-partition window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_prefix_int, md5_u32
from quarry.plans.joins import join_small
from quarry.plans.ordering import row_rank
from quarry.session import checkpointed

# The mixture of the data-mixing step.
MIX_SOURCES = ["web", "knowledge", "code"]
MIX_PROBABILITIES = [0.5, 0.3, 0.2]
MIX_SEED = 42
DRAWS_PER_BUCKET = 1 << 16


def thresholds(probabilities: list[float]) -> list[int]:
    """Integer cut points on [0, 2^32) for cumulative probabilities."""
    total = float(sum(probabilities))
    cum, out = 0.0, []
    for p in probabilities:
        cum += p / total
        out.append(min(1 << 32, int(round(cum * (1 << 32)))))
    return out


def draw_source(u: Column, names: list[str], probabilities: list[float]) -> Column:
    expr = None
    for name, t in zip(names, thresholds(probabilities)):
        expr = F.when(u < F.lit(t), F.lit(name)) if expr is None else expr.when(u < F.lit(t), F.lit(name))
    return expr.otherwise(F.lit(names[-1]))


def _draws(spark, n: int, names, probabilities, seed) -> DataFrame:
    pos = F.col("id")
    d = spark.range(n).select(pos.alias("pos"), draw_source(
        md5_u32(F.concat(F.lit(f"{seed}:"), pos.cast("string"))), names, probabilities).alias("source"))
    n_buckets = max(1, math.ceil(n / DRAWS_PER_BUCKET))
    return row_rank(d, ["pos"], ["source"], bucket=F.floor(F.col("pos") / DRAWS_PER_BUCKET),
                    n_buckets=n_buckets)


def mix_sources(df: DataFrame, names: list[str] = MIX_SOURCES,
                probabilities: list[float] = MIX_PROBABILITIES, seed: int = MIX_SEED,
                source_col: str = "source", order_col: str = "doc_id") -> DataFrame:
    """Interleave sources: at position ``pos`` draw a source with the given
    probabilities and take its next row (in ``order_col`` order). Stops after
    the row that exhausts a source (first-exhausted); a source without rows
    ends it when it is first drawn. Returns ``pos, source`` and the row's
    columns; ``order_col`` must be unique."""
    spark = df.sparkSession
    df = df.filter(F.col(source_col).isin(names))
    # One row per named source reaches the driver.
    counts = {r[0]: int(r[1]) for r in df.groupBy(source_col).count().collect()}
    sizes = [counts.get(s, 0) for s in names]
    # Only the keys are ranked; other columns join back by the order key.
    ranked = row_rank(df.select(order_col, source_col), [order_col], [source_col])
    size_df = spark.createDataFrame(list(zip(names, sizes)), f"{source_col} string, _size long")
    # An optimistic draw count almost always covers the first exhausted
    # source; sum(n_i - 1) + 1 draws always do (pigeonhole). A source without
    # rows ends the stream at its first draw.
    live = [(n, p) for n, p in zip(sizes, probabilities) if p > 0]
    guess = int(min(n / p for n, p in live) * 1.25) + 1024
    cap = max(0, sum(max(n - 1, 0) for n, _ in live)) + 1
    empty = [s for s, n, p in zip(names, sizes, probabilities) if p > 0 and n == 0]
    n_draws, last = min(guess, cap), None
    while last is None:
        draws = checkpointed(_draws(spark, n_draws, names, probabilities, seed).withColumnRenamed(
            "source", source_col))
        ends = join_small(draws, size_df, source_col, max_rows=len(names)).filter(
            (F.col("rank") == F.col("_size")) | ((F.col("_size") == 0) & (F.col("rank") == 1)))
        last = ends.agg(F.min("pos")).first()[0]
        n_draws = max(cap, 2 * n_draws) if empty else cap
    taken = draws.filter(F.col("pos") <= last)
    out = taken.join(ranked, [source_col, "rank"]).drop("rank")
    more = [c for c in df.columns if c not in (order_col, source_col)]
    return out.join(df.select(order_col, *more), order_col) if more else out


def source_group(source: Column) -> Column:
    """Test corpus: ``src0``-``src9`` play web, ``src10``-``src15``
    knowledge, ``src16``-``src19`` code."""
    k = F.substring(source, 4, 10).try_cast("int")
    return F.when(k < 10, "web").when(k < 16, "knowledge").otherwise("code")


def shuffle_key(seed: int, value: Column) -> Column:
    """60-bit key from ``md5('<seed>:shuffle:<value>')``."""
    return md5_prefix_int(F.concat(F.lit(f"{seed}:shuffle:"), value.cast("string")), 15)


def seeded_shuffle(df: DataFrame, seed: int = MIX_SEED, id_col: str = "doc_id") -> DataFrame:
    """A global deterministic permutation: adds ``pos`` (0-based) in order of
    the seeded key (ties by id). Distributed: key-range buckets, no
    one-partition sort."""
    keyed = df.withColumn("_k", shuffle_key(seed, F.col(id_col)))
    out = row_rank(keyed, ["_k", id_col], out="_r")
    return out.withColumn("pos", F.col("_r") - 1).drop("_k", "_r")


BUFFER = 1000


def buffered_shuffle(df: DataFrame, seed: int = MIX_SEED, buffer_size: int = BUFFER, order_col: str = "doc_id") -> DataFrame:
    """The shuffle of an iterator with a buffer: it holds ``buffer_size`` rows,
    and each row that comes in (in ``order_col`` order, which must be unique)
    takes the place of one that is let out, drawn by ``(seed, number of the
    row)``; at the end the buffer is emptied in seeded order. Adds ``pos``,
    the 0-based place in the output. A row comes out at most ``buffer_size``
    places early, and at any later place.

    No iterator runs: the draw says in which slot of the buffer a row stands,
    and it leaves when the slot is next drawn, the next row in a window over
    its slot. The slots are as many tasks' worth of work; memory does not
    hold a buffer."""
    n = df.count()
    numbered = row_rank(df, [order_col], out="_i").withColumn("_i", F.col("_i") - 1)
    draw = md5_u32(F.concat(F.lit(f"{seed}:buffer:"), F.col("_i").cast("string"))) % buffer_size
    slotted = numbered.withColumn("_slot", F.when(F.col("_i") < buffer_size, F.col("_i")).otherwise(draw))
    left = slotted.withColumn("_out", F.lead("_i").over(Window.partitionBy("_slot").orderBy("_i")))
    # The last row of each slot stays to the end: at most ``buffer_size`` rows, ordered by one task.
    rest = left.filter(F.col("_out").isNull()).withColumn("_k", md5_u32(F.concat(F.lit(f"{seed}:rest:"), F.col("_slot").cast("string"))))
    rest = rest.withColumn("pos", F.lit(max(0, n - buffer_size)) + F.row_number().over(Window.orderBy("_k", "_slot")) - 1)
    gone = left.filter(F.col("_out").isNotNull()).withColumn("pos", F.col("_out") - buffer_size)
    return gone.select(*df.columns, F.col("pos").cast("long").alias("pos")).unionByName(rest.select(*df.columns, F.col("pos").cast("long").alias("pos")))


def mix_report(mixed: DataFrame, n: int = 1000, seed: int = MIX_SEED,
               source_col: str = "source") -> DataFrame:
    """Source counts and shares among the first ``n`` rows of the shuffled
    mixture (a top-n by shuffle key, then a small aggregation)."""
    first = mixed.withColumn("_k", shuffle_key(seed, F.col("pos"))).orderBy("_k", "pos").limit(n)
    counts = first.groupBy(source_col).agg(F.count(F.lit(1)).alias("n"))
    # One row per source: the total over this tiny table is a trivial window.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(source_col, "n", F.round(F.col("n") * 100.0 / total, 2).alias("pct"))
