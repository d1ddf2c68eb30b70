"""Join helpers that broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import checkpointed

# Largest row count we broadcast on a static bound.
BROADCAST_MAX_ROWS = 1_000_000


# Largest measured size of an id list that is broadcast.
BROADCAST_MAX_BYTES = 32 << 20


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet NULL keys; the keys appear once."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        eq = left[c].eqNullSafe(renamed[f"_r_{c}"])
        cond = eq if cond is None else cond & eq
    return left.join(renamed, cond, how).drop(*[f"_r_{c}" for c in on])


def remove_listed(df: DataFrame, removed: DataFrame, id_col: str) -> DataFrame:
    """``df`` without the ids of ``removed``. The list is written once and
    measured; up to ``BROADCAST_MAX_BYTES`` it is broadcast, so the rows of
    ``df`` (which may hold texts) are not shuffled; beyond that a shuffled
    anti join runs."""
    ids = checkpointed(removed.select(id_col).distinct())
    size = ids.agg(F.sum(F.octet_length(F.col(id_col).cast("string")) + 16)).first()[0] or 0
    return df.join(F.broadcast(ids) if size <= BROADCAST_MAX_BYTES else ids, id_col, "left_anti")


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int | None = None) -> DataFrame:
    """Join ``big`` with a side expected to be small.

    ``max_rows`` is a bound that holds by construction (e.g. ``n_buckets``
    rows of per-bucket totals, ``k`` few-shot rows). Only when it is given and
    below ``BROADCAST_MAX_ROWS`` is the side broadcast. Without a static bound
    the planner decides: a broadcast if its size estimate or, under AQE, the
    measured size of the side's shuffle is under the session's threshold, else
    a sort merge join (with AQE skew splitting).
    """
    if max_rows is not None and max_rows <= BROADCAST_MAX_ROWS:
        small = F.broadcast(small)
    return big.join(small, on, how)
