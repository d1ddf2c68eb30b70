"""Quantisation and lookup over vector tables ``(vec_id, embedding array<float>)``.

Scale parameters are aggregates over a scope (whole table, a label group,
or each row). Group aggregates are partial/final hash aggregations joined
back on the group key; per-element work is ``transform`` over the array,
in double precision, rounding half to even (``rint``) like tensor rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.plans.joins import join_small, null_safe_join


def _as_double(arr: Column) -> Column:
    return F.transform(arr, lambda x: x.cast("double"))


def _scoped(df: DataFrame, scope: str | None, aggs: list[Column]) -> DataFrame:
    """Attach scope aggregates to each row: ``None`` = whole table (one row,
    broadcast), ``"row"`` = per row (no aggregation), else a group column
    (joined on the key, NULL being a group too)."""
    if scope == "row":
        return df.select("*", *aggs)
    if scope is None:
        keyed = df.withColumn("_scope", F.lit(0))
        one = keyed.groupBy("_scope").agg(*aggs)
        return join_small(keyed, one, "_scope", max_rows=1).drop("_scope")
    return null_safe_join(df, df.groupBy(scope).agg(*aggs), [scope])


def _finite(v: Column) -> Column:
    return F.filter(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _known(x: Column, q: Column) -> Column:
    """``q``, or NULL for a NULL or NaN element."""
    return F.when(x.isNotNull() & ~F.isnan(x), q)


def _scope_bounds(df: DataFrame, scope: str | None, col: str) -> DataFrame:
    """``_absmax``, ``_mn`` and ``_mx`` of the finite elements of each scope, from one aggregation."""
    v = _finite(_as_double(F.col(col)))
    parts = {"_absmax": F.array_max(F.transform(v, lambda x: F.abs(x))), "_mn": F.array_min(v), "_mx": F.array_max(v)}
    over = {"_absmax": F.max, "_mn": F.min, "_mx": F.max}
    return _scoped(df, scope, [(p if scope == "row" else over[n](p)).alias(n) for n, p in parts.items()])


def _absmax_codes(col: str) -> tuple[Column, Column]:
    scale = F.col("_absmax") / 127.0
    return scale, F.transform(_as_double(F.col(col)), lambda x: _known(x, F.greatest(F.lit(-127.0), F.least(
        F.lit(127.0), F.coalesce(F.rint(F.try_divide(x, scale)), F.when(F.abs(x) < float("inf"), 0.0).otherwise(F.signum(x) * 127.0)))).cast("tinyint")))


def _zeropoint_codes(col: str) -> tuple[Column, Column, Column]:
    rng = F.when(F.col("_mx") - F.col("_mn") == 0, F.lit(1.0)).otherwise(F.col("_mx") - F.col("_mn"))
    scale = rng / 255.0
    zero = F.rint(-F.col("_mn") / scale)
    q = F.transform(_as_double(F.col(col)), lambda x: _known(x, F.greatest(F.lit(0.0), F.least(
        F.lit(255.0), F.coalesce(F.rint(x / scale + zero), F.when(x > 0, 255.0).otherwise(0.0)))).cast("smallint")))
    return scale, zero, q


_BOUNDS = ("_absmax", "_mn", "_mx")


def absmax_quantize(df: DataFrame, scope: str | None = "label", col: str = "embedding") -> DataFrame:
    """``scale = max|x| / 127``; ``q = clamp(rint(x / scale), -127, 127)`` as
    tinyint. An all-zero scope gives scale 0 and q = 0. NULL, NaN and infinite
    elements take no part in the scale; the first two become NULL, infinities
    the nearest bound. A scope without a finite element has scale NULL."""
    scale, q = _absmax_codes(col)
    return _scope_bounds(df, scope, col).withColumn("scale", scale).withColumn("q", q).drop(*_BOUNDS)


def zeropoint_quantize(df: DataFrame, scope: str | None = "label", col: str = "embedding") -> DataFrame:
    """``range = max - min`` (1 when 0), ``scale = range / 255``,
    ``zero_point = rint(-min / scale)``, ``q = clamp(rint(x / scale + zp), 0,
    255)`` as smallint (Spark has no unsigned byte). NULL, NaN and infinite
    elements as for :func:`absmax_quantize`."""
    scale, zero, q = _zeropoint_codes(col)
    return _scope_bounds(df, scope, col).withColumn("scale", scale).withColumn("zero_point", zero).withColumn("q", q).drop(*_BOUNDS)


def quantize_both(df: DataFrame, scope: str | None = "label", col: str = "embedding") -> DataFrame:
    """``df`` with ``quantized``, an array of ``method, scale, zero_point, q,
    values`` (the codes and what they restore) for both methods, from one scan
    and one aggregation."""
    a_scale, a_q = _absmax_codes(col)
    z_scale, zero, z_q = _zeropoint_codes(col)
    coded = _scope_bounds(df, scope, col).withColumns({"_as": a_scale, "_aq": a_q, "_zs": z_scale, "_zp": zero, "_zq": z_q})
    none = F.lit(None).cast("double")
    both = F.array(
        F.struct(F.lit("absmax").alias("method"), F.col("_as").alias("scale"), none.alias("zero_point"), F.col("_aq").cast("array<smallint>").alias("q"), dequantize_absmax(F.col("_aq"), F.col("_as")).alias("values")),
        F.struct(F.lit("zeropoint").alias("method"), F.col("_zs").alias("scale"), F.col("_zp").alias("zero_point"), F.col("_zq").alias("q"), dequantize_zeropoint(F.col("_zq"), F.col("_zs"), F.col("_zp")).alias("values")))
    return coded.withColumn("quantized", both).drop(*_BOUNDS, "_as", "_aq", "_zs", "_zp", "_zq")


def dequantize_absmax(q: Column, scale: Column) -> Column:
    return F.transform(q, lambda x: x.cast("double") * scale)


def dequantize_zeropoint(q: Column, scale: Column, zero_point: Column) -> Column:
    return F.transform(q, lambda x: (x.cast("double") - zero_point) * scale)


def squared_error_sum(original: Column, restored: Column) -> Column:
    """Over the elements that both have and that are finite."""
    pairs = F.zip_with(original, restored, lambda a, b: F.when(~F.isnan(a) & (F.abs(a) < float("inf")), F.pow(a.cast("double") - b, 2)))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))


def error_count(original: Column, restored: Column) -> Column:
    """How many elements :func:`squared_error_sum` sums."""
    return F.size(F.filter(F.zip_with(original, restored, lambda a, b: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")) & b.isNotNull()), lambda ok: ok))


def embedding_lookup(ids: DataFrame, table: DataFrame, ids_col: str = "ids",
                     key: str = "doc_id", vec_id: str = "vec_id",
                     vocab_rows: int | None = None) -> DataFrame:
    """Row gather: one output row per input id with its position, keeping
    order by ``pos``; an id that the table lacks gives NULL columns. With
    ``vocab_rows`` only ids below it can occur: the table is cut to them and
    broadcast on that bound. Otherwise a shuffle join runs and AQE splits hot
    ids."""
    exploded = ids.select(key, F.posexplode(ids_col).alias("pos", vec_id))
    exploded = exploded.withColumn(vec_id, F.col(vec_id).cast("long"))
    if vocab_rows is not None:
        table = table.filter((F.col(vec_id) >= 0) & (F.col(vec_id) < vocab_rows))
    return join_small(exploded, table, vec_id, "left", max_rows=vocab_rows)


#: Ids that the sketch may name as hot; their rows are broadcast.
MOST_HOT = 1024


def hot_ids(exploded: DataFrame, vec_id: str, share: float, most: int = MOST_HOT) -> list[int]:
    """Ids that hold about ``share`` of all rows or more, by a mergeable
    frequent-items sketch: at most ``most``, whatever the data. An id missed or
    named in error changes where work is done, never the result."""
    found = exploded.agg(F.count(F.lit(1)).alias("n"), F.call_function("approx_top_k", F.col(vec_id), F.lit(most), F.lit(16 * most)).alias("top")).first()
    return sorted(r["item"] for r in found["top"] or () if r["item"] is not None and r["count"] >= share * found["n"])


def embedding_lookup_skewed(ids: DataFrame, table: DataFrame, ids_col: str = "ids", key: str = "doc_id", vec_id: str = "vec_id", share: float = 0.001) -> DataFrame:
    """:func:`embedding_lookup` for a table of any size and ids of any
    frequency. Positions of hot ids (a few ids hold most of any text) meet
    their rows by a broadcast, bounded by the sketch, and are not shuffled; the others
    are joined by a shuffle in which no id is hot. ``ids`` is read twice, so
    pass a stored table."""
    exploded = ids.select(key, F.posexplode(ids_col).alias("pos", vec_id)).withColumn(vec_id, F.col(vec_id).cast("long"))
    hot = hot_ids(exploded, vec_id, share)
    if not hot:
        return exploded.join(table, vec_id, "left")
    is_hot = F.coalesce(F.col(vec_id).isin(hot), F.lit(False))
    near = exploded.filter(is_hot).join(F.broadcast(table.filter(F.col(vec_id).isin(hot))), vec_id, "left")
    return near.unionByName(exploded.filter(~is_hot).join(table, vec_id, "left"))
