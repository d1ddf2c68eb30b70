"""Mixing sources to target weights as a time-varying curriculum.

Each source has a weight and a slope: over training time t in [0, 1] its
share of the mix is ``weight * (1 + slope * (1 - 2t))``. Integrated, that
gives the source's target (its weight's share of the budget, limited to
``max_repeats`` times its size, the excess going to the others) and the
cumulative demand ``target * (t + slope * (t - t*t))``. A document takes the
words that lie between two points of its source's cumulative supply, in a
seeded order and source by source repeated; inverting the demand at the
middle of these words gives the document's training position. Documents are
range-sorted by position.

DataFrame functions only. A source's running sums go through buckets of its
seeded order, so that a source with most rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32
from quarry.llm.common import WORD, checkpointed
from quarry.plans.ordering import range_prefix

#: Rows that a bucket of the seeded order holds on average.
BUCKET_ROWS = 20_000
WEIGHTS = (5, 2, 1)
#: Slope of each weight's schedule: heavy sources come early, light ones late.
SLOPES = (0.5, 0.0, -0.5)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, src, size``: words of the whole text; ``src`` orders by code point, null last. Columns of ``keep`` ride along in the struct ``row``."""
    source, text = F.col(source_col).cast("string"), F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("a"), source), F.lit("b")).alias("src"),
                       F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long").alias("size"),
                       *([F.struct(*keep).alias("row")] if keep else []))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES, budget: float = 1.5, max_repeats: int = 2) -> DataFrame:
    """``src, source_size, weight, slope, target`` of every source.

    Sources share ``budget`` times all words by weight; a source stops at
    ``max_repeats`` times its own. In order of the level at which sources
    stop, the level that shares out what is left rises while sources stop
    and falls afterwards: its maximum is the level at which all is shared.
    """
    by_source = sized.groupBy("src").agg(F.sum("size").alias("source_size"))
    ranked = range_prefix(by_source, ["src"], {"place": F.lit(1).cast("long")})
    turn = (F.col("place") % len(weights)).cast("int") + 1
    weighed = ranked.select("src", "source_size", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn).alias("weight"),
                            F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), turn).alias("slope"),
                            (F.col("source_size") * max_repeats).alias("most"))
    stops = weighed.withColumn("stop", F.col("most") / F.col("weight"))
    held = range_prefix(stops, ["stop", "src"], {"most_before": F.col("most"), "weight_before": F.col("weight")})
    words, weight = held.agg(F.sum("source_size"), F.sum("weight")).first()
    shared = F.lit(float((words or 0) * budget))
    level = held.agg(F.max((shared - F.col("most_before")) / (F.lit(weight or 1) - F.col("weight_before")))).first()[0]
    return held.select("src", "source_size", "weight", "slope", F.least(F.col("most").cast("double"), F.lit(float(level or 0)) * F.col("weight")).alias("target"))


def _position(done: Column, target: Column, slope: Column) -> Column:
    """The time at which the demand of a source reaches ``done`` words."""
    y, b = F.try_divide(done, target), slope + 1.0
    return F.when((slope == 0.0) | y.isNull(), y).otherwise((b - F.sqrt(F.greatest(b * b - slope * 4.0 * y, F.lit(0.0)))) / (slope * 2.0))


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
         slopes: tuple[float, ...] = SLOPES, budget: float = 1.5, max_repeats: int = 2, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, src, size, source_size, target,
    taken, copies, start``; ``copies`` lists ``(copy, words, position)`` of each time
    the mix takes words of the document, the last time perhaps only its first
    words; ``start`` counts the source's words before it. Columns named in ``keep`` follow in the struct ``row``.

    A null source is a source of its own, a null or empty text has size 0 and
    is not taken; rows with the same id and size are interchangeable; a null
    id counts as an id; an empty table gives an empty result. The words taken
    of a source are its target, rounded.
    """
    sized = checkpointed(sizes(docs, id_col, text_col, source_col))
    n_buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    key = md5_u32(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    every = sizes(docs, id_col, text_col, source_col, keep) if keep else sized
    rows = every.withColumn("key", key).withColumn("bucket", F.floor(F.col("key") * n_buckets / F.lit(2.0**32)).cast("long"))
    placing = sized.withColumn("key", key).withColumn("bucket", F.floor(F.col("key") * n_buckets / F.lit(2.0**32)).cast("long"))
    totals = placing.groupBy("src", "bucket").agg(F.sum("size").alias("words"))
    offsets = totals.select("src", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    offsets = offsets.join(targets(sized, weights, slopes, budget, max_repeats), "src")
    within = Window.partitionBy("src", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(offsets, ["src", "bucket"])
    quota, start = F.floor(F.col("target") + 0.5).cast("long"), F.col("offset") + F.col("inner")
    copies = []
    for copy in range(max_repeats):
        begin = start + F.col("source_size") * copy
        words = F.greatest(F.least(quota - begin, F.col("size")), F.lit(0))
        copies.append(F.struct(F.lit(copy).alias("copy"), words.cast("long").alias("words"), _position(begin + words / 2.0, F.col("target"), F.col("slope")).alias("position")))
    placed = placed.withColumn("copies", F.filter(F.array(*copies), lambda c: c.words > 0))
    return placed.select("doc_id", "src", "size", "source_size", "target", F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c.words).alias("taken"), "copies", start.alias("start"), *(["row"] if keep else []))


def curriculum(planned: DataFrame) -> DataFrame:
    """The mix in training order: ``position, doc_id, copy, words, size`` (and ``row``, if kept), range-sorted by position, then id and copy."""
    more = ["row"] if "row" in planned.columns else []
    copies = planned.select("doc_id", "size", *more, F.explode("copies").alias("c")).select("c.position", "doc_id", "c.copy", "c.words", "size", *more)
    return copies.repartitionByRange("position", "doc_id", "copy").sortWithinPartitions("position", "doc_id", "copy")


def numbered(planned: DataFrame) -> DataFrame:
    """The rows of ``curriculum``, with ``src``, ``start``, ``source_size``, ``target`` and their ``place`` in training order (from 1)."""
    copies = planned.select("src", "start", "doc_id", "size", "source_size", "target", F.explode("copies").alias("c")).select("*", "c.position", "c.copy", "c.words").drop("c")
    ranked = range_prefix(copies, ["position", "doc_id", "copy", "src", "start"], {"before": F.lit(1).cast("long")})
    return ranked.withColumn("place", F.col("before") + 1).drop("before")


def per_document(planned: DataFrame) -> DataFrame:
    """``doc_id, size, source_size, target, taken, n_copies, first_position, first_place, last_place``
    of every row of the plan, from the numbered mix; where the mix takes nothing the position is null and the places are 0.

    A source's words before a row tell rows apart that the mix takes, whatever their ids.
    """
    mixed = numbered(planned).groupBy("src", "start", "doc_id", "size", "source_size", "target").agg(
        F.sum("words").alias("taken"), F.count(F.lit(1)).alias("n_copies"), F.min("position").alias("first_position"), F.min("place").alias("first_place"), F.max("place").alias("last_place")).drop("src", "start")
    nothing = F.lit(0).cast("long")
    left = planned.filter(F.size("copies") == 0).select("doc_id", "size", "source_size", "target", *[nothing.alias(c) for c in ("taken", "n_copies", "first_place", "last_place")])
    return mixed.unionByName(left, allowMissingColumns=True)


def whole(taken: DataFrame) -> DataFrame:
    """The rows of ``curriculum`` with whole texts only: the copy at the end of a source's
    quota is taken whole where that comes at least as near to the quota as leaving it."""
    return taken.filter(F.col("words") * 2 >= F.col("size")).withColumn("words", F.col("size"))


def differences(planned: DataFrame) -> DataFrame:
    """``src, target, words, difference``: the words that whole copies take of each source, and by how much that is over (or under) its target."""
    words = F.aggregate(F.filter("copies", lambda c: c.words * 2 >= F.col("size")), F.lit(0).cast("long"), lambda a, c: a + F.col("size"))
    by_source = planned.groupBy("src").agg(F.first("target").alias("target"), F.sum(words).alias("words"))
    return by_source.withColumn("difference", F.col("words") - F.col("target"))


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its first ``words`` words."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1)), F.lit(1), words.cast("int")), "")
