"""Chat formatting after collapsing cumulative snapshots.

Logged conversations often come once for every turn, each log a prefix of
the next. Rolling hashes over the turns of each conversation identify its
prefixes; conversations that are a prefix of a longer one, or equal to one
with a smaller id, are removed by anti-joins, and the turns of those that
remain are rendered.

The rolling hash of a prefix is the sum of its turns' hashes, each taken with
its place, so a long conversation is summed over many tasks. DataFrame
functions only; texts are written once and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed
from quarry.plans.ordering import range_prefix

NO_ID = (1 << 63) - 1


def _part(digest: Column, at: int) -> Column:
    """15 hex digits of a digest as a number."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(38,0)")


def render(role: Column, text: Column) -> Column:
    """One turn between its marks; a turn without a role is the user's."""
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("user")), F.lit("\n"), F.coalesce(text, F.lit("")), F.lit("<|im_end|>\n"))


def prefixes(turns: DataFrame) -> DataFrame:
    """``rid, conv, place`` (from 1) and the rolling hash ``a, b`` up to each turn, of ``rid, conv, turn, role, digest``."""
    order = ["conv", "turn", "role", "digest", "rid"]
    at = checkpointed(range_prefix(turns, order, {"before": F.lit(1).cast("long")}).select("rid", "conv", "digest", "before"))
    start = at.groupBy("conv").agg(F.min("before").alias("start"))
    placed = at.join(start, "conv").select("rid", "conv", "before", "start", (F.col("before") - F.col("start") + 1).alias("place"), "digest")
    own = F.md5(F.concat_ws(":", F.col("place").cast("string"), "digest"))
    summed = checkpointed(range_prefix(placed.withColumn("a", _part(own, 1)).withColumn("b", _part(own, 16)), ["before"], {"sa": F.col("a"), "sb": F.col("b")}))
    base = summed.filter("before = start").select("conv", F.col("sa").alias("ba"), F.col("sb").alias("bb"))
    return summed.join(base, "conv").select("rid", "conv", "place", (F.col("sa") - F.col("ba") + F.col("a")).cast("string").alias("a"), (F.col("sb") - F.col("bb") + F.col("b")).cast("string").alias("b"))


def collapse(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, place, n_turns, rendered``: the turns, in order from 1, of the conversations that are not a prefix of another.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated
    rows are turns of their own. A null role differs from any role when
    conversations are compared and is rendered as the user's; null and empty
    text are the same. A null conversation id is a conversation, last in order.
    An empty table gives an empty result; other columns are not carried.
    """
    role, text = F.col(role_col).cast("string"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held = turns.select(F.coalesce(F.col(conv_col).cast("long"), F.lit(NO_ID)).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    held = checkpointed(held.withColumn("rid", F.monotonically_increasing_id()))
    digest = F.md5(F.concat(F.coalesce(F.concat(F.lit("r"), "role"), F.lit("n")), F.lit("\n"), "text"))
    rolled = checkpointed(prefixes(held.select("rid", "conv", "turn", "role", digest.alias("digest"))))
    lengths = rolled.groupBy("conv").agg(F.max("place").alias("n_turns"))
    marked = rolled.join(lengths, "conv")
    last = marked.filter("place = n_turns").select("conv", "n_turns", "a", "b")
    inner = marked.filter("place < n_turns").select(F.col("place").alias("n_turns"), "a", "b").distinct()
    maximal = last.join(inner, ["n_turns", "a", "b"], "left_anti").groupBy("n_turns", "a", "b").agg(F.min("conv").alias("conv"))
    places = rolled.join(maximal.select("conv", "n_turns"), "conv").select("rid", F.col("place").cast("long").alias("place"), "n_turns")
    return held.join(places, "rid").select(F.when(F.col("conv") != NO_ID, F.col("conv")).alias("conv_id"), "place", "n_turns", render(F.col("role"), F.col("text")).alias("rendered"))
