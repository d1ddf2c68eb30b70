"""Concatenate tokenised documents in order and cut fixed-size blocks.

No row per token is ever created. Documents are range-partitioned by the
order key; each one's start offset in the global stream is its partition's
offset plus a running sum inside it (``plans.ordering``). A document then emits one slice per block it
touches, keyed by ``block_id`` with its position in the block; a group-by on
``block_id`` (at most ``block_size`` tokens per group) sorts and flattens
the slices. Only the last block can be short, so dropping the tail is a
size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.tokens import append_eos
from quarry.plans.ordering import running_offsets


def pack_tokens(df: DataFrame, block_size: int = 1024, eos_id: int | None = None,
                ids: Column | str = "ids", order_col: str = "doc_id",
                n_buckets: int | None = None, lengths: Column | None = None) -> DataFrame:
    """``(block_id, tokens array<int>)``: documents in ``order_col`` order
    (NULL first), ``eos_id`` appended to each (also to empty ones),
    the stream cut into ``block_size`` blocks, the incomplete tail dropped.

    Keys may repeat or be missing: rows that tie stand in the order of a hash
    of their columns. ``lengths`` may give each document's token count without
    tokenising (e.g. ``octet_length(text)`` for byte tokens). Rows are
    range-partitioned by the key once, with their text; the token ids, an
    expression over the columns of ``df``, are built after that."""
    B = block_size
    tokens = F.col(ids) if isinstance(ids, str) else ids
    extra = 1 if eos_id is not None else 0
    count = (lengths if lengths is not None else F.size(tokens)) + F.lit(extra)
    docs = running_offsets(df.withColumn("_n", count.cast("long")), [order_col], F.col("_n"), "_off", n_buckets).select(
        "_off", "_n", (append_eos(tokens, eos_id) if eos_id is not None else tokens).alias("_ids"))
    o, n = F.col("_off"), F.col("_n")
    first, last = F.floor(o / B), F.floor((o + n - 1) / B)

    def piece(b):
        start = F.greatest(b * B - o, F.lit(0))
        end = F.least(n, (b + 1) * B - o)
        return F.struct(b.alias("block_id"), F.greatest(o - b * B, F.lit(0)).alias("at"),
                        F.slice("_ids", start + 1, end - start).alias("piece"))

    pieces = docs.select(F.inline(F.when(n > 0, F.transform(F.sequence(first, last), piece))))
    blocks = pieces.groupBy("block_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))),
                              lambda x: x["piece"])).alias("tokens"))
    return blocks.filter(F.size("tokens") == B)


def pack_report(df: DataFrame, block_size: int = 1024, eos_id: int | None = None,
                n_tokens_col: str = "n_tokens") -> DataFrame:
    """``n_docs, total_tokens, n_blocks, dropped_tokens`` from per-document
    token counts (one global aggregation, no packing needed)."""
    n = F.col(n_tokens_col) + (1 if eos_id is not None else 0)
    agg = df.agg(F.count(F.lit(1)).alias("n_docs"), F.sum(n).cast("long").alias("total_tokens"))
    return agg.select("n_docs", F.coalesce("total_tokens", F.lit(0)).alias("total_tokens"),
                      F.floor(F.coalesce("total_tokens", F.lit(0)) / block_size).cast("long")
                      .alias("n_blocks"),
                      (F.coalesce("total_tokens", F.lit(0)) % block_size).cast("long")
                      .alias("dropped_tokens"))
