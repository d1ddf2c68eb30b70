"""The end-to-end curation job: quality rules → near-duplicate removal →
byte tokens with EOS → 1,024-token blocks → report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import text_or_empty
from quarry.operators import dedup, packing, quality, tokens
from quarry.plans.parallel import spread
from quarry.session import checkpointed
from quarry.sources.tables import table

EOS = 256
BLOCK = 1024


def curated(spark: SparkSession, base: str) -> DataFrame:
    """Quality-filtered, near-deduplicated ``(doc_id, text)``, written once to
    the shared checkpoint folder: the packing stage reads it several times
    (quantile pass, prefix sums, report) and must not redo filter + dedup."""
    docs = spread(table(spark, base, "documents")).select("doc_id", "text")
    # The filtered corpus is read twice by deduplication (signatures and the
    # final anti-join): write it once, like a stage output table.
    kept = checkpointed(quality.gopher_filter(docs))
    return checkpointed(dedup.minhash_dedup(kept))


def flagship(spark: SparkSession, base: str) -> DataFrame:
    """``n_docs, total_tokens, n_blocks, dropped_tokens, n_packed`` for the
    curated corpus; ``n_packed`` counts the blocks actually materialised."""
    docs = curated(spark, base)
    n_bytes = F.octet_length(text_or_empty("text"))
    blocks = packing.pack_tokens(docs, BLOCK, EOS, ids=tokens.byte_tokens(F.col("text")), lengths=n_bytes)
    report = packing.pack_report(docs.select(n_bytes.alias("n_tokens")), BLOCK, EOS)
    packed = blocks.agg(F.count(F.lit(1)).alias("n_packed"))
    # Both sides are single-row aggregates.
    return (report.withColumn("_k", F.lit(0))
            .join(F.broadcast(packed.withColumn("_k", F.lit(0))), "_k").drop("_k"))
