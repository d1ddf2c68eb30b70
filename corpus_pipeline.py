"""From raw documents to tokenised training data: the stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import curriculum, language_id, line_chunks, ngram_join, sentencepiece_bpe
from quarry.session import scratch_path

#: Bytes of an Arrow batch in the stages below; executors keep what their largest batches took.
BATCH_BYTES = 4 << 20


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches between Spark and the Python workers hold so many bytes at most; by default they hold up to 256 MB of 10,000 rows each, on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected, the classifier learned from those that name theirs."""
    _small_batches(spark)
    return language_id.accept(docs, language_id.train(docs, F.col("lang").isNotNull()))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated chunks of lines and repeated passages; one that lost lines and has no word left goes."""
    _small_batches(spark)
    return _counted(line_chunks.drop_emptied(line_chunks.dedup(docs, passages=True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near copies."""
    _small_batches(spark)
    return ngram_join.keep_one(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix takes them, whole and in training order, once for each time taken.

    By how much each source differs from its target is written to the shared folder, ``pipeline-mix-differences``.
    """
    _small_batches(spark)
    curriculum.differences(curriculum.plan(docs)).write.parquet(scratch_path(spark, "pipeline-mix-differences"))
    taken = curriculum.whole(curriculum.curriculum(curriculum.plan(docs, keep=tuple(docs.columns))))
    return _counted(taken.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the text they decode to."""
    _small_batches(spark)
    import public_tokenizers

    return sentencepiece_bpe.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), ("ids", "decoded"))


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("sentencepiece", tokenise),
]

#: Language identification is a fitted model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each but the last returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
