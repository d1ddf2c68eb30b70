"""Readers for the corpus tables (Parquet, JSON Lines)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """One Parquet table of a dataset folder; Catalyst prunes its columns and
    pushes filters into the scan."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def read_corpus(spark: SparkSession, path: str, fmt: str = "parquet",
                id_key: str = "doc_id", text_key: str = "text",
                where: Column | str | None = None,
                schema: T.StructType | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Read a corpus and expose it as ``id, text`` (+ carried columns).

    ``where`` (e.g. a language or split predicate) is applied before the
    projection so it reaches the Parquet scan as a pushed filter.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(path)
    if where is not None:
        df = df.filter(where)
    cols = [F.col(id_key).alias("id"),
            F.coalesce(F.col(text_key), F.lit("")).alias("text")]
    return df.select(*cols, *keep)


def take_first(df: DataFrame, n: int, order_by: str = "doc_id") -> DataFrame:
    """The first ``n`` rows in key order (NULL first). The cutoff key is found
    on keys alone, then a filter takes the records, so no full record is
    gathered; only if several rows share the cutoff are rows counted off."""
    keys = df.select(F.col(order_by).alias("_k")).orderBy("_k").limit(n)
    got = keys.agg(F.max("_k").alias("cut"), F.count("_k").alias("set"), F.count(F.lit(1)).alias("rows")).first()
    if got["rows"] < n:
        return df
    key = F.col(order_by)
    if got["cut"] is None:
        return df.filter(key.isNull()).limit(n)
    first = df.filter(key.isNull() | (key <= F.lit(got["cut"])))
    return first if first.count() == n else first.orderBy(order_by).limit(n)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, nulls written as ``null`` and non-ASCII text
    kept as is."""
    (df.write.mode(mode).option("ignoreNullFields", "false")
       .option("compression", "none").json(path))


def write_kept_removed(annotated: DataFrame, path: str, flag: str = "kept", mode: str = "overwrite") -> None:
    """Kept and removed records as JSON Lines in one pass: folders
    ``kept=true`` and ``kept=false`` under ``path``; a NULL flag counts as
    removed."""
    (annotated.withColumn(flag, F.coalesce(flag, F.lit(False))).write.mode(mode).partitionBy(flag)
     .option("ignoreNullFields", "false").option("compression", "none").json(path))


def read_jsonl(spark: SparkSession, path: str,
               schema: T.StructType = DOCUMENT_SCHEMA,
               text_key: str = "text") -> DataFrame:
    """JSON Lines with a declared schema; a missing text reads as ``''``. A
    malformed line is kept in ``_corrupt_record`` with all other columns NULL
    (its text too, so it is not an empty document); ``corrupt_rows`` and
    ``sound_rows`` split the two."""
    full = T.StructType(schema.fields + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(full).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))
    if text_key in schema.fieldNames():
        filled = F.coalesce(F.col(text_key), F.lit(""))
        df = df.withColumn(text_key, F.when(F.col("_corrupt_record").isNull(), filled))
    return df


def sound_rows(read: DataFrame) -> DataFrame:
    return read.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def corrupt_rows(read: DataFrame) -> DataFrame:
    return read.filter(F.col("_corrupt_record").isNotNull()).select("_corrupt_record")
