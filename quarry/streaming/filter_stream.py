"""Row-local filters over an incrementally arriving corpus.

The same DataFrame functions used in batch (quality rules, topic match,
templates) apply unchanged to a streaming DataFrame: they are stateless
projections and filters. The file source tracks which files were processed
in the checkpoint, so a restarted query resumes where it stopped and a lost
executor only re-runs its micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.session import scratch_path


def table_files(base: str, name: str) -> str:
    """The path to stream a Parquet table of a dataset folder from, whether it
    is one file or a folder of files: as a pattern, since a plain path must be
    a folder."""
    return f"{base.rstrip('/')}/{{{name}.parquet}}"


def stream_files(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """Files arriving in folder ``path`` (optionally only names matching
    ``glob``) as a streaming DataFrame with a declared schema."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_available(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                  out_path: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Apply ``transform`` to everything available now and append it to
    ``out_path`` (exactly-once file sink), then stop."""
    q = (transform(stream).writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True)
         .start(out_path))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def stream_filter(spark: SparkSession, path: str, schema: T.StructType,
                  transform: Callable[[DataFrame], DataFrame], fmt: str = "parquet",
                  out_path: str | None = None, glob: str | None = None) -> DataFrame:
    """Run ``transform`` as an available-now streaming query over the files in
    folder ``path`` and return the written result as a batch DataFrame."""
    out = out_path or scratch_path(spark, "stream-out")
    ckpt = scratch_path(spark, "stream-ckpt")
    run_available(stream_files(spark, path, schema, fmt, glob=glob), transform, out, ckpt,
                  "parquet")
    return spark.read.parquet(out)
