"""Two sinks behind one stream, each row in exactly one of them, once.

A file sink is exactly-once for one output. Kept and removed records are two,
so each micro-batch is written whole under its own number,
``batch=<n>/kept=<flag>``, and then entered in a ledger. A batch that is run
again after a crash (Spark replays the same rows under the same number) replaces
what it had written; what the ledger does not name is not read. Rows are
written in one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Annotate = Callable[[DataFrame], DataFrame]


def write_batch(annotated: DataFrame, batch: int, path: str, flag: str = "kept") -> None:
    """One batch to both sinks, then to the ledger with its row counts; a NULL flag counts as removed."""
    spark = annotated.sparkSession
    out = f"{path.rstrip('/')}/rows/batch={batch}"
    rows = annotated.withColumn(flag, F.coalesce(flag, F.lit(False)))
    rows.write.mode("overwrite").partitionBy(flag).option("ignoreNullFields", "false").option("compression", "none").json(out)
    schema = T.StructType([f for f in rows.schema.fields])
    counts = spark.read.schema(schema).json(out).groupBy(flag).count().collect() if _has_files(spark, out) else []
    found = {bool(r[flag]): r["count"] for r in counts}
    entry = spark.createDataFrame([(batch, found.get(True, 0), found.get(False, 0))], "batch long, n_kept long, n_removed long")
    entry.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/ledger/batch={batch}")


def _has_files(spark: SparkSession, path: str) -> bool:
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(fs_path) and any(s.isDirectory() for s in fs.listStatus(fs_path))


def run_two_sinks(stream: DataFrame, annotate: Annotate, path: str, checkpoint: str, flag: str = "kept") -> None:
    """Annotates everything available now and writes it to the two sinks under ``path``; run again, it goes on behind the last batch in the checkpoint."""
    query = (annotate(stream).writeStream.foreachBatch(lambda rows, batch: write_batch(rows, batch, path, flag))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """``batch, n_kept, n_removed`` of every batch that was written whole."""
    schema = "batch long, n_kept long, n_removed long"
    where = f"{path.rstrip('/')}/ledger"
    return spark.read.schema(schema).json(where) if _has_files(spark, where) else spark.createDataFrame([], schema)


def read_sinks(spark: SparkSession, path: str, schema: T.StructType, kept: bool | None = None, flag: str = "kept") -> DataFrame:
    """The records of all batches in the ledger, of both sinks or of one; ``schema`` is that of the records without the flag."""
    batches = [r["batch"] for r in ledger(spark, path).select("batch").collect()]  # one row for each micro-batch
    full = T.StructType([*schema.fields, T.StructField(flag, T.BooleanType())])
    folders = [f for f in (f"{path.rstrip('/')}/rows/batch={b}" for b in sorted(batches)) if _has_files(spark, f)]
    if not folders:
        return spark.createDataFrame([], full)
    rows = None
    for folder in folders:
        part = spark.read.schema(full).json(folder)
        rows = part if rows is None else rows.unionByName(part)
    return rows if kept is None else rows.filter(F.col(flag) == kept)
