"""First-N collection that stops reading once it has enough.

A collection target ("the first 10,000 documents on a topic") needs the
smallest keys only. Each Parquet file's footer says between which keys its
rows lie; footers are read by the driver, some kilobytes a file and many at a
time. Files are then searched in the order of their smallest keys, a group at
a time and each group twice the last one's size, until the matches whose keys lie before everything
unread reach the target. A table sorted or partitioned by its key is read as
far as the target lies; on any other table all files overlap and all are read, with
the same result. Each file searched is read once: matches are written to the shared
folder, and the first N are taken from those.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path
from quarry.sources.tables import take_first


@dataclass
class FileBounds:
    """Rows of a file and its smallest key; ``low`` None: unknown, or the file has NULL keys, which come first."""
    path: str
    rows: int
    low: int | str | None


@dataclass
class Progress:
    """What a progressive scan read."""
    files: list[str] = field(default_factory=list)
    unread: list[str] = field(default_factory=list)
    groups: int = 0
    matches: int = 0


def file_bounds(df: DataFrame, key: str, threads: int = 32) -> list[FileBounds]:
    """Bounds of every Parquet file of ``df`` (a plain read of files), by smallest key, unknown first."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    text = isinstance(df.schema[key].dataType, T.StringType)

    def read(uri: str) -> FileBounds:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri)), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            rows, lows, known = 0, [], True
            for block in reader.getFooter().getBlocks():
                rows += block.getRowCount()
                for column in block.getColumns():
                    if column.getPath().toDotString() == key:
                        stats = column.getStatistics()
                        if stats is None or not stats.isNumNullsSet() or stats.getNumNulls() or not stats.hasNonNullValue():
                            known = False
                        else:
                            low = stats.genericGetMin()
                            lows.append(low.toStringUsingUTF8() if text else low)
            return FileBounds(uri, rows, min(lows) if known and lows else None)
        finally:
            reader.close()

    with ThreadPoolExecutor(threads) as pool:
        found = list(pool.map(read, df.inputFiles()))
    return sorted(found, key=lambda b: (b.low is not None, 0 if b.low is None else b.low, b.path))


def first_matching(spark: SparkSession, path: str, condition: Column, n: int, key: str = "doc_id", schema: T.StructType | None = None) -> tuple[DataFrame, Progress]:
    """The first ``n`` rows of a Parquet table in ``key`` order (NULL first)
    for which ``condition`` holds, and what was read for them. Keys are
    integers or strings; ties at the cutoff are counted off as ``take_first``
    does. Fewer matches than ``n`` are all returned."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    whole = reader.parquet(path)
    if not isinstance(whole.schema[key].dataType, (T.IntegralType, T.StringType)):
        raise ValueError(f"{key} is neither an integer nor a string")
    files = file_bounds(whole, key)
    out, progress = scratch_path(spark, "progressive"), Progress(unread=[b.path for b in files])
    place, size = 0, 1
    while place < len(files):
        upto, rows = place, 0
        while upto < len(files) and (upto - place < size or rows < n or files[upto].low is None):
            rows += files[upto].rows
            upto += 1
        group = [b.path for b in files[place:upto]]
        spark.read.schema(whole.schema).option("basePath", path).parquet(*group).filter(condition).write.parquet(f"{out}/group={progress.groups}")
        progress.files += group
        progress.unread = progress.unread[len(group):]
        progress.groups += 1
        place, size = upto, 2 * max(size, len(group))
        found = spark.read.schema(whole.schema).parquet(*[f"{out}/group={g}" for g in range(progress.groups)])
        settled = F.lit(True) if place == len(files) else F.col(key).isNull() | (F.col(key) < F.lit(files[place].low))
        progress.matches = found.filter(settled).count()
        if progress.matches >= n:
            break
    if not files:
        return whole.filter(condition).limit(0), progress
    return take_first(found, n, key), progress
