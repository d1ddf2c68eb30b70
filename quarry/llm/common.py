"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import quarry.llm
from quarry.session import checkpoint_dir, scratch_path

# Kernels travel to the tasks with their code: executors need not have this package installed.
cloudpickle.register_pickle_by_value(quarry.llm)

#: Words: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
#: A kernel works on slices of about this many bytes of text, whatever the Arrow batch holds.
SLICE_BYTES = 2 << 20


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the id, the text and the named columns, under fixed names: other columns cannot clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back from it; lineage ends there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read from there: smaller than a checkpoint where rows are many and narrow."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of the batches with about ``limit`` bytes of text each (one row at least)."""
    for batch in batches:
        column, start, held = batch.column(text), 0, 0
        if column.nbytes <= limit:
            if batch.num_rows:
                yield batch
            continue
        for i, value in enumerate(column):
            size = len(value.as_buffer()) if value.is_valid else 0
            if i > start and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def map_slices(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType, text: str = "text") -> DataFrame:
    """``mapInArrow`` over slices bounded in bytes."""
    return df.mapInArrow(lambda batches: kernel(slices(batches, text)), schema)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
