"""JSON Lines as a Spark data source with files of bounded size and all-or-nothing writes.

``spark.read.format("quarry_jsonl")`` deals large files out by byte ranges
(a line belongs to the range in which it starts) and
``df.write.format("quarry_jsonl")`` starts a new file whenever one reaches
``maxFileBytes``. Tasks write into a hidden folder of the job; when all have
reported, the driver moves the files that their commit messages name to their
place, each under a number of its own. What a killed or repeated task left behind stays in the hidden
folder and goes with it, so a reader sees a job's files or none of them.

Paths are folders that driver and executors can open (a shared mount); for
other stores use the built-in JSON reader and writer of ``sources.tables``.
"""

from __future__ import annotations

import json
import os
import shutil
import sys
import uuid
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

NAME = "quarry_jsonl"
SPLIT_BYTES = 64 << 20
FILE_BYTES = 128 << 20


def local_path(path: str) -> str:
    """The path as ``open`` takes it."""
    if path.startswith("file:"):
        path = path.removeprefix("file:")
        return "/" + path.lstrip("/")
    if "://" in path:
        raise ValueError(f"{path}: tasks can only open paths of a mounted file system")
    return path


def register(spark: SparkSession) -> None:
    """Makes the format known to the session. Its code travels with the tasks."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(JsonLines)


class JsonLines(DataSource):
    """Options: ``path``; ``splitBytes`` to read; ``maxFileBytes`` to write. The schema must be given to read."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, self.options, overwrite)


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path, self.names, self.split = local_path(options["path"]), schema.names, int(options.get("splitBytes", SPLIT_BYTES))
        odd = [f.name for f in schema.fields if f.dataType.simpleString() not in ("string", "bigint", "int", "double", "boolean")]
        if odd:
            raise ValueError(f"columns of other types than string, bigint, int, double and boolean: {odd}")

    def partitions(self) -> list[InputPartition]:
        files = sorted(f.path for f in os.scandir(self.path) if f.is_file() and not f.name.startswith((".", "_")))
        ranges = [_Range(f, at, min(at + self.split, size)) for f in files for size in [os.path.getsize(f)] for at in range(0, size, self.split)]
        return ranges or [_Range("", 0, 0)]

    def read(self, part: InputPartition):
        if not part.path:
            return
        with open(part.path, "rb") as f:
            at = part.start
            if at:
                f.seek(at - 1)
                at = at - 1 + len(f.readline())  # the line that the range before has begun
            while at < part.end:
                line = f.readline()
                if not line:
                    return
                at += len(line)
                if line.strip():
                    row = json.loads(line)
                    yield tuple(row.get(n) for n in self.names)


@dataclass
class _Files(WriterCommitMessage):
    files: list[str]
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        self.path, self.names, self.most, self.overwrite = local_path(options["path"]), schema.names, int(options.get("maxFileBytes", FILE_BYTES)), overwrite
        self.job = uuid.uuid4().hex
        self.hidden = os.path.join(self.path, f".job-{self.job}")

    def write(self, rows) -> WriterCommitMessage:
        os.makedirs(self.hidden, exist_ok=True)
        files, out, size, n = [], None, 0, 0
        try:
            for row in rows:
                line = json.dumps(dict(zip(self.names, row)), ensure_ascii=False).encode("utf-8", "replace") + b"\n"
                if out is None or size + len(line) > self.most and size:
                    if out:
                        out.close()
                    files.append(os.path.join(self.hidden, uuid.uuid4().hex))
                    out, size = open(files[-1], "wb"), 0
                out.write(line)
                size, n = size + len(line), n + 1
        finally:
            if out:
                out.close()
        return _Files(files, n)

    def commit(self, messages) -> None:
        os.makedirs(self.path, exist_ok=True)
        before = [f.path for f in os.scandir(self.path) if f.is_file()] if self.overwrite else []
        for i, file in enumerate(f for m in messages if m is not None for f in m.files):
            os.replace(file, os.path.join(self.path, f"part-{i:06d}-{self.job}.jsonl"))
        for file in before:
            os.remove(file)
        shutil.rmtree(self.hidden, ignore_errors=True)

    def abort(self, messages) -> None:
        shutil.rmtree(self.hidden, ignore_errors=True)
