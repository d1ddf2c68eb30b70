"""Line dedup by content-defined chunks of lines.

The lines of a text are cut into chunks: a chunk ends where a rolling hash
over the hashes of the last two lines has a certain remainder, so boundaries
depend on the lines around them alone and a shared passage is cut the same
way wherever it stands. A chunk of several lines that occurs more than once
anywhere is kept where it occurs first (smallest id, then place) and removed
elsewhere, after its bytes were compared with the first.

Chance boundaries miss what is short: a passage goes as a chunk only where two
boundaries fall inside it. With ``passages`` every run of lines with over
``PASSAGE_WORDS`` words that also occurs earlier is removed too, of one line or
many. Such a run is the union of the least runs over that size which start or
end at one of its lines, so these are compared: at most two for a line.

Three passes over the texts: hashes of all chunks (small rows); the text of
chunks whose hash is repeated, found through a bitmap; the rewriting. Only
repeated chunks and, once, the documents are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quarry.llm.bitmaps import bitmap, inside
from quarry.llm.common import WORD_RE, checkpointed, fresh, map_slices

#: A chunk ends with one line in so many, on average.
CHUNK_LINES = 4
#: Lines with a word that a removable chunk has at least.
LEAST_LINES = 2
#: A run of lines with more words than this is a passage.
PASSAGE_WORDS = 50
BITS = 24
NO_ID = (1 << 63) - 1


def chunks(text: str) -> list[list[str]]:
    """The lines of a text, chunk by chunk."""
    out: list[list[str]] = [[]]
    before = 0
    lines = text.split("\n")
    for i, line in enumerate(lines):
        own = int(hashlib.md5(line.encode("utf-8", "replace")).hexdigest()[:8], 16)
        out[-1].append(line)
        if ((before * 31 + own) >> 8) % CHUNK_LINES == 0 and i + 1 < len(lines):
            out.append([])
        before = own
    return out


def _removable(chunk: list[str]) -> bool:
    return len(chunk) >= LEAST_LINES and sum(1 for line in chunk if WORD_RE.search(line)) >= LEAST_LINES


def _hash(chunk: list[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(chunk).encode("utf-8", "replace")) - (1 << 63)


def windows(lines: list[str]) -> list[tuple[int, int]]:
    """First and last line of the least runs with over ``PASSAGE_WORDS`` words, from each line on and up to each line."""
    upto = [0]
    for line in lines:
        upto.append(upto[-1] + sum(1 for _ in WORD_RE.finditer(line)))
    out, last, first = set(), 0, 0
    for i in range(len(lines)):
        while last < len(lines) and upto[last + 1] - upto[i] <= PASSAGE_WORDS:
            last += 1
        if last < len(lines):
            out.add((i, last))
        while upto[i + 1] - upto[first + 1] > PASSAGE_WORDS:
            first += 1
        if upto[i + 1] - upto[first] > PASSAGE_WORDS:
            out.add((first, i))
    return sorted(out)


def units(text: str, passages: bool) -> list[tuple[int, int, int]]:
    """``(hash, first line, last line)`` of what goes where it is repeated."""
    out, at = [], 0
    for chunk in chunks(text):
        if _removable(chunk):
            out.append((_hash(chunk), at, at + len(chunk) - 1))
        at += len(chunk)
    if passages:
        lines = text.split("\n")
        own = np.array([_hash([line]) for line in lines], np.int64)
        out += [(xxhash.xxh3_64_intdigest(own[a:b + 1].tobytes()) - (1 << 63), a, b) for a, b in windows(lines)]
    return out


def _slots(hashes: np.ndarray) -> np.ndarray:
    return hashes >> (64 - BITS) & ((1 << BITS) - 1)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """The rows of ``docs``, all columns, with ``text`` without repeated chunks, and a struct ``_lines``: ``n_lines, n_removed``.

    With ``passages``, also without repeated runs of lines with over ``PASSAGE_WORDS`` words; a run that overlaps its own first occurrence loses only what lies behind that.

    Null text counts as empty for the counts and stays null; rows with the same
    id and text are one document, so they do not remove each other's chunks; a
    null id comes last; ties of one id with different texts are broken by the
    text's hash; an empty table gives an empty result; an input column named
    ``_lines`` is replaced.
    """
    read = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), F.col(text_col).alias("text"))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, b, p, h) for i, b, t in zip(*(batch.column(x).to_pylist() for x in ("id", "body", "text"))) if t and (passages or "\n" in t) for h, p, _ in units(t, passages)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], [], []))], names=["id", "body", "place", "hash"])

    every = checkpointed(map_slices(read, survey, "id bigint, body bigint, place bigint, hash bigint"))
    firsts = every.groupBy("hash").agg(F.min(F.struct("id", "body", "place")).alias("first"), F.max(F.struct("id", "body", "place")).alias("last")).filter("first != last").select("hash", "first")
    firsts = checkpointed(firsts)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(firsts.select(F.expr(f"shiftrightunsigned(hash, {64 - BITS})").alias("slot")), BITS))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, b, t in zip(*(batch.column(x).to_pylist() for x in ("id", "body", "text"))):
                if t and (passages or "\n" in t):
                    found, lines = units(t, passages), t.split("\n")
                    hit = inside(shared.value, _slots(np.array([h for h, _, _ in found], np.int64)))
                    rows += [(i, b, p, q, h, "\n".join(lines[p:q + 1])) for (h, p, q), yes in zip(found, hit.tolist()) if yes]
            columns = list(zip(*rows)) if rows else [[], [], [], [], [], []]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())], names=["id", "body", "place", "upto", "hash", "chunk"])

    held = map_slices(read, fetch, "id bigint, body bigint, place bigint, upto bigint, hash bigint, chunk string").join(firsts, "hash")
    held = checkpointed(held.withColumn("is_first", F.struct("id", "body", "place") == F.col("first")).drop("first"))
    first = held.filter("is_first").select("hash", F.col("chunk").alias("kept"), F.struct("id", "body").alias("home"), F.col("upto").alias("home_upto")).distinct()
    removed = held.filter("NOT is_first").join(first, "hash").filter(F.col("chunk") == F.col("kept"))
    begin = F.when(F.struct("id", "body") == F.col("home"), F.greatest("place", F.col("home_upto") + 1)).otherwise(F.col("place"))
    places = removed.groupBy("id", "body").agg(F.collect_set(F.struct(begin.alias("place"), "upto")).alias("_places"))  # of one document
    docs = docs.drop("_lines")
    own_id, own_body, own_places = fresh(docs, "_id", "_body", "_places")
    marked = docs.withColumn(own_id, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn(own_body, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = marked.join(places.toDF(own_id, own_body, own_places), [own_id, own_body], "left").select(*docs.columns, own_places)
    names = list(docs.columns)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, total, gone = [], [], []
            for t, places in zip(batch.column(text_col).to_pylist(), batch.column(own_places).to_pylist()):
                total.append((t or "").count("\n") + 1)
                drop = {i for p in places or () for i in range(p["place"], p["upto"] + 1)}
                gone.append(len(drop))
                texts.append("\n".join(line for i, line in enumerate(t.split("\n")) if i not in drop) if drop else t)
            lines = pa.StructArray.from_arrays([pa.array(total, pa.int64()), pa.array(gone, pa.int64())], names=["n_lines", "n_removed"])
            arrays = [pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*arrays, lines], names=[*names, "_lines"])

    counts = StructType().add("n_lines", "long").add("n_removed", "long")
    schema = StructType([*docs.schema.fields, StructField("_lines", counts)])
    return map_slices(joined, rewrite, schema, text_col)


def drop_emptied(deduped: DataFrame, text_col: str = "text") -> DataFrame:
    """Without ``_lines`` and without the documents that lost lines and have no word left."""
    lost = (F.col("_lines.n_removed") > 0) & ~F.rlike(F.coalesce(text_col, F.lit("")), F.lit(WORD_RE.pattern))
    return deduped.filter(~lost).drop("_lines")
