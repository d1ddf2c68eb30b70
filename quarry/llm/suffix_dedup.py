"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also starts earlier.

Which positions can match is found first. In every window of ``LENGTH`` bytes
the least hash of its ``GRAM``-byte strings is the window's anchor; equal
windows have equal anchors at equal offsets. The consecutive windows that
share one anchor are a cell. Anchors that occur once in the corpus match
nothing. Identical cells are one class: all but its first are covered whole.

The distinct cells of an anchor can still share windows. They are dealt by
anchor into shards of bounded size. In each shard a suffix array is made by
Larsson-Sadakane refinement (ranks double in depth, only unsorted groups are
sorted again), neighbours' common prefixes follow by Kasai's inequality, and
of windows that share ``LENGTH`` bytes all but the earliest are covered. An
anchor with more distinct cells than a shard holds is split over several;
these hand on their distinct windows in order, which are merged by binary
search, dealt by content so that no group grows with the anchor.

Everything is judged on the input. Passes over the texts go through bitmaps
sized by the number of their entries, so apart from candidates the texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.bitmaps import bitmap, inside
from quarry.llm.common import checkpointed, map_slices, written

LENGTH, GRAM = 100, 32
SPAN = LENGTH - GRAM + 1
#: Bytes of cells in a shard; sorting takes about 120 bytes of memory for each.
SHARD_BYTES = 1 << 20
#: Texts are hashed together up to about so many bytes, which a processor's cache holds.
BLOCK_BYTES = 1 << 17
#: The bitmaps have 16 bits for each entry, up to two to this power.
MOST_BITS = 28
NO_ID = (1 << 63) - 1
#: Stands for a whole text among the places of its cells.
WHOLE = -1
#: Kasai's inequality carries a common prefix over so many positions before it is measured anew.
STRIDE = 32


def _slide(h: np.ndarray, width: int, f) -> np.ndarray:
    """``f`` over every ``width`` consecutive entries."""
    n = 1
    while 2 * n <= width:
        h = f(h[:-n], h[n:])
        n *= 2
    return f(h[: len(h) - (width - n)], h[width - n:]) if width > n else h


def cells_of(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text (place in the list), anchor hash, first and last window start of each cell, text by text."""
    parts, start, held = [], 0, 0
    for i, raw in enumerate(raws):
        held += len(raw)
        if held >= BLOCK_BYTES or i + 1 == len(raws):
            parts.append(_block_cells(raws[start:i + 1], start))
            start, held = i + 1, 0
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    text, anchor, first, last = (np.concatenate(c) for c in zip(*parts))
    return text, anchor, first, last


def _block_cells(raws: list[bytes], number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of texts that lie end to end; a window never leaves its text."""
    lens = np.fromiter(map(len, raws), np.int64, len(raws))
    ends = np.cumsum(lens)
    windows = np.maximum(lens - LENGTH + 1, 0)
    if not windows.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, factor, n = np.frombuffer(b"".join(raws), np.uint8).astype(np.uint64) + np.uint64(1), np.uint64(0x9E3779B97F4A7C15), 1
    with np.errstate(over="ignore"):
        while n < GRAM:
            h, factor, n = h[:-n] * factor + h[n:], factor * factor, 2 * n
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    least = _slide(h, SPAN, np.minimum)
    edge = np.zeros(SPAN - 1, np.uint64)
    anchors = np.flatnonzero(h == _slide(np.concatenate([edge, least, edge]), SPAN, np.maximum)[: len(h)])  # least of some window
    place = np.repeat(np.arange(len(anchors) + 1), np.diff(np.r_[-1, anchors, len(h) - 1]))[: len(least)]  # the first anchor from each window's start on
    at = anchors[place]
    wrong = np.flatnonzero(h[at] != least)
    while len(wrong):  # the leftmost anchor in the window that has its least hash
        place[wrong] += 1
        at[wrong] = anchors[place[wrong]]
        wrong = wrong[h[at[wrong]] != least[wrong]]
    cut = np.r_[True, at[1:] != at[:-1]]
    inner = np.cumsum(np.bincount(ends - lens, windows > 0, len(least) + 1) - np.bincount(ends - lens + windows, windows > 0, len(least) + 1))[: len(least)] > 0
    outer = np.flatnonzero(~inner)
    cut[outer] = True
    cut[outer[outer + 1 < len(cut)] + 1] = True
    first = np.flatnonzero(cut)
    last = np.r_[first[1:], len(least)] - 1
    first, last = first[inner[first]], last[inner[first]]
    text = np.searchsorted(ends, first, "right")
    begin = (ends - lens)[text]
    return text + number, h[at[first]].view(np.int64), first - begin, last - begin


def _cell_hashes(raws: list[bytes], text: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(raws[t][a:b + LENGTH]) for t, a, b in zip(text.tolist(), first.tolist(), last.tolist())], np.uint64).view(np.int64)


def _bits(entries: int, most_bits: int) -> int:
    return max(16, min(most_bits, (16 * entries).bit_length()))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _cell_slots(doc: np.ndarray, body: np.ndarray, first: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + body.view(np.uint64) + first.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    for i, b, t in zip(batch.column("id").to_pylist(), batch.column("body").to_pylist(), batch.column("text").to_pylist()):
        yield i, b, (t or "").encode("utf-8", "replace")


def _batch(columns: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def suffix_array(symbols: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of the strings that start there, compared over at least ``depth`` symbols or up to their cell's end (``ends``); equal ones by place."""
    n = len(symbols)
    at = np.arange(n)
    h, bits = 7, n.bit_length()  # symbols of 9 bits in a first key
    padded = np.concatenate([symbols.astype(np.int64) + 1, np.zeros(h, np.int64)])
    packed = np.zeros(n, np.int64)
    for k in range(h):
        packed <<= 9
        packed += padded[k:k + n]
    tail = np.flatnonzero(ends - at < h)
    packed[tail] &= -1 << (9 * (h - (ends - at)[tail]))  # nothing behind a cell's end
    order = np.argsort(packed)
    packed = packed[order]
    new = np.r_[True, packed[1:] != packed[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    while h < depth:
        open_ = np.flatnonzero(~(new & np.r_[new[1:], True]))  # places in unsorted groups
        if not len(open_):
            break
        who = order[open_]
        key = np.where(who + h < ends[who], rank[np.minimum(who + h, n - 1)] + np.int64(1), 0)
        group = np.cumsum(new[open_]) - 1
        if int(group[-1]).bit_length() + 2 * bits <= 63:  # group, key and place in one number
            one = np.sort(((group << bits) | key) << bits | who)
            who, key = one & ((1 << bits) - 1), one >> bits
            fresh = np.r_[True, key[1:] != key[:-1]]
        else:
            by = np.lexsort((who, key, group))
            who, key, group = who[by], key[by], group[by]
            fresh = np.r_[True, (group[1:] != group[:-1]) | (key[1:] != key[:-1])]
        order[open_] = who
        new[open_] = fresh
        rank[who] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(open_)), 0))]
        h *= 2
    return order


def common_prefixes(symbols: np.ndarray, ends: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in the order, the common prefix (up to ``most``) with the place before, within the cells.

    By Kasai's inequality: with the string before it in order, position i + 1
    shares at least what position i shares, less one. ``STRIDE`` positions
    apart, these chains run side by side.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    length = np.zeros(n, np.int64)
    for step in range(STRIDE):
        i = np.arange(step, n, STRIDE)
        if not len(i):
            break
        j = before[i]
        size = np.maximum(length[i - 1] - 1, 0) if step else np.zeros(len(i), np.int64)
        limit = np.where(j >= 0, np.minimum(np.minimum(ends[i] - i, ends[j] - j), most), 0)
        size = np.minimum(size, limit)
        going = np.flatnonzero(size < limit)
        while len(going):
            same = symbols[i[going] + size[going]] == symbols[j[going] + size[going]]
            going = going[same]
            size[going] += 1
            going = going[size[going] < limit[going]]
        length[i] = size
    return length[order]


def _repeats(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of cells in the order of their places: symbols, cell ends, window starts that repeat an earlier window, and the window starts that are the first of their content in content's order."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    symbols = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.repeat(np.cumsum(lens), lens)
    order = suffix_array(symbols, ends, int(lens.max()))  # whole cells: Kasai's inequality needs the full order
    windows = ends[order] - order >= LENGTH
    length = common_prefixes(symbols, ends, order, LENGTH)
    # Between two windows that share LENGTH bytes only such windows stand.
    order, length = order[windows], length[windows]
    start = np.flatnonzero(np.r_[True, length[1:] < LENGTH]) if len(order) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(order, start) if len(order) else order
    repeated = order != np.repeat(least, np.diff(np.r_[start, len(order)])) if len(order) else np.zeros(0, bool)
    return symbols, ends, np.sort(order[repeated]), least


def _runs(marks: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive marks in one cell."""
    if not len(marks):
        return marks, marks
    cut = np.flatnonzero((np.diff(marks) != 1) | (cell[1:] != cell[:-1]))
    return marks[np.r_[0, cut + 1]], marks[np.r_[cut, len(marks) - 1]]


def shard_repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: spans of the windows that repeat earlier ones, and, of an anchor in several shards, the distinct windows (``window``) in order."""
    pdf = pdf.astype({"lo": np.int64}).drop_duplicates(["id", "body", "lo"]).sort_values(["id", "body", "lo"], ignore_index=True)
    texts = pdf["raw"].tolist()
    symbols, ends, marks, least = _repeats(texts)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(lens) - lens
    doc, body, lo = pdf["id"].to_numpy(), pdf["body"].to_numpy(), pdf["lo"].to_numpy()
    cell = np.searchsorted(begin, marks, "right") - 1
    a, b = _runs(marks, cell)
    of = np.searchsorted(begin, a, "right") - 1
    out = pd.DataFrame({"hash": 0, "id": doc[of], "body": body[of], "start": a - begin[of] + lo[of], "end": b - begin[of] + lo[of] + LENGTH, "window": None, "sub": 0})
    if pdf["parts"].iloc[0] > 1 and len(least):
        of = np.searchsorted(begin, least, "right") - 1
        whole = symbols.tobytes()
        start = least - begin[of] + lo[of]
        out = pd.concat([out, pd.DataFrame({"hash": pdf["hash"].to_numpy()[of], "id": doc[of], "body": body[of], "start": start, "end": start + LENGTH, "window": [whole[p:p + LENGTH] for p in least.tolist()], "sub": pdf["sub"].iloc[0]})])
    return out


def merge_shards(pdf: pd.DataFrame) -> pd.DataFrame:
    """The distinct windows of several shards of one anchor (``sub``): each shard's, in order, are searched in what the shards before it hold; of equal ones the later is covered."""
    out = []
    held, where = np.zeros(0, f"S{LENGTH + 1}"), np.zeros((0, 3), np.int64)
    for _, part in pdf.sort_values(["sub", "window"], ignore_index=True).groupby("sub", sort=True):
        mine = np.array([w + b"\x01" for w in part["window"]], f"S{LENGTH + 1}")  # a last byte that is not cut off as padding
        place = part[["id", "body", "start"]].to_numpy(np.int64)
        at = np.searchsorted(held, mine)
        known = np.zeros(len(mine), bool)
        if len(held):
            known = held[np.minimum(at, len(held) - 1)] == mine
        for i in np.flatnonzero(known).tolist():
            first, later = sorted([tuple(where[at[i]]), tuple(place[i])])
            where[at[i]] = first
            if first != later:
                out.append(later)
        held, where = np.insert(held, at[~known], mine[~known]), np.insert(where, at[~known], place[~known], axis=0)
    rows = np.array(out, np.int64).reshape(-1, 3)
    return pd.DataFrame({"id": rows[:, 0], "body": rows[:, 1], "start": rows[:, 2], "end": rows[:, 2] + LENGTH})


def covered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, most_bits: int = MOST_BITS) -> DataFrame:
    """``id, body, start, end`` of covered spans (they may overlap); see ``dedup``."""
    read = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"), F.col(text_col).alias("text"))
    broadcast = docs.sparkSession.sparkContext.broadcast

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, times = np.unique(cells_of([raw for _, _, raw in _rows(batch)])[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(np.minimum(times, 2).astype(np.int8))], names=["hash", "times"])

    anchors = written(map_slices(read, survey, "hash bigint, times byte").groupBy("hash").agg(F.sum("times").alias("times")).filter("times > 1").select("hash"), "anchors")
    anchor_bits = _bits(anchors.count(), most_bits)
    repeated = broadcast(bitmap(anchors.select(F.expr(f"shiftrightunsigned(hash, {64 - anchor_bits})").alias("slot")), anchor_bits))

    cell_schema = pa.schema([("hash", pa.int64()), ("cell", pa.int64()), ("id", pa.int64()), ("body", pa.int64()), ("lo", pa.int32()), ("more", pa.int32()), ("again", pa.bool_())])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted(_rows(batch), key=lambda row: row[:2])
            text, anchor, lo, hi = cells_of([raw for _, _, raw in rows])
            hit = np.flatnonzero(inside(repeated.value, _slots(anchor, anchor_bits)))
            if len(hit):
                text, anchor, lo, hi = text[hit], anchor[hit], lo[hit], hi[hit]
                own = _cell_hashes([raw for _, _, raw in rows], text, lo, hi)
                ids, bodies = (np.array(c, np.int64)[text] for c in zip(*(row[:2] for row in rows)))
                more = hi - lo
                # Of equal cells in these texts, which stand in order, all but the first are covered, whatever other texts hold.
                by = np.lexsort((own, anchor))
                start = np.r_[True, (anchor[by[1:]] != anchor[by[:-1]]) | (own[by[1:]] != own[by[:-1]])]
                first = by[np.flatnonzero(start)[np.cumsum(start) - 1]]
                again = np.zeros(len(by), bool)
                again[by] = (ids[by] != ids[first]) | (bodies[by] != bodies[first]) | (lo[by] != lo[first])
                new = ~again
                yield _batch([anchor[new], own[new], ids[new], bodies[new], lo[new], more[new], again[new]], cell_schema)
                # Their spans, joined where they touch (the cells of a text stand in order).
                ids, bodies, lo, end = ids[again], bodies[again], lo[again], (lo + more)[again] + LENGTH
                if len(ids):
                    cut = np.r_[True, (ids[1:] != ids[:-1]) | (bodies[1:] != bodies[:-1]) | (lo[1:] > end[:-1]) | (lo[1:] < lo[:-1])]
                    start = np.flatnonzero(cut)
                    size = np.maximum.reduceat(end, start) - lo[start] - LENGTH
                    key = ids[start] * 1_000_003 + lo[start]  # these meet nothing: any key that spreads them
                    yield _batch([key, np.zeros(len(start), np.int64), ids[start], bodies[start], lo[start], size, np.ones(len(start), bool)], cell_schema)

    found = map_slices(read, candidates, "hash bigint, cell bigint, id bigint, body bigint, lo int, more int, again boolean")
    order = Window.partitionBy("hash", "cell", "again").orderBy("id", "body", "lo")  # a row for each slice of texts that has the cell
    own_place = F.struct("id", "body", "lo")
    later = F.col("again") | (own_place != F.first(own_place).over(order))
    judged = written(found.withColumn("later", later).select(F.when(~F.col("later"), F.col("hash")).alias("hash"), "id", "body", "lo", "more", "later"), "cells")
    firsts = judged.filter("NOT later")
    several = firsts.groupBy("hash").agg(F.sum(F.col("more").cast("long") + LENGTH).alias("bytes"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    several = checkpointed(several.select("hash", F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("parts"), "bytes"))
    needed = written(firsts.join(several, "hash").select("hash", "id", "body", "lo", "parts"), "needed")
    total = several.agg(F.sum("bytes")).first()[0] or 0
    n_shards = max(1, -(-total // shard_bytes))

    cell_bits = _bits(2 * needed.count(), most_bits)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, b, lo = (np.asarray(batch.column(c)).astype(np.int64) for c in ("id", "body", "lo"))
            both = np.concatenate([_cell_slots(i, b, lo, cell_bits), np.unique(_cell_slots(i, b, np.full(len(lo), WHOLE), cell_bits))])
            yield pa.RecordBatch.from_arrays([pa.array(both)], names=["slot"])

    wanted = broadcast(bitmap(needed.select("id", "body", "lo").mapInArrow(slots, "slot bigint"), cell_bits))

    raw_schema = pa.schema([("hash", pa.int64()), ("id", pa.int64()), ("body", pa.int64()), ("lo", pa.int32()), ("raw", pa.binary())])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(_rows(batch))
            if not rows:
                continue
            ids, bodies = (np.array(c, np.int64) for c in zip(*(row[:2] for row in rows)))
            some = np.flatnonzero(inside(wanted.value, _cell_slots(ids, bodies, np.full(len(rows), WHOLE), cell_bits)))
            ids, bodies, raws = ids[some], bodies[some], [rows[k][2] for k in some.tolist()]
            text, anchor, lo, hi = cells_of(raws)
            hit = np.flatnonzero(inside(repeated.value, _slots(anchor, anchor_bits)))
            hit = hit[inside(wanted.value, _cell_slots(ids[text[hit]], bodies[text[hit]], lo[hit], cell_bits))]
            if len(hit):
                text, anchor, lo, hi = text[hit], anchor[hit], lo[hit], hi[hit]
                yield _batch([anchor, ids[text], bodies[text], lo, [raws[t][s:e + LENGTH] for t, s, e in zip(text.tolist(), lo.tolist(), hi.tolist())]], raw_schema)

    # Anchors that fit share shards by hash; a larger one has shards of its own.
    texts = map_slices(read, fetch, "hash bigint, id bigint, body bigint, lo int, raw binary").join(needed.select("hash", "id", "body", "lo", "parts"), ["hash", "id", "body", "lo"])
    sub = F.pmod(F.xxhash64("id", "body", "lo"), F.col("parts")).cast("int")
    dealt = texts.withColumn("sub", sub).withColumn("shard", F.when(F.col("parts") > 1, F.concat_ws(":", "hash", "sub")).otherwise(F.pmod(F.col("hash"), F.lit(n_shards)).cast("string")))
    made = checkpointed(dealt.groupBy("shard").applyInPandas(shard_repeats, "hash bigint, id bigint, body bigint, start bigint, end bigint, window binary, sub int"))
    large = several.filter("parts > 1").select("hash", "parts")
    merging = made.filter("window IS NOT NULL").join(large, "hash")
    # A window stands in one row for each shard that has it; windows of one content meet.
    merged = merging.groupBy("hash", F.pmod(F.xxhash64("window"), F.col("parts")).alias("deal")).applyInPandas(merge_shards, "id bigint, body bigint, start bigint, end bigint")

    spans = judged.filter("later").select("id", "body", F.col("lo").cast("long").alias("start"), (F.col("lo") + F.col("more") + LENGTH).cast("long").alias("end"))
    return spans.union(made.filter("window IS NULL").select("id", "body", "start", "end")).union(merged)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, most_bits: int = MOST_BITS) -> DataFrame:
    """``doc_id, spans, kept, n_bytes, n_removed``: covered byte spans (maximal, in order) and the remaining bytes of every row.

    Null text counts as empty; texts of under ``LENGTH`` bytes keep all; of
    equal texts the one with the smallest id stays; rows with the same id and
    text are one document and stay repeated; a null id comes last; of one id
    with different texts the order is that of the texts' hashes; an empty table
    gives an empty result; other columns are not carried.
    """
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spans = covered(read, "doc_id", "text", shard_bytes, most_bits).groupBy("id", "body").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # of one document
    marked = read.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("body", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = marked.join(spans, ["id", "body"], "left").select("doc_id", "text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "spans"))):
                raw = (text or "").encode("utf-8", "replace")
                joint: list[list[int]] = []
                for s, e in sorted((x["start"], x["end"]) for x in spans or ()):
                    if joint and s <= joint[-1][1]:
                        joint[-1][1] = max(joint[-1][1], e)
                    else:
                        joint.append([s, e])
                kept = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in joint)], [*(s for s, _ in joint), len(raw)]))
                out.append((doc_id, [{"start": s, "end": e} for s, e in joint], kept, len(raw), len(raw) - len(kept)))
            yield _batch(list(zip(*out)), pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64())]))

    return map_slices(joined, cut, "doc_id bigint, spans array<struct<start: bigint, end: bigint>>, kept binary, n_bytes bigint, n_removed bigint")
