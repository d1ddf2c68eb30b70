"""Byte-level tokens and byte-pair encoding.

Training holds a token sequence as a *symbol string*: one character per
token, code point = token id (ids at or above 0xD800 are shifted past the
surrogate block). Bytes become symbols with a Latin-1 decode of the UTF-8
bytes, so a document's byte ids cost one built-in call. A merge
``(l, r) -> new`` is ``replace(s, chr(l) || chr(r), chr(new))``: the
built-in replace scans left to right and never overlaps, which is exactly
the merge rule (``aaa`` with ``(a, a)`` gives ``Xa``). Each round counts the
adjacent pairs in Arrow batches (overlapping pairs counted), sums them in a
hash aggregation and sends one pair to the driver.

Encoding and decoding take merge tables of any size: Arrow UDFs with the
table as a broadcast variable. Encoding keeps, for a batch of texts, the
places of every pair by merge rank and works through the ranks in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import text_or_empty
from quarry.plans.parallel import spread
from quarry.session import checkpointed

SURROGATE_LO, SURROGATE_HI = 0xD800, 0xE000
#: Up to so many possible pairs are counted in a table with a place for each.
DENSE_PAIRS = 1 << 20
#: Rows of pair sums that a task holds before it adds them up.
HELD_PAIRS = 1 << 18


def symbol(token_id: int) -> str:
    """The character that stands for ``token_id`` in a symbol string."""
    return chr(token_id if token_id < SURROGATE_LO else token_id + (SURROGATE_HI - SURROGATE_LO))


def byte_symbols(text: Column) -> Column:
    """UTF-8 bytes of the text, one Latin-1 character per byte."""
    return F.decode(F.encode(text_or_empty(text), "UTF-8"), "ISO-8859-1")


def symbol_ids(sym: Column) -> Column:
    """Token ids of a symbol string (``array<int>``)."""
    cps = F.transform(F.split(sym, ""), lambda ch: F.ascii(ch))
    ids = F.transform(cps, lambda cp: F.when(cp >= SURROGATE_HI,
                                             cp - (SURROGATE_HI - SURROGATE_LO)).otherwise(cp))
    return F.when(sym == "", F.array().cast("array<int>")).otherwise(ids)


def byte_tokens(text: Column) -> Column:
    """``list(text.encode('utf-8'))`` as ``array<int>``."""
    return symbol_ids(byte_symbols(text))


@dataclass(frozen=True)
class Merge:
    rank: int
    left: int
    right: int
    new_id: int


def apply_merges(sym: Column, merges: list[Merge]) -> Column:
    """Encode: apply merges in rank order to a symbol string."""
    out = sym
    for m in sorted(merges, key=lambda m: m.rank):
        out = F.replace(out, F.lit(symbol(m.left) + symbol(m.right)), F.lit(symbol(m.new_id)))
    return out


def _encode_kernel(shared, specials: list[tuple[bytes, int]]):
    """Texts to ids. A closure, so executors need not import this package."""

    def split_specials(raw: bytes):
        """``raw`` cut at special strings: bytes, or the id of a special."""
        parts = [raw]
        for mark, tid in specials:
            out = []
            for part in parts:
                pieces = part.split(mark) if isinstance(part, bytes) else [part]
                for i, piece in enumerate(pieces):
                    out += [tid, piece] if i else [piece]
            parts = out
        return parts

    def run(texts):
        import heapq
        import re

        import numpy as np
        import pyarrow as pa
        left, right, new = shared.value
        table = {}
        for rank, (l, r) in enumerate(zip(left.tolist(), right.tolist())):
            table.setdefault(l << 32 | r, rank)
        keys = np.array(sorted(table), np.int64)
        ranks = np.array([table[k] for k in keys.tolist()], np.int64)
        marks = re.compile(b"|".join(re.escape(m) for m, _ in specials)) if specials else None
        ids, lens = [], []
        for t in texts.to_pylist():
            raw = (t or "").encode("utf-8", "replace")
            if marks and marks.search(raw):
                pieces = [np.frombuffer(p, np.uint8).astype(np.int64) if isinstance(p, bytes) else np.array([p]) for p in split_specials(raw)]
                ids.append(np.concatenate(pieces))
            else:
                ids.append(np.frombuffer(raw, np.uint8).astype(np.int64))
            lens.append(len(ids[-1]))
        sym = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        ends = np.cumsum(lens)
        n = len(sym)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        if n:
            last = ends[np.array(lens) > 0] - 1
            nxt[last] = -1
            prv[np.r_[0, last[:-1] + 1]] = -1
        waiting, queue = {}, []

        def note(at):
            """File the pairs that start at these places under their ranks."""
            at = at[nxt[at] >= 0] if len(at) else at
            if not len(at) or not len(keys):
                return
            key = sym[at] << 32 | sym[nxt[at]]
            slot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[slot] == key
            at, found = at[hit], ranks[slot[hit]]
            by = np.argsort(found, kind="stable")
            at, found = at[by], found[by]
            cut = np.flatnonzero(np.r_[True, found[1:] != found[:-1]]) if len(found) else []
            for a, b in zip(cut, np.r_[cut[1:], len(found)] if len(found) else []):
                rank = int(found[a])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(queue, rank)
                waiting[rank].append(at[a:b])

        note(np.arange(n))
        while queue:
            rank = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(rank)))
            l, r = int(left[rank]), int(right[rank])
            at = at[(sym[at] == l) & (nxt[at] >= 0)]
            at = at[sym[nxt[at]] == r]
            if l == r and len(at):  # overlapping pairs: every other one of a run, from the left
                start = np.r_[True, nxt[at[:-1]] != at[1:]]
                place = np.arange(len(at))
                at = at[(place - place[start][np.cumsum(start) - 1]) % 2 == 0]
            gone = nxt[at]
            sym[at], sym[gone] = new[rank], -1
            after = nxt[gone]
            nxt[at] = after
            prv[after[after >= 0]] = at[after >= 0]
            before = prv[at]
            note(np.unique(np.r_[at, before[before >= 0]]))
        live = sym >= 0
        counts = np.concatenate([[0], np.cumsum(live)])[np.r_[0, ends].astype(np.int64)]
        return pa.ListArray.from_arrays(pa.array(counts.astype(np.int32)), pa.array(sym[live].astype(np.int32)))

    def sliced(texts):
        """About a million bytes at a time (a longer text alone), each passed
        on before the next, so no ids of a whole batch are held."""
        start, held = 0, 0
        for i, t in enumerate(texts):
            size = len(t.as_buffer()) if t.is_valid else 0
            if i > start and held + size > (1 << 20):
                yield run(texts.slice(start, i - start))
                start, held = i, 0
            held += size
        yield run(texts.slice(start))

    return sliced


def _shared_merges(merges: list[Merge]):
    import numpy as np
    ordered = sorted(merges, key=lambda m: m.rank)
    columns = [np.array([getattr(m, f) for m in ordered], np.int64) for f in ("left", "right", "new_id")]
    return SparkSession.getActiveSession().sparkContext.broadcast(tuple(columns))


def bpe_encode(text: Column, merges: list[Merge], specials: dict[str, int] | None = None) -> Column:
    """Text to token ids (``array<int>``). Merges apply in rank order, each to
    all its pairs from left to right; a merge's parts must come before it, as
    in any trained table. Special strings become their ids first, the first
    listed first, and no merge touches them. A missing text is empty."""
    run = _encode_kernel(_shared_merges(merges), [(s.encode(), tid) for s, tid in (specials or {}).items()])

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield from run(texts)

    return F.arrow_udf(encode, returnType="array<int>")(text)


def bpe_decode(ids: Column, merges: list[Merge], specials: dict[str, int] | None = None) -> Column:
    """Token ids to text; invalid UTF-8 becomes U+FFFD, never an error. An
    unknown id is U+FFFD too; missing ids are an empty text."""
    pieces = vocab_bytes(merges) | {tid: s.encode() for s, tid in (specials or {}).items()}
    shared = SparkSession.getActiveSession().sparkContext.broadcast(pieces)

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        table = shared.value
        known = np.array(sorted(table), np.int64)
        parts = [table[i] for i in known.tolist()] + ["\ufffd".encode()]
        sizes = np.array([len(p) for p in parts], np.int64)
        places = np.cumsum(sizes) - sizes
        pool = np.frombuffer(b"".join(parts), np.uint8)
        for lists in batches:
            # About a million ids at a time (a longer row alone).
            until = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < len(lists):
                before = int(until[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(until, before + (1 << 20), side="right")))
                flat = lists.slice(start, end - start).flatten()
                ids = pc.fill_null(flat, -1).to_numpy(zero_copy_only=False).astype(np.int64)
                slot = np.minimum(np.searchsorted(known, ids), len(known) - 1)
                slot[known[slot] != ids] = len(known)
                size = sizes[slot]
                stop = np.cumsum(size)
                raw = pool[np.repeat(places[slot] - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)].tobytes()
                cuts = np.r_[0, stop][np.r_[before, until[start:end]] - before].tolist()
                yield pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:])], pa.string())
                start = end

    return F.arrow_udf(decode, returnType="string")(ids)


def _pair_count_kernel():
    """The per-batch pair counter. A closure (not a module-level function) so
    executors unpickle it by value without importing this package."""
    lo, hi = SURROGATE_LO, SURROGATE_HI
    dense, most_held = DENSE_PAIRS, HELD_PAIRS
    names = ["left_id", "right_id", "n", "doc_id", "chunk_pos", "pos"]

    def run(batches):
        """Adjacent pairs of every symbol string, summed by pair: weighted
        count and the first occurrence ``(doc_id, position)``, for about a
        million symbols at a time; the sums of one task are added up as they
        come. The shuffle carries these sums only."""
        import numpy as np
        import pyarrow as pa

        def parts(batch):
            start, held = 0, 0
            for i, t in enumerate(batch.column("sym")):
                size = len(t.as_buffer())
                if i > start and held + size > (1 << 21):
                    yield batch.slice(start, i - start)
                    start, held = i, 0
                held += size
            yield batch.slice(start)

        def counted(batch):
            """The sums of one slice, each pair once."""
            # Rows in the order of their ids, so that the first place of a
            # pair in this order is its first occurrence.
            order = pc.sort_indices(batch, sort_keys=[("doc_id", "ascending"), ("chunk_pos", "ascending")], null_placement="at_start")
            batch = batch.take(order)
            text = batch.column("sym").to_pylist()
            lens = np.fromiter(map(len, text), np.int64, len(text))
            ids = np.frombuffer("".join(text).encode("utf-32-le"), np.uint32).astype(np.int64)
            if len(ids) < 2:
                return None
            most = int(ids.max())
            if most >= hi:
                ids = np.where(ids >= hi, ids - (hi - lo), ids)
                most = int(ids.max())
            ends = np.cumsum(lens)
            across = ends[:-1] - 1
            across = across[(across >= 0) & (across < len(ids) - 1)]
            wide = most + 1
            key = ids[:-1] * wide + ids[1:]
            weights = batch.column("weight").to_numpy(zero_copy_only=False)
            if wide * wide <= dense:  # few symbols: a table of all pairs, no sort
                key[across] = wide * wide
                if (weights == 1).all():
                    n = np.bincount(key, minlength=wide * wide + 1)
                else:
                    n = np.zeros(wide * wide + 1, np.int64)
                    np.add.at(n, key, np.repeat(weights, lens)[:-1])
                first = np.zeros(wide * wide + 1, np.int64)
                first[key[::-1]] = np.arange(len(key) - 1, -1, -1)  # the last assignment holds: the first place
                n[-1] = 0
                pair = np.flatnonzero(n)
                n, first = n[pair], first[pair]
            else:
                at = np.delete(np.arange(len(key)), across)
                by = np.argsort(key[at], kind="stable")
                at = at[by]
                seg = np.flatnonzero(np.r_[True, key[at[1:]] != key[at[:-1]]]) if len(at) else at
                n = np.add.reduceat(np.repeat(weights, lens)[at], seg) if len(at) else at
                first = at[seg]
                pair = key[first]
            if not len(pair):
                return None
            row = np.searchsorted(ends, first, side="right")
            rows = pa.array(row)
            return pa.RecordBatch.from_arrays([
                pa.array((pair // wide).astype(np.int32)), pa.array((pair % wide).astype(np.int32)),
                pa.array(n.astype(np.int64)), batch.column("doc_id").take(rows),
                batch.column("chunk_pos").take(rows), pa.array(first - (ends - lens)[row])], names)

        def summed(held):
            """Sums of several slices as one."""
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = ["left_id", "right_id", "doc_id", "chunk_pos", "pos"]
            whole = whole.take(pc.sort_indices(whole, sort_keys=[(k, "ascending") for k in keys], null_placement="at_start"))
            left, right, n = (whole.column(c).to_numpy() for c in ("left_id", "right_id", "n"))
            seg = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
            whole = whole.take(pa.array(seg)).set_column(2, "n", pa.array(np.add.reduceat(n, seg)))
            return whole.combine_chunks().to_batches()[0]

        held, size, limit = [], 0, most_held
        for batch in (p for b in batches if b.num_rows for p in parts(b)):
            got = counted(batch)
            if got is None:
                continue
            held.append(got)
            size += got.num_rows
            if size > limit:
                held = [summed(held)]
                size = held[0].num_rows
                if 2 * size > limit:  # hardly any pair occurs again
                    yield held.pop()
                    size = 0
        if held:
            yield summed(held)
    return run


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Adjacent pair counts (overlapping occurrences counted, pairs never cross
    rows) over ``doc_id, chunk_pos, weight, sym``: ``left_id, right_id, n`` and
    ``first``, the first occurrence ``(doc_id, chunk_pos, pos)``. Ids may be of
    any type that has an order."""
    schema = T.StructType([
        T.StructField("left_id", T.IntegerType()), T.StructField("right_id", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("doc_id", chunks.schema["doc_id"].dataType), T.StructField("chunk_pos", T.LongType()), T.StructField("pos", T.LongType())])
    partial = chunks.select("doc_id", F.col("chunk_pos").cast("long").alias("chunk_pos"), F.col("weight").cast("long").alias("weight"), "sym").mapInArrow(_pair_count_kernel(), schema)
    return partial.groupBy("left_id", "right_id").agg(F.sum("n").alias("n"), F.min(F.struct("doc_id", "chunk_pos", "pos")).alias("first"))


def byte_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One chunk per document: ``doc_id, chunk_pos, weight, sym``."""
    return docs.select(F.col(id_col).alias("doc_id"), F.lit(0).cast("long").alias("chunk_pos"), F.lit(1).cast("long").alias("weight"), byte_symbols(F.col(text_col)).alias("sym"))


def _word_count_kernel():
    """The per-task word counter. A closure, as the pair counter is."""
    most_bytes, most_held = 1 << 23, HELD_PAIRS

    def run(batches):
        """Words (texts cut before each space) summed by word: count and first
        occurrence ``(id, place)``, for some millions of bytes at a time; the
        sums of one task are added up as they come."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def parts(batch):
            sizes = np.cumsum(pc.binary_length(batch.column("_t")).to_numpy(zero_copy_only=False).astype(np.int64))
            start = 0
            while start < batch.num_rows:
                before = int(sizes[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(sizes, before + most_bytes, side="right")))
                yield batch.slice(start, end - start)
                start = end

        def counted(batch):
            # Rows in the order of their ids: a word's first place is its first occurrence.
            batch = batch.take(pc.sort_indices(batch, sort_keys=[("_id", "ascending")], null_placement="at_start"))
            texts = batch.column("_t")
            cut = pc.split_pattern(texts, " ")
            n_words = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(n_words)), n_words)
            begin = np.cumsum(n_words) - n_words
            place = np.arange(len(row)) - begin[row]
            # A text that starts with a space has no word before it.
            spaced = pc.starts_with(texts, " ").to_numpy(zero_copy_only=False)
            found = pc.dictionary_encode(cut.flatten())
            code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + (place > 0)
            live = (place > 0) | ~spaced[row]
            code, row, place = code[live], row[live], (place - spaced[row])[live]
            ids = batch.column("_id")
            if pc.count_distinct(ids, mode="all").as_py() < len(ids):  # rows of one id: by place, then
                rank = pc.rank(ids, null_placement="at_start", tiebreaker="dense").to_numpy()
                by = np.lexsort((place, rank[row]))
                code, row, place = code[by], row[by], place[by]
            n = np.bincount(code, minlength=2 * len(found.dictionary))
            first = np.zeros(len(n), np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)  # the last assignment holds: the first place
            word = np.flatnonzero(n)
            first = first[word]
            names = found.dictionary.take(pa.array(word // 2))
            names = pc.if_else(pa.array(word % 2 == 1), pc.binary_join_element_wise(pa.scalar(" "), names, ""), names)
            return pa.RecordBatch.from_arrays([names, pa.array(n[word]), ids.take(pa.array(row[first])), pa.array(place[first])], ["_t", "weight", "_id", "_p"])

        def summed(held):
            whole = pa.Table.from_batches(held).combine_chunks()
            whole = whole.take(pc.sort_indices(whole, sort_keys=[("_id", "ascending"), ("_p", "ascending")], null_placement="at_start")).combine_chunks()
            found = pc.dictionary_encode(whole.column("_t").combine_chunks())
            code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            n = np.zeros(len(found.dictionary), np.int64)
            np.add.at(n, code, whole.column("weight").to_numpy())
            first = np.zeros(len(n), np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            return whole.take(pa.array(first)).set_column(1, "weight", pa.array(n)).combine_chunks().to_batches()[0]

        held, size = [], 0
        for batch in (p for b in batches if b.num_rows for p in parts(b)):
            held.append(counted(batch))
            size += held[-1].num_rows
            if size > most_held:
                held = [summed(held)]
                size = held[0].num_rows
                if 2 * size > most_held:  # hardly any word occurs again
                    yield held.pop()
                    size = 0
        if held:
            yield summed(held)

    return run


def training_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    chunking: str = "document") -> DataFrame:
    """Distinct chunks with weights: ``doc_id`` (first occurrence), ``weight``,
    ``sym``. ``document``: a chunk is a whole text, pairs may cross spaces.
    ``word``: texts are split before each space (pre-tokenised training,
    pairs stay inside a word and its leading space). Duplicates collapse within
    each task first (words by dictionary, texts by hash), so the shuffle and
    its sort carry distinct chunks only."""
    t = text_or_empty(F.col(text_col))
    if chunking == "word":
        schema = T.StructType([T.StructField("_t", T.StringType()), T.StructField("weight", T.LongType()),
                               T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_p", T.LongType())])
        rows = docs.select(F.col(id_col).alias("_id"), t.alias("_t")).mapInArrow(_word_count_kernel(), schema)
        rows = rows.select(F.struct("_id", F.col("_p").cast("int").alias("_p")).alias("_first"), "_t", "weight")
    elif chunking == "document":
        rows = docs.select(F.struct(F.col(id_col).alias("_id"), F.lit(0).alias("_p"))
                           .alias("_first"), t.alias("_t"), F.lit(1).cast("long").alias("weight"))
    else:
        raise ValueError(chunking)
    agg = rows.groupBy(F.sha2("_t", 256).alias("_h")).agg(
        F.min("_first").alias("_first"), F.sum("weight").alias("weight"),
        F.min_by("_t", "_first").alias("_t"))
    return agg.select(F.col("_first._id").alias("doc_id"), F.col("_first._p").alias("chunk_pos"),
                      "weight", byte_symbols(F.col("_t")).alias("sym"))


def bpe_train(docs: DataFrame, n_merges: int, first_id: int = 256,
              id_col: str = "doc_id", text_col: str = "text",
              chunking: str = "document", checkpoint_every: int = 4) -> list[Merge]:
    """Learn ``n_merges`` merges: each round takes the most frequent adjacent
    pair (ties: earliest first occurrence by ``(doc_id, position)``), gives it
    id ``first_id + round`` and applies it. Stops early when no pair is left.

    One aggregation job per round over the chunk table, which is written to
    the shared checkpoint folder every few rounds so lineage stays short.
    ``word`` chunks collapse to distinct words and are the mode for large
    corpora; ``document`` counts pairs across spaces, over all texts.
    """
    if chunking == "document":
        chunks = byte_chunks(docs, id_col, text_col)
    else:
        chunks = training_chunks(docs, id_col, text_col, chunking)
    # Each round is CPU-bound on the chunk table: keep it spread over all
    # cores (AQE would coalesce a small table into one task).
    spread_to = 2 * docs.sparkSession.sparkContext.defaultParallelism
    chunks = checkpointed(spread(checkpointed(chunks.select("doc_id", "chunk_pos", "weight", "sym")), spread_to)
                          if chunking == "word" else spread(chunks, spread_to))
    merges: list[Merge] = []
    for r in range(n_merges):
        top = pair_counts(chunks).orderBy(F.desc("n"), F.asc("first")).limit(1).collect()
        if not top:
            break
        m = Merge(r, int(top[0]["left_id"]), int(top[0]["right_id"]), first_id + r)
        merges.append(m)
        chunks = chunks.withColumn("sym", apply_merges(F.col("sym"), [m]))
        if (r + 1) % checkpoint_every == 0:
            chunks = checkpointed(chunks)
    return merges


def merges_frame(spark, merges: list[Merge]) -> DataFrame:
    return spark.createDataFrame([(m.rank, m.left, m.right, m.new_id) for m in merges],
                                 "rank int, left_id int, right_id int, new_id int")


def vocab_bytes(merges: list[Merge]) -> dict[int, bytes]:
    v = {i: bytes([i]) for i in range(256)}
    for m in sorted(merges, key=lambda m: m.rank):
        v[m.new_id] = v[m.left] + v[m.right]
    return v


def vocabulary(spark, merges: list[Merge], specials: dict[str, int] | None = None) -> DataFrame:
    """``token_id, piece_hex, piece`` for bytes, merges and special tokens
    (at most 256 + merges + specials rows)."""
    rows = [(i, b.hex().upper(), b.decode("utf-8", errors="replace"))
            for i, b in vocab_bytes(merges).items()]
    rows += [(tid, s.encode().hex().upper(), s) for s, tid in (specials or {}).items()]
    return spark.createDataFrame(rows, "token_id int, piece_hex string, piece string")


# --- lengths, truncation, labels --------------------------------------------

def append_eos(ids: Column, eos_id: int) -> Column:
    return F.concat(ids, F.array(F.lit(eos_id)))


def truncate(ids: Column, max_length: int) -> Column:
    """The first ``max_length`` ids, without padding."""
    return F.slice(ids, 1, max_length)


def first_byte_tokens(text: Column, max_length: int) -> Column:
    """``byte_tokens`` of the first ``max_length`` bytes: the bytes are cut, so
    no ids are built that truncation drops."""
    cut = F.substring(F.encode(text_or_empty(text), "UTF-8"), 1, max_length)
    return symbol_ids(F.decode(cut, "ISO-8859-1"))


def truncate_pad(ids: Column, max_length: int, pad_id: int) -> tuple[Column, Column]:
    """(input_ids, attention_mask): cut to ``max_length``, right-pad with
    ``pad_id``; mask 1 for real tokens, 0 for padding."""
    cut = F.slice(ids, 1, max_length)
    n_pad = F.lit(max_length) - F.size(cut)
    padded = F.concat(cut, F.array_repeat(F.lit(pad_id), n_pad))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(cut)), F.array_repeat(F.lit(0), n_pad))
    return padded, mask


def lm_labels(input_ids: Column, pad_id: int) -> Column:
    """Causal-LM labels: the ids, with every pad id set to -100 (so an EOS
    equal to the pad id is ignored too)."""
    return F.transform(input_ids, lambda x: F.when(x == pad_id, F.lit(-100)).otherwise(x))


def token_stats(df: DataFrame, n_tokens: str = "n_tokens", by: list[str] | None = None) -> DataFrame:
    """Average (2 decimals), max and min token count, optionally grouped."""
    aggs = [F.round(F.avg(n_tokens), 2).alias("avg_tokens"),
            F.max(n_tokens).alias("max_tokens"), F.min(n_tokens).alias("min_tokens")]
    return df.groupBy(*(by or [])).agg(*aggs)


def token_histogram(df: DataFrame, max_lengths: list[int], n_tokens: str = "n_tokens") -> DataFrame:
    """How many documents fit each context length, and their share: one
    aggregation pass with conditional counts, then unpivot."""
    aggs = [F.count(F.lit(1)).alias("_total")] + [
        F.sum((F.col(n_tokens) <= L).cast("long")).alias(f"_f{i}") for i, L in enumerate(max_lengths)]
    sums = df.agg(*aggs)
    stack = ", ".join(f"{L}, _f{i}" for i, L in enumerate(max_lengths))
    out = sums.selectExpr("_total", f"stack({len(max_lengths)}, {stack}) as (max_len, n_fit)")
    return out.select(F.col("max_len").cast("int").alias("max_len"),
                      F.coalesce("n_fit", F.lit(0)).cast("long").alias("n_fit"),
                      F.round(F.col("n_fit") / F.nullif(F.col("_total"), F.lit(0)), 6).alias("share"))
