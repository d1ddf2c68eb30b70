"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into units that no piece crosses (a run of spaces and what
follows it; line feeds alone), and the distinct units of a slice are merged
together in flat numpy arrays. In each round every unit takes its lowest pair
rank (segmented minimum), merges its leftmost non-overlapping occurrences at
the same time, and the arrays are compacted; units without a pair leave.

Merging all occurrences at once equals the library's queue unless a merge
creates a pair of the same or a lower rank. Which pieces can do that is known
from the vocabulary; for those only the leftmost occurrence merges in a round.

Whatever a worker remembers of units already merged is dropped beyond
``CACHE_UNITS`` units or ``CACHE_BYTES`` bytes; that changes the time only.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import id_text, map_slices

SPACE = "▁"
NO_RANK = np.iinfo(np.int32).max
CACHE_UNITS = 200_000
CACHE_BYTES = 24 << 20
#: A unit longer than this whose next merge has to be taken alone is finished with a queue.
QUEUE_SYMBOLS = 256
#: Columns a call can ask for besides doc_id.
OUTPUTS = {"ids": "array<int>", "decoded": "string", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}


def read_model(path: str) -> dict:
    """The vocabulary of a SentencePiece BPE model as plain lists (a bounded table, sent to the tasks)."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if proto.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
        raise ValueError("a BPE model with byte fallback and without text normalisation is needed")
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    kinds = ["control" if sp.is_control(i) else "unknown" if sp.is_unknown(i) else "byte" if sp.is_byte(i) else "unused" if sp.is_unused(i) else "piece" for i in range(sp.vocab_size())]
    if "unused" in kinds or any(p.type == 4 for p in proto.pieces):
        raise ValueError("unused and user-defined pieces are not supported")
    return {"pieces": [sp.id_to_piece(i) for i in range(sp.vocab_size())], "scores": [sp.get_score(i) for i in range(sp.vocab_size())],
            "kinds": kinds, "bos": sp.bos_id(), "eos": sp.eos_id(), "prefix": norm.add_dummy_prefix}


#: Mark of a unit's key that stands for the unit without a space mark before it.
BARE = SPACE + "\0"


class Known(dict):
    """The place of each unit seen; a unit asked for the first time gets the next place and is noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        place = self[unit] = len(self)
        self.new.append(unit)
        return place


class Codec:
    """Encoder and decoder of one vocabulary; lives in a task."""

    def __init__(self, model: dict):
        pieces, kinds = model["pieces"], model["kinds"]
        self.n, self.bos, self.eos, self.prefix = len(pieces), model["bos"], model["eos"], model["prefix"]
        normal = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "piece"}
        self.byte_id = np.zeros(256, np.int32)
        for i, (p, k) in enumerate(zip(pieces, kinds)):
            if k == "byte":
                self.byte_id[int(p[3:5], 16)] = i
        # Characters that only occur inside pieces still are symbols that merge; they have ids beyond the vocabulary.
        self.extra = sorted({c for p in normal for c in p} - set(normal))
        symbol = normal | {c: self.n + i for i, c in enumerate(self.extra)}
        self.known = self.n + len(self.extra)
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in symbol.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        order = {s: r for r, s in enumerate(sorted({model["scores"][i] for i in normal.values()}, reverse=True))}
        self.rank = np.full(self.n + 1, NO_RANK, np.int32)  # the last entry: no piece
        for i in normal.values():
            self.rank[i] = order[model["scores"][i]]
        self.alone = np.zeros(self.n + 1, bool)
        pairs = {}
        for p, i in normal.items():
            for k in range(1, len(p)):
                left, right = symbol.get(p[:k]), symbol.get(p[k:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = i
                for part in (left, right):
                    if part is not None and part < self.n and self.rank[part] >= self.rank[i]:
                        self.alone[part] = True
        self.bits = max(16, (len(pairs) * 16).bit_length())
        self.keys, self.vals = np.full((1 << self.bits) + 64, -1, np.int64), np.full((1 << self.bits) + 64, self.n, np.int32)
        self.probes = 1
        for key, slot in zip(pairs, self._slot(np.fromiter(pairs, np.int64, len(pairs))).tolist()):
            start = slot
            while self.keys[slot] >= 0:
                slot += 1
            self.keys[slot], self.vals[slot] = key, pairs[key]
            self.probes = max(self.probes, slot - start + 1)
        crossing = any(SPACE in p.lstrip(SPACE) for p in normal)
        feeds = any("\n" in p for p in normal)
        self.unit = None if crossing else re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if feeds else f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        self.surface = [b"" if k == "control" else b" \xe2\x81\x87 " if k == "unknown" else bytes([int(p[3:5], 16)]) if k == "byte" else p.replace(SPACE, " ").encode() for p, k in zip(pieces, kinds)]
        self.kinds = kinds
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.cache = Known()
        self.store, self.starts, self.lens = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.used = self.held = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes; ``self.n`` where there is none."""
        keys = left.astype(np.int64) << 20 | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.vals[slot], self.n)
        open_ = np.flatnonzero((self.keys[slot] >= 0) & (out == self.n))
        for _ in range(1, self.probes):
            slot[open_] += 1
            found = self.keys[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.vals[slot[open_[hit]]]
            open_ = open_[(found >= 0) & ~hit]
        out[(left >= self.known) | (right >= self.known)] = self.n
        return out

    def _queue(self, symbols: list[int]) -> list[int]:
        """One unit merged pair by pair: lowest rank first, leftmost among equals."""
        nxt, prv = list(range(1, len(symbols))) + [-1], list(range(-1, len(symbols) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def push(places: list[int]) -> None:
            at = [i for i in places if i >= 0 and nxt[i] >= 0]
            if at:
                left, right = np.array([symbols[i] for i in at]), np.array([symbols[nxt[i]] for i in at])
                for i, piece in zip(at, self._merged(left, right).tolist()):
                    if piece < self.n:
                        heapq.heappush(heap, (int(self.rank[piece]), i, symbols[i], symbols[nxt[i]], piece))

        push(list(range(len(symbols))))
        while heap:
            _, i, left, right, piece = heapq.heappop(heap)
            j = nxt[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue
            symbols[i], symbols[j], nxt[i] = piece, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
            push([prv[i], i])
        return [s for s in symbols if s >= 0]

    def merge_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units in order, and how many each unit has."""
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.char[points]
        odd = np.flatnonzero(sym < 0)
        strange, which = np.unique(points[odd], return_inverse=True)
        sym[odd] = self.known + which
        word = np.repeat(np.arange(len(units), dtype=np.int32), np.fromiter(map(len, units), np.int64, len(units)))
        done_sym, done_word = [], []
        pair = np.full(len(sym), self.n, np.int32)
        if len(sym) > 1:
            pair[:-1] = np.where(word[:-1] == word[1:], self._merged(sym[:-1], sym[1:]), self.n)
        while len(sym):
            rank = self.rank[pair]
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[first, len(word)])
            least = np.minimum.reduceat(rank, first)
            over = np.repeat(least == NO_RANK, size)
            if over.any():
                done_sym.append(sym[over])
                done_word.append(word[over])
                go = ~over
                sym, word, pair, rank = sym[go], word[go], pair[go], rank[go]
                going = least != NO_RANK
                least, size = least[going], size[going]
                if not len(sym):
                    break
                first = np.r_[0, np.cumsum(size)[:-1]]
            hit = rank == np.repeat(least, size)
            at = np.flatnonzero(hit)
            alone = np.zeros(len(size), bool)  # units that take their leftmost pair only
            of = np.repeat(np.arange(len(size)), size)[at]
            alone[of[self.alone[pair[at]]]] = True
            long = alone & (size > QUEUE_SYMBOLS)
            if long.any():
                for k in np.flatnonzero(long).tolist():
                    final = self._queue(sym[first[k]:first[k] + size[k]].tolist())
                    done_sym.append(np.array(final, np.int32))
                    done_word.append(np.full(len(final), word[first[k]], np.int32))
                go = ~np.repeat(long, size)
                sym, word, pair = sym[go], word[go], pair[go]
                continue
            run = np.r_[True, (np.diff(at) != 1) | (np.diff(of) != 0)]  # overlapping pairs: every other one, from the left
            place = np.arange(len(at))
            take = (place - place[run][np.cumsum(run) - 1]) % 2 == 0
            lead = np.r_[True, np.diff(of) != 0]
            take &= lead | ~alone[of]
            at = at[take]
            sym[at] = pair[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            sym, word, pair = sym[keep], word[keep], pair[keep]
            touched = np.zeros(len(sym) + 1, bool)  # the last entry takes what would be before the first symbol
            touched[at] = touched[at - 1] = True
            near = np.flatnonzero(touched[:-1])
            inner = near[near < len(sym) - 1]
            pair[near] = self.n
            inner = inner[word[inner] == word[inner + 1]]
            pair[inner] = self._merged(sym[inner], sym[inner + 1])
        sym, word = (np.concatenate(done_sym), np.concatenate(done_word)) if done_sym else (sym, word)
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        # Symbols that are no piece become their bytes.
        count, odd = np.ones(len(sym), np.int64), np.flatnonzero(sym >= self.n)
        chars = self.extra + [chr(c) for c in strange.tolist()]
        spelt = {s: self.byte_id[np.frombuffer(chars[s - self.n].encode("utf-8", "replace"), np.uint8)] for s in np.unique(sym[odd]).tolist()}
        count[odd] = [len(spelt[s]) for s in sym[odd].tolist()]
        ids = np.repeat(sym, count)
        if len(odd):
            where = (np.cumsum(count) - count)[odd]
            for s, p in zip(sym[odd].tolist(), where.tolist()):
                ids[p:p + len(spelt[s])] = spelt[s]
        return ids, np.bincount(word, weights=count, minlength=len(units)).astype(np.int64)

    def _learn(self, keys: list[str]) -> None:
        ids, lens = self.merge_units([k[2:] if k.startswith(BARE) else k if k.startswith(SPACE) else SPACE + k for k in keys])
        n = len(self.cache)
        m = n - len(keys)
        while self.used + len(ids) > len(self.store):
            self.store = np.resize(self.store, 2 * len(self.store))
        while n > len(self.starts):
            self.starts, self.lens = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lens, 2 * len(self.lens))
        self.store[self.used:self.used + len(ids)] = ids
        self.starts[m:n], self.lens[m:n] = self.used + np.cumsum(lens) - lens, lens
        self.used += len(ids)
        self.held += sum(map(len, keys))  # characters: of one to four bytes in memory

    def _units(self, text: str) -> list[str]:
        """Keys of the units of a text. A unit that is one space mark and a word goes by the word; others begin with a space mark."""
        if self.unit and self.prefix and SPACE not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        text = (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        found = self.unit.findall(text) if self.unit else [text]
        return [BARE + u if u[0] != SPACE else u if SPACE in u[1:] or len(u) == 1 else u[1:] for u in found]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, with begin and end ids, and the offsets of the texts."""
        if len(self.cache) > CACHE_UNITS or 2 * self.held + 4 * self.used > CACHE_BYTES:
            self._forget()
        units: list[str] = []
        ends = [0]
        for t in texts:
            if t:
                units += self._units(t)
            ends.append(len(units))
        index = np.fromiter(map(self.cache.__getitem__, units), np.int64, len(units))
        new, self.cache.new = self.cache.new, []
        if new:
            self._learn(new)
        lens = self.lens[index]
        until = np.cumsum(lens)
        total = int(until[-1]) if len(until) else 0
        flat = self.store[np.repeat(self.starts[index] - (until - lens), lens) + np.arange(total)]
        bounds = np.r_[0, until][np.array(ends)]
        offsets = bounds + 2 * np.arange(len(texts) + 1)
        out = np.empty(total + 2 * len(texts), np.int32)
        inside = np.ones(len(out), bool)
        out[offsets[:-1]], out[offsets[1:] - 1] = self.bos, self.eos
        inside[offsets[:-1]] = inside[offsets[1:] - 1] = False
        out[inside] = flat
        return out, offsets

    def decode(self, ids: list[int]) -> str:
        """The text of the ids, as the library gives it: control ids vanish, a leading space mark goes, bytes join to characters."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        first = next((i for i in ids if self.kinds[i] != "control"), None)
        strip = first is not None and self.prefix and self.kinds[first] == "piece" and self.pieces[first].startswith(SPACE)
        try:
            return raw.decode()[1 if strip else 0:]
        except UnicodeDecodeError:
            parts, run = [], b""
            for i in [*ids, -1]:
                if i >= 0 and self.kinds[i] == "byte":
                    run += self.surface[i]
                    continue
                while run:
                    for k in range(1, 5):
                        try:
                            parts.append(run[:k].decode())
                            run = run[k:]
                            break
                        except UnicodeDecodeError:
                            continue
                    else:
                        parts.append("�")
                        run = run[1:]
                if i >= 0:
                    parts.append(self.surface[i].decode())
            return "".join(parts)[1 if strip else 0:]


def encode_decode(docs: DataFrame, model_path: str, outputs: tuple[str, ...] = ("ids", "decoded"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and the ``outputs`` asked for (see ``OUTPUTS``).

    The whole text is encoded with begin and end ids, then the ids are decoded.
    Null and empty texts give the begin and end ids alone and an empty text;
    repeated rows stay repeated; an empty table gives an empty result; a null
    id stays null. Row-local: no shuffle, memory bounded by a slice of about
    2 MB of text (or one document) and the unit cache.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))  # vocabulary: bounded
    wanted = list(outputs)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            ids, offsets = codec.encode([t or "" for t in batch.column("text").to_pylist()])
            rows = [ids[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            made: dict = {}
            if "ids" in wanted:
                made["ids"] = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
            if "n_tokens" in wanted:
                made["n_tokens"] = pa.array(np.diff(offsets))
            if "ids_sha256" in wanted:
                made["ids_sha256"] = pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows])
            if "decoded" in wanted or "decoded_sha256" in wanted:
                texts = [codec.decode(r.tolist()) for r in rows]
                if "decoded" in wanted:
                    made["decoded"] = pa.array(texts, pa.string())
                if "decoded_sha256" in wanted:
                    made["decoded_sha256"] = pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(made[w] for w in wanted)], names=["doc_id", *wanted])

    schema = ", ".join(["doc_id bigint", *(f"{w} {OUTPUTS[w]}" for w in wanted)])
    return map_slices(id_text(docs, id_col, text_col), kernel, schema)
