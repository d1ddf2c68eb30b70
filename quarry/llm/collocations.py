"""Phrase collocations from sorted count streams merged in lockstep.

Counts of all frequent phrases of one to five words are kept as one stream,
sorted first by their words from the left (prefix order), then by their words
from the right (suffix order). In prefix order a phrase stands right behind
the phrases it begins with and right before those that extend it, so one pass
over the sorted stream, with a stack of at most six counts, gives every phrase the
counts of its first parts and the highest count of an extension to the right.
Suffix order gives the last parts and extensions to the left. There is no
join: rows carry their counts from one order to the other, and the empty
phrase, whose count is that of all words, stands at the head of each language.

Streams are range-partitioned, so a first word that begins a third of all
phrases is spread like any other range. A phrase and its extensions may then
lie in different partitions: a first pass finds each partition's last open phrases and the
extensions whose phrase lies before it (at most a dozen rows for a partition), which the second starts from.

A phrase is no more frequent than its parts, so three passes over the texts count words, then the hashes of pairs of
frequent words, then the pairs and longer phrases all of whose pairs have frequent hashes. Bitmaps sized by
the number of frequent entries tell which may be; the counts themselves are exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from quarry.llm.bitmaps import bitmap, inside
from quarry.llm.common import checkpointed, slices, written

LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"
#: Every word of a key ends with this, which no word holds: byte order is then word order, and what a key extends begins with its bytes.
END = "\t"
#: The bitmaps have so many bits for each frequent word and pair, up to two to this power.
WORD_BITS, PAIR_BITS = 16, 64
MOST_BITS = 28
#: Parts in which a language's phrases are ranked before the best of all parts are.
RANK_PARTS = 32
#: Rows of one sorted partition, about.
STREAM_ROWS = 500_000
#: Text of one slice, and words that a task remembers between slices.
SLICE = 8 << 20
KNOWN_WORDS, KNOWN_BYTES = 300_000, 16 << 20

_TOKEN = re.compile(rb"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+")
_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_BREAKS = frozenset(bytes([c]) for c in b".,;:!?\n\x0b\x0c\r")
_COUNTS = "lang string, phrase string, n bigint"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes) -> list[bytes]:
    """Words, A-Z in lower case, and the single characters that split pieces."""
    return _TOKEN.findall(text.lower())


def _hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word)


def _pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first * _MIX) ^ (second + (first >> np.uint64(29)))
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
    return mixed ^ (mixed >> np.uint64(30))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).cast("string").alias("text"))


def _rows(langs, phrases, counts) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64())], names=["lang", "phrase", "n"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str, bytes]]]:
    """``(lang, text)`` by about ``SLICE`` bytes; a longer text is cut behind a character that splits pieces."""
    for batch in slices(batches, "text", SLICE):
        group, held = [], 0
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            at = 0
            while text and at < len(text):
                end = _BREAK.search(text, at + SLICE) if len(text) - at > SLICE else None
                upto = end.end() if end else len(text)
                group.append((lang, text[at:upto] if end or at else text))
                held += upto - at
                at = upto
                if held >= SLICE:
                    yield group
                    group, held = [], 0
        if group:
            yield group


def _frequent(partial: DataFrame, least: int, name: str) -> DataFrame:
    """Summed counts of ``least`` or more, and those of the empty phrase; written, as the next pass reads them too."""
    return written(partial.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter((F.col("n") >= least) | (F.col("phrase") == "")), name)


def _word_counts(texts: DataFrame) -> DataFrame:
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            counts: dict[str, Counter] = {}
            for lang, text in group:
                counts.setdefault(lang, Counter()).update(tokens(text))
            for lang, own in counts.items():
                for c in _BREAKS:
                    own.pop(c, None)
                words = pc.binary_join_element_wise(pa.array(own.keys(), pa.binary()).cast(pa.string()), "", END)
                n = sum(own.values())
                yield _rows([lang] * (len(own) + 1), [*words.to_pylist(), ""], [*own.values(), n])

    return texts.mapInArrow(kernel, _COUNTS)


class _Words(dict):
    """Numbers of the frequent words of one language; 0 for all else and for what splits pieces."""

    def __init__(self, lang: str, known: _Known):
        self.lang, self.known = lang, known
        self.update(dict.fromkeys(_BREAKS, 0))

    def __missing__(self, word: bytes) -> int:
        self[word] = number = self.known.add(self.lang, word)
        return number


class _Known:
    """The words a task has met, their numbers and hashes."""

    def __init__(self, table: np.ndarray, bits: int):
        self.table, self.bits = table, bits
        self.clear()

    def clear(self) -> None:
        self.of: dict[str, _Words] = {}
        self.words, self.langs, self.hashes, self.seen, self.held = [b""], [""], [0], 0, 0

    def add(self, lang: str, word: bytes) -> int:
        self.seen, self.held = self.seen + 1, self.held + len(word)
        h = _hash(lang, word)
        slot = h >> (64 - self.bits)
        if not int(self.table[slot >> 6]) >> (slot & 63) & 1:
            return 0
        self.words.append(word)
        self.langs.append(lang)
        self.hashes.append(h)
        return len(self.words) - 1

    def numbers(self, group: list[tuple[str, bytes]]) -> np.ndarray:
        """Of all tokens of a group, a zero behind each text."""
        if self.seen > KNOWN_WORDS or self.held > KNOWN_BYTES:
            self.clear()
        parts = []
        for lang, text in group:
            if lang not in self.of:
                self.of[lang] = _Words(lang, self)
            own = self.of[lang]
            found = tokens(text)
            found.append(b"\n")
            parts.append(np.fromiter(map(own.__getitem__, found), np.int64, len(found)))
        return np.concatenate(parts)


def _pair_counts(texts: DataFrame, words: np.ndarray) -> DataFrame:
    """``hash, n`` of the pairs of words in the bitmap: narrow rows, as most pairs are rare."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(shared.value, _bits(shared.value))
        for group in _groups(batches):
            own = known.numbers(group)
            hashes = np.array(known.hashes, np.uint64)
            at = np.flatnonzero((own[:-1] > 0) & (own[1:] > 0))
            found, n = np.unique(_pair_hashes(hashes[own[at]], hashes[own[at + 1]]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

    return texts.mapInArrow(kernel, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n"))


def _phrases(texts: DataFrame, words: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """Counts of the phrases of two words or more, all in the bitmap ``words``, all of whose pairs are in the bitmap ``pairs``."""
    context = texts.sparkSession.sparkContext
    words_shared, pairs_shared = context.broadcast(words), context.broadcast(pairs)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_words, of_pairs = words_shared.value, pairs_shared.value
        known = _Known(of_words, _bits(of_words))

        def counted(own: np.ndarray, m: int, starts: np.ndarray, keys: np.ndarray) -> tuple[pa.RecordBatch, np.ndarray]:
            _, first, place, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            at = starts[first]
            named = pa.array(known.words, pa.binary()).cast(pa.string())
            joined = pc.binary_join_element_wise(*(named.take(pa.array(own[at + j])) for j in range(m)), "", END)
            return _rows(pa.array(known.langs).take(pa.array(own[at])), joined, n), place

        for group in _groups(batches):
            own = known.numbers(group)
            fit = (own[:-1] > 0) & (own[1:] > 0)
            hashes = np.array(known.hashes, np.uint64)
            at = np.flatnonzero(fit)
            if len(at):
                fit[at] = inside(of_pairs, _slots(_pair_hashes(hashes[own[at]], hashes[own[at + 1]]), _bits(of_pairs)))
            starts = np.flatnonzero(fit)
            rank = np.zeros(len(fit) + 1, np.int64)  # of the phrase of m words at each place
            rank[starts] = own[starts]
            for m in range(2, LONGEST + 1):
                starts = starts[starts + m - 2 < len(fit)]
                starts = starts[fit[starts + m - 2]]
                if not len(starts):
                    break
                rows, place = counted(own, m, starts, rank[starts] * len(known.words) + own[starts + m - 1])
                yield rows
                rank[starts] = place

    return texts.mapInArrow(kernel, _COUNTS)


def _bits(table: np.ndarray) -> int:
    return len(table).bit_length() + 5


def _sized(entries: int, each: int, most_bits: int) -> int:
    return max(6, min(most_bits, max(16, (each * entries).bit_length())))


def _marked_words(frequent: DataFrame, most_bits: int) -> np.ndarray:
    """Bitmap of the frequent words, sized by their number."""
    bits = _sized(frequent.count(), WORD_BITS, most_bits)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashed = np.array([_hash(lang, key[:-len(END)].encode()) for lang, key in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")))], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(_slots(hashed, bits), pa.int64())], names=["slot"])

    return bitmap(frequent.filter("phrase != ''").select("lang", "phrase").mapInArrow(kernel, "slot bigint"), bits)


def count_streams(docs: DataFrame, least: int = LEAST, lang_col: str = "lang", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """``lang, phrase, n`` of every phrase of one to five words that occurs ``least`` times or more in a language, each word ended by a tab, and of the empty phrase."""
    texts = _texts(docs, lang_col, text_col)
    words = _frequent(_word_counts(texts), least, "collocation-words")
    of_words = _marked_words(words, most_bits)
    pairs = written(_pair_counts(texts, of_words).filter(F.col("n") >= least).select("hash"), "collocation-pairs")
    bits = _sized(pairs.count(), PAIR_BITS, most_bits)
    of_pairs = bitmap(pairs.select(F.expr(f"shiftrightunsigned(hash, {64 - bits})").alias("slot")), bits)
    return words.unionByName(_frequent(_phrases(texts, of_words, of_pairs), least, "collocation-phrases"))


class _Open:
    """The phrases that the present one begins with, from the empty one on, and the highest count of an extension seen of each."""

    def __init__(self, carried: list[tuple[str, str, int]] = ()):
        self.stack = [[*x, 0, None] for x in carried]

    def push(self, lang: str, key: str, n: int, row) -> list[list]:
        """The phrases that no later row extends."""
        done = []
        while self.stack and not (self.stack[-1][0] == lang and key.startswith(self.stack[-1][1])):
            done.append(self.stack.pop())
        if self.stack:
            self.stack[-1][3] = max(self.stack[-1][3], n)
        self.stack.append([lang, key, n, 0, row])
        return done


def lockstep(stream: DataFrame, key: str, parts: str, extended: str) -> DataFrame:
    """The rows of ``stream`` (``lang``, ``n``, a key column and others) with ``parts``, the counts of the phrases that the key begins with
    (the empty one first), and ``extended``, the highest count of those that begin with the key and have one word more."""
    n_parts = max(int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stream.count() // STREAM_ROWS))
    held = checkpointed(stream.repartitionByRange(n_parts, "lang", key).sortWithinPartitions("lang", key).withColumn("_pid", F.spark_partition_id()))
    names = stream.columns
    columns = ("lang", key, "n")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, missing, pid, last = _Open(), {}, None, None
        for batch in batches:
            for lang, k, n in zip(*(batch.column(c).to_pylist() for c in columns)):
                open_.push(lang, k, n, None)
                if len(open_.stack) == 1 and k:  # the phrase that this one extends stands in an earlier partition
                    parent = (lang, k[:k.rstrip(END).rfind(END) + 1])
                    missing[parent] = max(missing.get(parent, 0), n)
                last = (lang, k)
            pid = batch.column("_pid")[0].as_py() if batch.num_rows else pid
        rows = [(pid, 0, *x[:3]) for x in open_.stack] + [(pid, 1, *k, n) for k, n in missing.items()] + ([(pid, 2, *last, 0)] if last else [])
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64()))], names=["pid", "kind", "lang", "phrase", "n"])

    carried: dict[int, list[tuple[str, str, int]]] = {}
    later: dict[tuple[str, str], int] = {}
    stack: list[tuple[str, str, int]] = []
    edges: dict[int, list[list]] = {}
    for pid, kind, *row in zip(*held.mapInArrow(ends, "pid int, kind int, lang string, phrase string, n bigint").toArrow().to_pydict().values()):
        edges.setdefault(pid, [[], [], []])[kind].append(tuple(row))
    for pid in sorted(edges):
        opened, missing, [(lang, last, _)] = edges[pid]
        carried[pid] = stack
        for of_lang, phrase, n in missing:
            later[of_lang, phrase] = max(later.get((of_lang, phrase), 0), n)
        within = {x[:2] for x in opened}
        stack = [x for x in stack if x[0] == lang and last.startswith(x[1]) and x[:2] not in within] + sorted(opened, key=lambda x: len(x[1].encode()))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None

        def pack(done: list[list], schema: pa.Schema) -> pa.RecordBatch:
            done = [x for x in done if x[4] is not None]  # else carried in from an earlier partition, which returns it
            rows = pa.RecordBatch.from_pylist([x[4][0] for x in done], schema=schema)
            more = pa.array([x[4][1] for x in done], pa.list_(pa.int64())), pa.array([max(x[3], later.get((x[0], x[1]), 0)) for x in done], pa.int64())
            return pa.RecordBatch.from_arrays([*rows.columns, *more], names=[*names, parts, extended])

        schema = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if open_ is None:
                open_, schema = _Open(carried[batch.column("_pid")[0].as_py()]), pa.schema([batch.schema.field(c) for c in names])
            done = []
            for row in batch.select(names).to_pylist():
                done += open_.push(row["lang"], row[key], row["n"], None)
                open_.stack[-1][4] = (row, [x[2] for x in open_.stack[:-1]])
            yield pack(done, schema)
        if open_ is not None:
            yield pack(open_.stack, schema)

    return held.mapInArrow(merged, StructType([*stream.schema.fields, StructField(parts, ArrayType(LongType())), StructField(extended, LongType())]))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, lang_col: str = "lang", text_col: str = "text", most_bits: int = MOST_BITS) -> DataFrame:
    """``lang, rank, phrase, cut, a, l, r, n, score``: the ``top`` collocations of each language.

    A candidate is a phrase of two to five words that occurs ``a`` times, ``least`` or more. Its score is that of its
    weakest cut into a first part of ``cut`` words (count ``l``) and a rest (``r``): floor(1000 * a * n / (l * r)),
    ``n`` being the words of the language. A candidate goes if a longer one
    holds it and occurs as often. Ties of the score: higher ``a``, then the phrase in byte order.

    Null texts count as empty, a null language is ``und``; a language without
    candidates has no row; repeated rows count as often as they stand; an empty table gives an empty result; other columns are not read, so none can clash.
    """
    ahead = written(lockstep(count_streams(docs, least, lang_col, text_col, most_bits), "phrase", "firsts", "right"), "collocation-prefixes")
    words = F.split("phrase", END)
    turned = F.concat(F.reverse(F.slice(words, 1, F.size(words) - 1)), F.array(F.lit("")))
    both = lockstep(ahead.withColumn("turned", F.array_join(turned, END)), "turned", "lasts", "left")
    # A longer phrase is no more frequent than the one with a single word more that it holds, so those decide.
    candidates = both.filter((F.size("firsts") >= 2) & (F.greatest("left", "right") < F.col("n"))).select("lang", "phrase", F.col("n").alias("a"), F.element_at("firsts", 1).alias("total"), "firsts", "lasts")
    wide, m = (lambda c: c.cast("decimal(38,0)")), F.size("firsts")

    def cut(k: Column) -> Column:
        first, rest = F.element_at("firsts", k + 1), F.element_at("lasts", m - k + 1)
        score = F.call_function("div", wide(F.col("a")) * wide(F.col("total")) * F.lit(1000).cast("decimal(4,0)"), wide(first) * wide(rest))
        return F.struct(score.alias("score"), k.cast("long").alias("cut"), first.alias("l"), rest.alias("r"))

    weakest = F.array_min(F.transform(F.sequence(F.lit(1), m - 1), cut))
    phrase = F.translate(F.expr("substring(phrase, 1, length(phrase) - 1)"), END, " ")
    scored = candidates.select("lang", phrase.alias("phrase"), "a", F.col("total").alias("n"), weakest.alias("c")).select("lang", "phrase", "a", "n", "c.*")
    # A language may hold most phrases: the best of each part first, then of those.
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    parts = scored.withColumn("_part", F.pmod(F.hash("phrase"), F.lit(RANK_PARTS)))
    parts = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = parts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "cut", "a", "l", "r", "n", "score")
