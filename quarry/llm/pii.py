"""Personal data, and the terms that give it away: information-theoretic sanitisation.

E-mail addresses, IP addresses, card and telephone numbers are found by
pattern; each distinct value is a protected entity. A term that stands near
an entity may reveal it even where the value itself is masked. How strongly
it does is estimated from co-occurrence over the whole corpus: the pointwise
mutual information of term and entity, as a share of the entity's own
information content. Where that share reaches the disclosure threshold, the
term is replaced by its generalisation (``~`` and the first half of its
letters, or its shape if it has digits) if that one discloses less, else removed. Terms are judged only where the
entity stands near, so documents without personal data are left alone.

A chance neighbour of a rare value would always reveal it; a pair counts
only if it occurs in two different contexts, and a context that is copied a
thousand times is one.

Two passes over the texts: one emits narrow rows (64-bit names, places) for each value and each term
near it, the other counts in how many documents each candidate term stands, skipping other
terms by a bitmap. Texts are not shuffled but to rewrite them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.bitmaps import bitmap, inside
from quarry.llm.common import fresh, map_slices, written

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds in the order in which spans are listed; the last two are terms that reveal a value near them.
KINDS = (*BASE_KINDS, "general", "removed")
#: Terms on each side of a value that stand near it.
WINDOW = 10
#: Share of an entity's information that a term may disclose.
DISCLOSURE = 0.9
#: The bitmap of candidate terms has 16 bits for each, up to two to this power.
MOST_BITS = 26
NO_ID = (1 << 63) - 1
#: Rows of one Arrow batch, whatever the text they come from.
BATCH_ROWS = 50_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# Starts inside a run of digits match nothing that its first digit does not match, so they need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Read from each @: leftmost matches in one pass, however long the runs around it."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            last = domain.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    return sum(sum(divmod(int(d) * 2, 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _digits(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def values(text: str) -> Iterator[tuple[int, int, int, str]]:
    """``(kind, start, end, normal form)`` of the personal data in a text: by kind, then start; code points, end exclusive."""
    for start, end in _emails(text):
        yield 0, start, end, text[start:end].lower()
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield 1, m.start(), m.end(), m[0]
    for m in _CARD.finditer(text):
        if 16 <= len(digits := _digits(m[0])) <= 19 and _luhn(digits):
            yield 2, m.start(), m.end(), digits
    for m in _PHONE.finditer(text):
        if 8 <= len(digits := _digits(m[0])) <= 15:
            yield 3, m.start(), m.end(), digits


def generalised(term: str) -> str:
    """What covers the term and others: its shape if it has digits, else the first half of its letters."""
    if any(c.isdigit() for c in term):
        return "~" + "".join("0" if c.isdigit() else c for c in term)
    return "~" + term[:(len(term) + 1) // 2]


def _name(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


_NEAR = "id bigint, body bigint, kind int, start bigint, end bigint, entity bigint, term bigint, general bigint, context bigint, is_first boolean, is_first_general boolean, is_first_term boolean"


def _near(text: str) -> Iterator[tuple]:
    """A row for each value (term null), and one for each term near it."""
    found = list(values(text))
    if not found:
        return
    taken = sorted((start, end) for _, start, end, _ in found)
    terms, at, upto = [], 0, 0
    for m in _TERM.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            upto = max(upto, taken[at][1])
            at += 1
        if m.start() >= upto:
            terms.append(m.span())
    starts = [s for s, _ in terms]
    names: dict[str, tuple[int, int]] = {}
    seen, seen_general = set(), set()
    for kind, start, end, value in found:
        entity = _name(f"{kind}:{value}")
        yield kind, start, end, entity, None, None, None, (entity not in seen), False, False
        seen.add(entity)
        lo, hi = bisect_left(starts, start), bisect_left(starts, end)
        near = terms[max(0, lo - WINDOW):lo] + terms[hi:hi + WINDOW]
        own = []
        for s, e in near:
            word = text[s:e].lower()
            if word not in names:
                names[word] = _name(word), _name(generalised(word))
            own.append(names[word])
        context = xxhash.xxh3_64_intdigest(np.array([t for t, _ in own], np.int64).tobytes()) - (1 << 63)
        for (s, e), (term, general) in zip(near, own):
            yield kind, s, e, entity, term, general, context, (entity, term) not in seen, (entity, general) not in seen_general, (None, term) not in seen
            seen |= {(entity, term), (None, term)}
            seen_general.add((entity, general))


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    own = F.col(id_col).cast("long")
    return docs.select(own.alias("doc_id"), F.coalesce(own, F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("body"), text.alias("text"))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All values of all texts, and the terms near them, as narrow rows."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 6, *[pa.bool_()] * 3]
        names = [field.split()[0] for field in _NEAR.split(", ")]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types)], names=names)
        rows = []
        for batch in batches:
            for i, b, t in zip(*(batch.column(x).to_pylist() for x in ("id", "body", "text"))):
                for row in _near(t) if t else ():
                    rows.append((i, b, *row))
                    if len(rows) >= BATCH_ROWS:
                        yield pack(rows)
                        rows = []
        yield pack(rows)

    return map_slices(_read(docs, id_col, text_col), kernel, _NEAR)


def _term_counts(docs: DataFrame, candidates: DataFrame, n_candidates: int, id_col: str, text_col: str) -> DataFrame:
    """``name, documents``: in how many texts each candidate (a term or a generalisation) stands, and some others."""
    bits = max(16, min(MOST_BITS, (16 * n_candidates).bit_length()))
    table = docs.sparkSession.sparkContext.broadcast(bitmap(candidates.select(F.expr(f"shiftrightunsigned(name, {64 - bits})").alias("slot")), bits))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[int, ...]] = {}
        held, counts = 0, Counter()
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.int64()), pa.array(counts.values(), pa.int64())], names=["name", "n"])
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = {w.lower() for w in set(_TERM.findall(text))} if text else set()
                new = [w for w in words if w not in known]
                if new:
                    both = np.array([(_name(w), _name(generalised(w))) for w in new], np.int64)
                    hit = inside(table.value, both >> (64 - bits) & ((1 << bits) - 1))
                    for w, pair, yes in zip(new, both.tolist(), hit.tolist()):
                        known[w] = tuple(x for x, y in zip(pair, yes) if y)
                        held += len(w)
                counts.update({x for w in words for x in known[w]})
                if len(known) > 100_000 or held > 8 << 20:
                    known, held = {}, 0
            if len(counts) > BATCH_ROWS:
                yield pack()
                counts = Counter()
        yield pack()

    partial = map_slices(_read(docs, id_col, text_col), kernel, "name bigint, n bigint")
    return partial.groupBy("name").agg(F.sum("n").alias("documents"))


def disclosing(docs: DataFrame, near: DataFrame, threshold: float = DISCLOSURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``entity, term, share, kind`` of the pairs in which the term discloses ``threshold`` or more of the entity's information; kind is ``general`` or ``removed``."""
    count = lambda flag: F.sum(F.col(flag).cast("long"))
    terms = near.filter(F.col("term").isNotNull())
    pairs = terms.groupBy("entity", "term", "general").agg(count("is_first").alias("together"), F.min("context").alias("a"), F.max("context").alias("b")).filter("a != b").drop("a", "b")
    total = docs.count()
    entities = near.filter(F.col("term").isNull()).groupBy("entity").agg(count("is_first").alias("of_entity"))

    def share(together: str, documents: str) -> Column:
        information = F.log(F.lit(float(total)) / F.col("of_entity"))
        return F.when(information > 0, F.log(F.col(together) * F.lit(float(total)) / (F.col(documents) * F.col("of_entity"))) / information).otherwise(0.0)

    # A term stands in at least as many documents as it stands near any value: what falls short with those need not be counted.
    at_least = terms.groupBy("term").agg(count("is_first_term").alias("near_values"))
    pairs = pairs.join(entities, "entity").join(at_least, "term").filter(share("together", "near_values") >= threshold).drop("near_values")
    pairs = written(pairs, "pii-pairs")
    candidates = written(pairs.select(F.explode(F.array("term", "general")).alias("name")).distinct(), "pii-candidates")
    counts = written(_term_counts(docs, candidates, candidates.count(), id_col, text_col), "pii-term-counts")
    general = terms.join(pairs.select("entity", "general").distinct(), ["entity", "general"], "left_semi").groupBy("entity", "general").agg(count("is_first_general").alias("together_general"))
    named = lambda name, documents: counts.select(F.col("name").alias(name), F.col("documents").alias(documents))
    judged = pairs.join(named("term", "of_term"), "term").withColumn("share", share("together", "of_term")).filter(F.col("share") >= threshold)
    judged = judged.join(general, ["entity", "general"]).join(named("general", "of_general"), "general").withColumn("general_share", share("together_general", "of_general"))
    return judged.select("entity", "term", "share", F.when(F.col("general_share") < threshold, KINDS.index("general")).otherwise(KINDS.index("removed")).alias("kind"))


def _spans(docs: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """``id, body, _found`` of the documents that have spans: ``kind, start, end``, by kind, then start."""
    near = written(neighbours(docs, id_col, text_col), "pii-near")
    verdicts = disclosing(docs, near, threshold, id_col, text_col)
    added = near.filter(F.col("term").isNotNull()).select("id", "body", "entity", "term", "start", "end").join(verdicts.select("entity", "term", "kind"), ["entity", "term"])
    added = added.groupBy("id", "body", "start", "end").agg(F.max("kind").alias("kind"))
    base = near.filter(F.col("term").isNull())
    every = base.select("id", "body", "kind", "start", "end").unionByName(added)
    return every.groupBy("id", "body").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "end"))).alias("_found"))  # of one document


def scan(docs: DataFrame, threshold: float = DISCLOSURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, found`` of every row: spans ``kind`` (place in ``KINDS``), ``start, end`` in code points, end exclusive, by kind, then start.

    Null text counts as empty; rows with one id and one text get the same spans and count as often as
    they stand; ids may be null; an empty table gives an empty result; other
    columns are not read, so none can clash. A term near several entities is
    removed if it is for one of them.
    """
    found = _spans(docs, threshold, id_col, text_col)
    none = F.from_json(F.lit("[]"), "array<struct<kind: int, start: bigint, end: bigint>>")
    return _read(docs, id_col, text_col).drop("text").join(found, ["id", "body"], "left").select("doc_id", F.coalesce("_found", none).alias("found"))


def listed(found: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kinds = F.lit(list(KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, threshold: float = DISCLOSURE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns: values replaced by their kind in angle brackets, disclosing terms generalised or removed.

    Spans that overlap go together, under the first one's kind. Null text stays null; see :func:`scan` for the rest.
    """
    own_id, own_body, own_found = fresh(docs, "_id", "_body", "_found")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    marked = docs.withColumn(own_id, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn(own_body, F.xxhash64(text))
    joined = marked.join(_spans(docs, threshold, id_col, text_col).toDF(own_id, own_body, own_found), [own_id, own_body], "left").select(*docs.columns, own_found)
    names = list(docs.columns)

    def clean(text: str, found: list[dict]) -> str:
        out, last = [], 0
        for s in sorted(found, key=lambda s: (s["start"], s["kind"])):
            if s["start"] >= last:
                out.append(text[last:s["start"]])
                kind = KINDS[s["kind"]]
                out.append("" if kind == "removed" else generalised(text[s["start"]:s["end"]].lower()) if kind == "general" else f"<{kind}>")
            last = max(last, s["end"])
        return "".join(out) + text[last:]

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [clean(t, f) if t and f else t for t, f in zip(batch.column(text_col).to_pylist(), batch.column(own_found).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text_col else batch.column(c) for c in names], names=names)

    return map_slices(joined, rewrite, docs.schema, text_col)
