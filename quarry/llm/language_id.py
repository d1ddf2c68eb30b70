"""Language identification by nearest centroid.

A text becomes a vector of hashed n-grams of the UTF-8 bytes of its lower-cased words of letters,
``log(1 + count) * idf``, scaled to length 1. Each language has several
centroids (spherical k-means over its labelled documents); a text takes the
language of the centroid with the largest cosine. A text whose cosine is below
nearly all of those that labelled documents of about its length have with the
same centroid is rejected.

The classifier is fitted on a sample of the labelled rows, about
``SAMPLE_PER_LANG`` for each language, chosen by a hash of the id; every row
of the table is classified, over its whole text. The limits of rejection come
from other labelled rows, about ``KEPT_OUT_PER_LANG`` for each language, and
from their beginnings, so that short texts have limits too.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32
from quarry.llm.common import id_text, map_slices

#: Bound of the fitting sample (expected rows of each language, taken from all labelled rows).
SAMPLE_PER_LANG = 400
DIMS = 4096
GRAMS = (2, 3)
CENTROIDS = 4
#: Rows kept out of the fit to set the limits (expected rows of each language); of a language with few rows, a quarter.
KEPT_OUT_PER_LANG = 1000
#: A language with fewer labelled rows than this is fitted on all of them.
LEAST_SPLIT = 20
#: Limit: this share of the cosine that one kept-out row in a thousand, and one row at least, lies below.
LIMIT_QUANTILE = 0.001
LIMIT_SHARE = 0.9
#: Beginnings are cut anywhere and in odd texts: one in a hundred may lie below, which leaves room enough.
BEGINNING_QUANTILE = 0.01
BEGINNING_SHARE = 1.0
#: Cosines that a limit takes, and fewer than which say little of the lowest: then with a smaller share.
LIMIT_ROWS = 25
SURE_ROWS = 300
UNSURE_SHARE = 0.6
#: Where all together are fewer: a cosine below this share of the least one is rejected.
REJECT_SHARE = 0.4
OTHER = re.compile(r"[\W\d_]+")
#: What may be a letter; some of these are numbers (``½``, ``Ⅷ``).
LETTER = re.compile(r"[^\W\d_]")
#: Languages that are learned, those with most labelled rows: the fitting sample is held by the driver.
MOST_LANGS = 256
#: Rows whose vectors a task holds at once.
BLOCK_ROWS = 256


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def counts(texts: list[str]) -> np.ndarray:
    """Hashed n-gram counts, one row per text."""
    rows = [np.frombuffer(OTHER.sub(" ", f" {t.lower()} ").encode("utf-8", "replace"), np.uint8) for t in texts]
    out = np.zeros((len(texts), DIMS), np.float32)
    shift = np.uint32(32 - (DIMS - 1).bit_length())
    for i, b in enumerate(rows):
        b = b.astype(np.uint32)
        for n in GRAMS:
            if len(b) < n:
                continue
            g = b[: len(b) - n + 1].copy()
            for k in range(1, n):
                g = (g << np.uint32(8)) | b[k: len(b) - n + 1 + k]
            slot = ((g + np.uint32(n)) * np.uint32(2654435761)) >> shift
            out[i] += np.bincount(slot, minlength=DIMS)
    return out


def unit(m: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(length == 0, 1, length)


def length_class(counted: np.ndarray) -> np.ndarray:
    """Power of two of the number of n-grams, 0 to 23."""
    return np.minimum(np.log2(1 + counted.sum(axis=1)).astype(int), 23)


def cluster(vectors: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of spherical k-means; far-apart starting points, so reruns agree."""
    start = [0]
    near = vectors @ vectors[0]
    while len(start) < min(k, len(vectors)):
        start.append(int(near.argmin()))
        near = np.maximum(near, vectors @ vectors[start[-1]])
    centres = vectors[start]
    for _ in range(rounds):
        of = (vectors @ centres.T).argmax(axis=1)
        centres = unit(np.stack([vectors[of == j].mean(axis=0) if (of == j).any() else centres[j] for j in range(len(centres))]))
    return centres


def fit(langs: list[str], counted: np.ndarray) -> dict:
    """The classifier: idf, centroids with their languages, and limits that reject nothing."""
    idf = (np.log((1 + len(langs)) / (1 + (counted > 0).sum(axis=0))) + 1).astype(np.float32)
    vectors = unit(np.log1p(counted) * idf)
    names, centres = [], []
    of = np.array(langs, object)
    for lang in sorted(set(langs)):
        found = cluster(vectors[of == lang], CENTROIDS)
        centres.append(found)
        names += [lang] * len(found)
    centre = np.concatenate(centres) if centres else np.zeros((0, DIMS), np.float32)
    return {"idf": idf, "centres": centre.astype(np.float32), "langs": names, "least": np.zeros((24, len(names)))}


def limits(best: np.ndarray, size: np.ndarray, top: np.ndarray, whole: np.ndarray, n_centres: int) -> np.ndarray:
    """The least cosine that is not rejected, by length class and centroid, from those (``top``) of rows kept out of the fit.

    Of a length, the larger of what whole texts and what many beginnings of
    texts say; for a centroid with many whole texts of that length, what these say. A
    length with few rows has the limit of the next shorter one.
    """
    def low(values: np.ndarray, quantile: float, share: float) -> float:
        if len(values) < LIMIT_ROWS:
            return 0.0
        return share * float(np.sort(values)[max(1, int(quantile * len(values)))])

    out = np.zeros((24, n_centres))
    if 0 < len(top) < LIMIT_ROWS:
        out[int(size.min()):] = REJECT_SHARE * top.min()
        return out
    for c in range(24):
        there, cut = (size == c) & whole, (size == c) & ~whole
        if max(there.sum(), cut.sum()) < LIMIT_ROWS:
            out[c] = out[c - 1] if c else 0.0
            continue
        out[c] = low(top[there], LIMIT_QUANTILE, LIMIT_SHARE if there.sum() >= SURE_ROWS else UNSURE_SHARE)
        if cut.sum() >= SURE_ROWS or there.sum() < LIMIT_ROWS:
            out[c] = np.maximum(out[c], low(top[cut], BEGINNING_QUANTILE, BEGINNING_SHARE if cut.sum() >= SURE_ROWS else UNSURE_SHARE))
        for j in range(n_centres):
            own = there & (best == j)
            if own.sum() >= SURE_ROWS:
                out[c, j] = low(top[own], LIMIT_QUANTILE, UNSURE_SHARE)
    return out


def beginnings(text: str) -> list[str]:
    """The text and its beginnings of 2, 4, 8 ... characters, those with a letter."""
    cuts = [text[:1 << k] for k in range(1, max(1, len(text) - 1).bit_length())]
    return [t for t in [text, *cuts] if has_letter(t)]


def nearest(model: dict, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with a letter: the nearest centroid, its cosine, and whether that is too small."""
    counted = counts(texts)
    cosine = unit(np.log1p(counted) * model["idf"]) @ model["centres"].T
    best = cosine.argmax(axis=1)
    top = np.clip(cosine.max(axis=1).astype(float), 0, 1)
    return best, top, top < model["least"][length_class(counted), best]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            keep = [i for i, t in enumerate(part.column("text").to_pylist()) if t and has_letter(t)]
            made = counts([part.column("text")[i].as_py() for i in keep])
            yield pa.RecordBatch.from_arrays([part.column("lang").take(pa.array(keep, pa.int64())), pa.array([m.tobytes() for m in made], pa.binary())], names=["lang", "counted"])


def train(docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """Fits on a sample of the rows that are ``usable`` and have a text and a language, and sets the limits by other such rows.

    Of more than ``MOST_LANGS`` languages those with most rows are learned (ties: the first in order).
    """
    rows = docs.filter(usable).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    held = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()}
    fitted = {lang: 1.0 if n < LEAST_SPLIT else min(0.75, SAMPLE_PER_LANG / n) for lang, n in held.items()}
    kept_out = {lang: fitted[lang] + KEPT_OUT_PER_LANG / n for lang, n in held.items()}
    chance = md5_u32(F.concat(F.lit("lang:"), F.coalesce("id", F.lit("")))) / F.lit(2.0**32)

    def share(shares: dict) -> Column:
        of = F.lit(0.0)
        for lang, value in shares.items():
            of = F.when(F.col("lang") == lang, value).otherwise(of)
        return of

    drawn = rows.filter(chance < share(fitted)).select("lang", "text")
    got = map_slices(drawn, _vectors, "lang string, counted binary").toPandas().sort_values(["lang", "counted"])
    counted = np.stack([np.frombuffer(b, np.float32) for b in got["counted"]]) if len(got) else np.zeros((0, DIMS), np.float32)
    model = fit(list(got["lang"]), counted)
    if not model["langs"]:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                parts = beginnings(text)
                if parts:
                    made = counts(parts)
                    cosine = unit(np.log1p(made) * shared.value["idf"]) @ shared.value["centres"].T
                    yield pa.RecordBatch.from_arrays([pa.array(cosine.argmax(axis=1), pa.int32()), pa.array(length_class(made), pa.int32()), pa.array(cosine.max(axis=1), pa.float32()), pa.array([True] + [False] * (len(parts) - 1))], names=["best", "size", "top", "whole"])

    other = rows.filter((chance >= share(fitted)) & (chance < share(kept_out))).select("text")
    seen = map_slices(other, measure, "best int, size int, top float, whole boolean").toArrow()  # at most 24 small rows for each row kept out
    best, size, top, whole = (seen.column(c).to_numpy() for c in ("best", "size", "top", "whole"))
    if not len(top):  # too few labelled rows to keep any out
        vectors = unit(np.log1p(counted) * model["idf"])
        best, size, top, whole = (vectors @ model["centres"].T).argmax(axis=1), length_class(counted), (vectors @ model["centres"].T).max(axis=1), np.ones(len(vectors), bool)
    return model | {"least": limits(best, size, top.astype(float), whole, len(model["langs"]))}


def classify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` of every row.

    ``score`` is the largest cosine (0 to 1). A null text or one without a
    letter, and any text if nothing could be learned, is ``und`` with score 0,
    rejected. Equal cosines: the language first in order. Repeated rows stay
    repeated, null ids stay null, an empty table gives an empty result.
    Row-local; memory is a slice of about 2 MB of text or one document.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # centroids: bounded by languages x CENTROIDS x DIMS

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                texts = part.column("text").to_pylist()
                able = [i for i, t in enumerate(texts) if t and has_letter(t)] if m["langs"] else []
                langs, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                if able:
                    best, score[able], rejected[able] = nearest(m, [texts[i] for i in able])
                    for i, b in zip(able, best.tolist()):
                        langs[i] = m["langs"][b]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs), pa.array(score), pa.array(rejected)], names=["doc_id", "lang_pred", "score", "rejected"])

    return map_slices(id_text(docs, id_col, text_col), kernel, "doc_id bigint, lang_pred string, score double, rejected boolean")


def accept(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                texts = part.column(text_col).to_pylist()
                able = [i for i, t in enumerate(texts) if t and has_letter(t)] if m["langs"] else []
                if able:
                    kept = [i for i, far in zip(able, nearest(m, [texts[i] for i in able])[2].tolist()) if not far]
                    yield part.take(pa.array(kept, pa.int64()))

    return map_slices(docs, kernel, docs.schema, text_col)
