"""Quality rules as learned decision lists.

Every whole text is reduced to counts; ratios of these are the features.
Sequential covering learns from labelled documents: a rule grows by the
threshold condition with the largest information gain until it covers no
good document of the growing part, is pruned from its end on the other
part, and is accepted if enough of what it covers is low quality; then the
documents it covers are put aside and the next rule is learned. The ordered
rules become one Spark ``CASE WHEN`` over the counts.

Learning uses at most about ``LABELLED_ROWS`` labelled rows, chosen by a hash
of their ids; counts and verdicts are made for every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_u32
from quarry.llm.common import WORD_RE, id_text, map_slices

#: Bound of the labelled sample (expected rows).
LABELLED_ROWS = 20_000
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 4, 40
#: A rule must cover this many low-quality documents, with this precision.
LEAST_COVER, LEAST_PRECISION = 5, 0.98

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
#: Features: a count over another.
FEATURES = {"words": ("n_words", None), "word_length": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
            "repeats": ("n_repeat_words", "n_words"), "upper": ("n_upper", "word_chars"), "digits": ("n_digits", "word_chars"), "marks": ("n_marks", "word_chars"), "line_words": ("n_words", "n_lines")}


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        self[word] = len(self)
        return self[word]


def count_text(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = WORD_RE.findall(text)
    lines = [line for line in text.split("\n") if WORD_RE.search(line)]
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    repeated = 0
    if len(words) > 3:
        ids = _Ids()
        w = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        pairs = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
        _, which, times = np.unique(pairs[:-1] * len(ids) + w[2:], return_inverse=True, return_counts=True)
        twice = times[which] > 1
        if twice.any():
            inside = np.zeros(len(w), bool)
            for k in range(3):
                inside[k:len(twice) + k] |= twice
            repeated = int(inside.sum())
    return (len(words), len(text) - int(raw[[32, *range(9, 14)]].sum()), int(raw[[ord(c) for c in "#*$%&|<>"]].sum()), len(lines) - len(set(lines)),
            repeated, len(lines), int(raw[65:91].sum()), int(raw[48:58].sum()), int(raw[[ord(c) for c in "!?|"]].sum()))


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the ``COUNTS`` of every row; a null text counts as empty."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [count_text(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in zip(*rows))], names=["doc_id", *COUNTS])

    return map_slices(id_text(docs, id_col, text_col), kernel, ", ".join(f"{c} bigint" for c in ("doc_id", *COUNTS)))


def feature(name: str) -> Column:
    over, under = FEATURES[name]
    return F.col(over).cast("double") / F.greatest(F.col(under), F.lit(1)) if under else F.col(over).cast("double")


def _grow(x: np.ndarray, low: np.ndarray, names: list[str]) -> list[tuple[str, str, float]]:
    rule: list[tuple[str, str, float]] = []
    inside = np.ones(len(low), bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~low).any():
        p0, n0 = int((inside & low).sum()), int((inside & ~low).sum())
        if not p0:
            break
        best = (1e-9, None, None)
        for j, name in enumerate(names):
            for cut in np.unique(np.quantile(x[inside & low, j], np.linspace(0, 1, CUTS))).tolist():
                for sign, hit in ((">=", x[:, j] >= cut), ("<=", x[:, j] <= cut)):
                    p1, n1 = int((inside & low & hit).sum()), int((inside & ~low & hit).sum())
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p0 / (p0 + n0))) if p1 else 0
                    if gain > best[0]:
                        best = (gain, (name, sign, cut), hit)
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[2]
    return rule


def covered(rule: list[tuple[str, str, float]], x: np.ndarray, names: list[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, sign, cut in rule:
        v = x[:, names.index(name)]
        out &= v >= cut if sign == ">=" else v <= cut
    return out


def learn_list(x: np.ndarray, low: np.ndarray, names: list[str]) -> list[list[tuple[str, str, float]]]:
    """Ordered conjunctions that find the rows marked ``low``; nothing if none is precise enough."""
    rules, tries = [], 0
    growing = np.arange(len(low)) % 3 != 0
    left = np.ones(len(low), bool)
    while len(rules) < MAX_RULES and tries < 4 * MAX_RULES and (left & growing & low).any():
        tries += 1
        rule = _grow(x[left & growing], low[left & growing], names)
        held = left & ~growing

        def worth(k: int) -> float:
            c = covered(rule[:k], x[held], names)
            p, n = int((c & low[held]).sum()), int((c & ~low[held]).sum())
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        rule = rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))]
        c = covered(rule, x, names) & left
        p, n = int((c & low).sum()), int((c & ~low).sum())
        if p >= LEAST_COVER and p >= LEAST_PRECISION * (p + n):
            rules.append(rule)
            left &= ~c
        elif (c & low).any():
            left &= ~(c & low)  # not precise enough: what it was grown on starts no other rule
        else:
            break
    return rules


def learn(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> list[list[tuple[str, str, float]]]:
    """The decision list for documents labelled 0, learned from those that pass the base. Rows without a label, or with a null id, teach nothing."""
    marked = labels.select(F.col(id_col).cast("long").alias("doc_id"), (F.col(label_col) == 0).alias("low")).dropna()
    share = min(1.0, LABELLED_ROWS / max(1, marked.count()))
    chance = md5_u32(F.concat(F.lit("rules:"), F.col("doc_id").cast("string"))) / F.lit(2.0**32)
    rows = marked.filter(chance < share).join(counted.filter(~base_failed()), "doc_id").select("doc_id", "low", *[feature(f).alias(f) for f in FEATURES])
    got = rows.toPandas().sort_values(["doc_id", "low", *FEATURES])
    return learn_list(got[list(FEATURES)].to_numpy(float), got["low"].to_numpy(bool), list(FEATURES))


def first_rule(rules: list[list[tuple[str, str, float]]]) -> Column:
    """The number (from 1) of the first rule that covers a row; 0 if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        every = F.lit(True)
        for name, sign, cut in rule:
            every = every & (feature(name) >= F.lit(float(cut)) if sign == ">=" else feature(name) <= F.lit(float(cut)))
        out = F.when(every, i) if out is None else out.when(every, i)
    return F.lit(0) if out is None else out.otherwise(0)


def base_failed() -> Column:
    """Fewer than 50 words, or over half of the words in repeated 3-word windows."""
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def verdicts(counted: DataFrame, rules: list[list[tuple[str, str, float]]]) -> DataFrame:
    """``counted`` with ``base_failed``, ``rule`` (of the list, 0 for none) and ``kept``.

    A null or empty text fails the base. Repeated rows and null ids are judged row by row; an empty table
    gives an empty result; without usable labels no rule removes anything.
    """
    return counted.withColumn("base_failed", base_failed()).withColumn("rule", first_rule(rules)).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
