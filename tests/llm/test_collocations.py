"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

from quarry.llm import collocations
from tests.llm.helpers import clashing, docs, edge_rows, rows_of


def plain_counts(rows):
    """``{lang: {phrase: n}}`` of all phrases of one to five words."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts["und" if lang is None else lang].update(tuple(words[i:i + m]) for m in range(1, 6) for i in range(len(words) - m + 1))
    return counts


def plain(rows, least, top):
    out = []
    for lang, f in plain_counts(rows).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        frequent = {p: c for p, c in f.items() if c >= least}
        best = []
        for p, a in frequent.items():
            if len(p) < 2 or any(len(q) > len(p) and c >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, c in frequent.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), k, f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), k, -a, l, r, n, -score) for i, (score, a, p, k, l, r) in enumerate(sorted(best)[:top], 1)]
    return sorted(out, key=repr)


def pairs(rows):
    return [(r[2] if len(r) > 2 else "en", r[1]) for r in rows]


def random_rows(seed, n=120):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "ab", "a\x01", "\x01", "é", "漢", "Ab", "new", "york", "x\x0ey", "of\x1f"]
    fixed = ["new york city hall of", "the end of the day", "a a a a a a", "one, two; three"]
    text = lambda: "".join(rng.choice(fixed if rng.random() < 0.2 else words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ", "]) for _ in range(rng.randrange(40)))
    return [(i, text(), rng.choice(["en", "en", "de", "und", None]), "s") for i in range(n)]


def test_equals_plain(spark):
    for seed, least, top in ((1, 3, 2000), (2, 5, 7), (3, 2, 40)):
        rows = random_rows(seed)
        assert rows_of(collocations.mine(docs(spark, rows).repartition(5), least, top)) == plain(pairs(rows), least, top)


def test_partitions_do_not_matter(spark):
    """As many sorted partitions as phrases, so that nearly each begins inside an open phrase; and a hot first word."""
    rows = random_rows(4) + [(200 + i, f"the end of the day number w{i % 9} the end of w{i % 5}", "en", "s") for i in range(60)]
    want = plain(pairs(rows), 2, 5000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "3", "97"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert rows_of(collocations.mine(docs(spark, rows), 2, 5000)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_small_bitmap_and_slices(spark, monkeypatch):
    """A full bitmap lets more through, small slices and a short memory split the work; the result is the same."""
    rows = random_rows(5)
    want = plain(pairs(rows), 3, 2000)
    for name, value in (("SLICE", 60), ("KNOWN_WORDS", 5)):
        monkeypatch.setattr(collocations, name, value)
    assert rows_of(collocations.mine(docs(spark, rows), 3, 2000, most_bits=6)) == want


def test_exact_beyond_64_bits(spark):
    stream = spark.createDataFrame([("en", "", 9 * 10**17), ("en", "a\t", 7 * 10**17), ("en", "b\t", 10**17 + 1), ("en", "a\tb\t", 10**17)], "lang string, phrase string, n bigint")
    collocations_of = collocations.count_streams
    try:
        collocations.count_streams = lambda *_: stream
        (row,) = collocations.mine(spark.createDataFrame([], "lang string, text string")).collect()
    finally:
        collocations.count_streams = collocations_of
    assert row["score"] == 1000 * 10**17 * 9 * 10**17 // (7 * 10**17 * (10**17 + 1)) and row["cut"] == 1


def test_edges(spark):
    rows = edge_rows() * 3 + [(30, "x y " * 3, None), (31, ". , ;", "fr"), (32, None, None)]
    want = plain(pairs(rows), 3, 2000)
    assert rows_of(collocations.mine(docs(spark, rows), 3)) == want
    assert rows_of(collocations.mine(clashing(docs(spark, rows)), 3)) == want
    assert rows_of(collocations.mine(docs(spark, rows).limit(0), 3)) == []
