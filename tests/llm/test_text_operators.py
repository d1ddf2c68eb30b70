"""Language identification, secret scans, quality rules and line chunks."""

import hashlib
import random
import re
import time

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import language_id, line_chunks, quality_rules, secret_scan
from tests.conftest import SF_CHECK
from tests.llm.helpers import clashing, docs, edge_rows


# -- language ---------------------------------------------------------------

def test_held_out_accuracy(spark):
    table = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.train(table, ~held)
    got = table.filter(held).select("doc_id", "lang").join(language_id.classify(table, model), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_language_edges(spark):
    rows = [(100 + i, "the cat and the dog are in the house by the river", "en") for i in range(20)] + [(200 + i, "der Hund und die Katze sind in dem Haus an einem Fluss", "de") for i in range(20)]
    model = language_id.train(docs(spark, [(*r, "s") for r in rows]), F.lit(True))
    df = clashing(docs(spark, edge_rows() + [(11, "12 34 %%"), (12, "die Katze und der Hund")]))
    got = {(r.doc_id, r.lang_pred): r for r in language_id.classify(df, model).collect()}
    for i in (2, 3, 4, 11):
        assert got[i, "und"].score == 0 and got[i, "und"].rejected
    assert (12, "de") in got and 0 <= got[12, "de"].score <= 1
    kept = language_id.accept(df, model)
    assert kept.columns == df.columns and not {2, 3, 4, 11} & {r.doc_id for r in kept.collect()}
    assert language_id.classify(df.limit(0), model).collect() == []
    nothing = language_id.train(docs(spark, [(1, "text")]), F.lit(False))
    assert {r.lang_pred for r in language_id.classify(df, nothing).collect()} == {"und"}


def test_numbers_are_no_letters(spark):
    rows = [(100 + i, "the cat and the dog are in the house by the river", "en", "s") for i in range(20)]
    model = language_id.train(docs(spark, rows), F.lit(True))
    got = language_id.classify(docs(spark, [(1, "½ ²"), (2, "Ⅷ"), (3, "½" * 5000), (4, "½ the cat")]), model).collect()
    assert {r.doc_id: (r.lang_pred, r.score == 0, r.rejected) for r in got if r.doc_id < 4} == dict.fromkeys((1, 2, 3), ("und", True, True))
    assert [r.lang_pred for r in got if r.doc_id == 4] == ["en"]


def test_most_languages(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGS", 2)
    rows = [(i, f"words of language {i % 5} here", f"l{i % 5}", "s") for i in range(50)] + [(100 + i, "der die das", "de", "s") for i in range(30)]
    assert set(language_id.train(docs(spark, rows), F.lit(True))["langs"]) == {"de", "l0"}


def test_junk_is_rejected(spark):
    table = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = language_id.train(table, F.lit(True))
    got = language_id.classify(docs(spark, [(1, "漢字仮名交じり文" * 20), (2, "xqzjvkwxqzjvkw" * 20)]), model).collect()
    assert all(r.rejected for r in got)


# -- secrets ----------------------------------------------------------------

def test_spans_equal_finditer(spark):
    rnd = random.Random(4)
    bits = ["password", "Secret: ", "token=", "api_key", "APIKEY=", '"', "'", " ", " : ", "=", "abc", "AKIA", "ABCDEFGHIJ0123456789", "0123456789abcdef", "deadbeef", "é漢", "\n", "hunter22", "-----BEGIN RSA PRIVATE KEY-----", "eyJhbGciOiJ.eyJzdWIiOi.x_y"]
    rows = [(i, "".join(rnd.choices(bits, k=rnd.randrange(1, 14)))) for i in range(400)]
    rows += [(1000, "secret: token: abcdefgh"), (1001, "token=" + "a" * 5), (1002, "AKIA" + "X" * 15 + " AKIA" + "X" * 16), (1003, "ſecret=abcdefgh toKen=abcdefgh")]
    found, _ = secret_scan.scan(docs(spark, rows))
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.found] for r in found.collect()}
    patterns = {
        "assign": (r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
        "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]+", 0, 24),
        "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1), "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, 1)}
    for i, text in rows:
        want = [(m.start(), at, kind, m.end()) for at, (kind, (p, g, least)) in enumerate(patterns.items()) for m in re.finditer(p, text, re.A) if len(m[g]) >= least]
        if "ſ" in text:
            want = [w for w in want if not text[w[0]] == "ſ"]
        assert got[i] == [(k, s, e) for s, _, k, e in sorted(want)], text


def test_many_findings_in_one_text(spark):
    """Time grows with the findings, not with their square; places go on across blocks."""
    text = "é " + " ".join(hashlib.sha256(str(i).encode()).hexdigest()[:40] for i in range(40_000))
    begun = time.time()
    (row,) = secret_scan.scan(docs(spark, [(1, text)]))[0].collect()
    assert [(s.start, s.end) for s in row.found if s.kind == "hex"] == [m.span() for m in re.finditer("[0-9a-f]{24,}", text)]
    assert time.time() - begun < 15
    for n in (1, secret_scan.BLOCK - 1, secret_scan.BLOCK, secret_scan.BLOCK + 1, 2 * secret_scan.BLOCK):
        part = " ".join(text.split(" ")[:n + 1])
        (row,) = secret_scan.scan(docs(spark, [(1, part)]))[0].collect()
        assert [(s.start, s.end) for s in row.found] == [m.span() for m in re.finditer("[0-9a-f]{24,}", part)]


def test_ledger_scans_only_what_it_lacks(spark):
    first, ledger = secret_scan.scan(docs(spark, [(1, "token=abcdefgh"), (2, "nothing"), (3, "token=abcdefgh")]))
    ledger = ledger.withColumn("found", F.when(F.col("kind") == "assign", F.col("found")).otherwise(F.col("found")))
    assert ledger.count() == 2 * len(secret_scan.RULES)
    later = docs(spark, [(1, "token=abcdefgh"), (4, "AKIA" + "B" * 16)])
    found, total = secret_scan.scan(later, ledger)
    assert total.count() == 3 * len(secret_scan.RULES)
    assert {r.doc_id: [s.kind for s in r.found] for r in found.collect()} == {1: ["assign"], 4: ["access"]}
    # What the ledger says of a known blob is not looked up again in the text.
    marked = total.withColumn("found", F.slice("found", 1, 0))
    assert {r.doc_id: len(r.found) for r in secret_scan.scan(later, marked)[0].collect()} == {1: 0, 4: 0}
    # A new version of a rule is scanned again, alone.
    newer = tuple(secret_scan.Rule(r.kind, r.pattern, r.group, r.least, 2, r.base) if r.kind == "access" else r for r in secret_scan.RULES)
    found, total = secret_scan.scan(later, marked, rules=newer)
    assert {r.doc_id: len(r.found) for r in found.collect()} == {1: 0, 4: 1}
    assert total.filter("kind = 'access' AND version = 2").count() == 2


def test_versions_share_one_ledger(spark):
    """Findings equal those of one run; a blob that an earlier version held is not scanned again."""
    rows = [(i, ["token=abcdefgh", "nothing", None, "AKIA" + "B" * 16, "token: " + "x" * i][i % 5]) for i in range(40)] + [(None, "token=abcdefgh"), (0, "other")]
    table = docs(spark, rows)
    parts = [table.filter("coalesce(doc_id, 0) % 2 = 0"), table.filter("doc_id % 2 = 1"), table.limit(0)]
    found, ledger = secret_scan.scan_versions(parts)
    once, whole = secret_scan.scan(table)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, once.collect()))
    assert ledger.count() == ledger.dropDuplicates(["blob", "kind", "version"]).count() == whole.count()


def test_secret_edges(spark):
    rows = edge_rows() + [(20, "token=abcdef"), (20, "token=abcdef"), (20, "other"), (None, "token=abcdef")]
    found, _ = secret_scan.scan(clashing(docs(spark, rows)))
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted(len(r.found) for r in got if r.doc_id == 20) == [0, 1, 1]
    assert sorted(len(r.found) for r in got if r.doc_id is None) == [0, 1]
    assert secret_scan.scan(docs(spark, [(1, "a")]).limit(0))[0].collect() == []


# -- quality rules ----------------------------------------------------------

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def test_counts_equal_brute_force(spark):
    rnd = random.Random(8)
    rows = [(i, "".join(rnd.choices(["a", "b ", "é漢 ", "\n", "x y z ", "#", "| ", "\t", "\x0b", " "], k=rnd.randrange(60)))) for i in range(300)]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.text_counts(docs(spark, rows)).collect()}
    assert got == {i: brute_counts(t) for i, t in rows}


def test_list_is_learned_and_emitted(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(600, 2))
    low = (x[:, 0] > 0.8) | ((x[:, 1] < 0.1) & (x[:, 0] < 0.5))
    rules = quality_rules.learn_list(x, low, ["symbols", "upper"])
    assert rules
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= quality_rules.covered(r, x, ["symbols", "upper"])
    assert (hit & ~low).sum() <= 0.02 * hit.sum() and (hit & low).sum() >= 0.8 * low.sum()
    noise = quality_rules.learn_list(x, rng.uniform(size=600) < 0.5, ["symbols", "upper"])
    assert noise == []


def test_quality_held_out(spark):
    counted = quality_rules.text_counts(spark.read.parquet(f"{SF_CHECK}/documents.parquet"))
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    part = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rules = quality_rules.learn(counted, labels.filter(part))
    got = quality_rules.verdicts(counted, rules).join(labels.filter(~part), "doc_id").collect()
    low = [r for r in got if r.quality == 0]
    assert sum(not r.kept for r in low) >= 0.9 * len(low)
    assert all(r.rule == 0 for r in got if r.quality == 1 and not r.base_failed)


def test_quality_edges(spark):
    counted = quality_rules.text_counts(clashing(docs(spark, edge_rows())))
    labels = spark.createDataFrame([(1, 0), (None, 0), (7, None)], "doc_id long, quality int")
    rules = quality_rules.learn(counted, labels)
    got = quality_rules.verdicts(counted, rules).collect()
    assert len(got) == len(edge_rows())
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 50)
    assert quality_rules.verdicts(quality_rules.text_counts(docs(spark, [(1, "a")]).limit(0)), []).collect() == []


# -- line chunks ------------------------------------------------------------

def brute_lines(rows):
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        kept, gone = [], 0
        for chunk in line_chunks.chunks(text or ""):
            body = "\n".join(chunk)
            if len([x for x in chunk if x.split()]) >= 2 and body in seen:
                gone += len(chunk)
            else:
                kept.append(body)
            seen.add(body)
        out.append((doc, "\n".join(kept), gone))
    return sorted(out, key=repr)


def test_chunks_equal_brute_force(spark):
    rnd = random.Random(2)
    passages = [[f"line {rnd.randrange(10**6)} of a passage" for _ in range(n)] for n in (3, 9, 20)]
    rows = []
    for i in range(120):
        parts = [[f"own {rnd.randrange(10**6)}" for _ in range(rnd.randrange(5))] if rnd.random() < 0.5 else rnd.choice(passages) for _ in range(4)]
        rows.append((i, "\n".join(x for p in parts for x in p)))
    rows += [(500, "\n".join(passages[2])), (501, None), (502, ""), (503, "\n\n\n\n"), (504, "same\n" * 50), (505, rows[3][1])]
    got = line_chunks.dedup(docs(spark, rows)).collect()
    want = brute_lines(rows)
    assert sorted(((r.doc_id, r.text or "", r._lines.n_removed) for r in got), key=repr) == want
    assert sum(w[2] for w in want) > 300


def test_boundaries_resist_shifts():
    lines = [f"line {i} {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(200)]
    plain = {"\n".join(c) for c in line_chunks.chunks("\n".join(lines))}
    shifted = {"\n".join(c) for c in line_chunks.chunks("\n".join(["new first line", *lines]))}
    assert len(plain & shifted) >= len(plain) - 2


def test_line_edges(spark):
    many = "\n".join(f"row {i} here" for i in range(40))
    df = clashing(docs(spark, edge_rows() + [(30, many), (30, many), (31, many), (None, many)]))
    done = line_chunks.dedup(df)
    assert [c for c in done.columns if c != "_lines"] == [c for c in df.columns if c != "_lines"]
    got = done.collect()
    assert [r._lines.n_removed for r in got if r.doc_id == 30] == [0, 0]
    assert next(r for r in got if r.doc_id == 31)._lines.n_removed > 30
    assert next(r for r in got if r.doc_id == 2).text is None
    left = line_chunks.drop_emptied(done).collect()
    assert {2, 3, 4} <= {r.doc_id for r in left}
    assert line_chunks.dedup(docs(spark, [(1, "a")]).limit(0)).collect() == []
