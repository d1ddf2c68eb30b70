"""Base patterns against plain regular expressions, disclosing terms against plain counting."""

import math
import re
import time
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import pii
from tests.llm.helpers import clashing, docs, edge_rows, rows_of

PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = "".join(c for c in m[0] if c in "0123456789")
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")) or kind == 2 and not (16 <= len(digits) <= 19 and luhn(digits)) or kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end(), m[0].lower() if kind == 0 else m[0] if kind == 1 else digits))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", "a@b", ".", "x_y", "1", "255", "256", "007", "1.2.3.4", "+", "+1", "(", ")", "-", " ", "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004", "%", "é", "\n", "3782"]), max_size=24))
def test_base_equals_plain(parts):
    text = "".join(parts)
    assert list(pii.values(text)) == plain_base(text)


def test_long_runs_are_linear():
    begun = time.time()
    for text in ("a" * 1_000_000, "a." * 500_000 + "@", "1" * 1_000_000, "1." * 500_000, "1 " * 500_000, "+1" + "(" * 1_000_000, "a@" * 300_000):
        list(pii.values(text))
    assert time.time() - begun < 20


def plain_spans(rows, threshold=pii.DISCLOSURE, window=pii.WINDOW):
    """Spans of every row by counting in dictionaries."""
    term = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
    entity_docs, term_docs, together, contexts, near_all = Counter(), Counter(), Counter(), defaultdict(set), []
    for _, text in rows:
        text = text or ""
        base = plain_base(text)
        words = {w.lower() for w in term.findall(text)}
        term_docs.update(words | {pii.generalised(w) for w in words})
        free = [m for m in term.finditer(text) if not any(s < m.end() and m.start() < e for _, s, e, _ in base)]
        pairs, near_rows = set(), []
        for kind, start, end, value in base:
            near = [m for m in free if m.end() <= start][-window:] + [m for m in free if m.start() >= end][:window]
            context = tuple(m[0].lower() for m in near)
            for m in near:
                word = m[0].lower()
                near_rows.append(((kind, value), word, m.span()))
                contexts[(kind, value), word].add(context)
                pairs |= {((kind, value), word), ((kind, value), pii.generalised(word))}
        entity_docs.update({(k, v) for k, _, _, v in base})
        together.update(pairs)
        near_all.append((base, near_rows))

    def share(e, t):
        information = math.log(len(rows) / entity_docs[e])
        return math.log(together[e, t] * len(rows) / (term_docs[t] * entity_docs[e])) / information if information > 0 else 0

    out = []
    for (i, _), (base, near) in zip(rows, near_all):
        added = {}
        for e, word, span in near:
            if len(contexts[e, word]) > 1 and share(e, word) >= threshold:
                added[span] = max(added.get(span, 0), 4 if share(e, pii.generalised(word)) < threshold else 5)
        out.append((i, sorted({(k, s, e) for k, s, e, _ in base} | {(k, *span) for span, k in added.items()})))
    return sorted(out, key=repr)


def found(df, **more):
    return sorted(((r["doc_id"], [tuple(s) for s in r["found"]]) for r in pii.scan(df, **more).collect()), key=repr)


FILLER = "the report of many things that were said on a day like any other in the town by the river and wrote from there".split()


def planted():
    rows = []
    for i in range(60):
        words = FILLER[i % 7:] + FILLER[:i % 7]
        text = " ".join(words)
        if i % 20 == 3:  # Ottoline stands only near this address; of names like Quagmire, others exist elsewhere
            text = " ".join(words[:5]) + " Ottoline Quagmire wrote from o.q@example.org and " + " ".join(words[5:])
        elif i % 4 == 1:
            text += " Quagmare came"
        rows.append((i, text))
    copy = "Only Zebulon knows +1 (555) 555-0100 of all"
    return rows + [(100 + i, copy) for i in range(20)]


def test_terms_that_reveal(spark):
    rows = planted()
    got = dict(found(docs(spark, rows)))
    assert sorted(got.items(), key=repr) == plain_spans(rows)
    text = dict(rows)[3]
    assert {(pii.KINDS[k], text[s:e]) for k, s, e in got[3]} >= {("email", "o.q@example.org"), ("removed", "Ottoline"), ("general", "Quagmire")}
    assert "the" not in {text[s:e] for _, s, e in got[3]}
    assert all(not got[i] for i, t in rows if "@" not in t and "+" not in t)
    assert [k for k, _, _ in got[100]] == [3]  # copies of one context prove nothing
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs(spark, rows)).collect()}
    assert "Ottoline" not in clean[3] and "Quag" not in clean[3] and "~quag wrote from <email> and" in clean[3] and clean[0] == rows[0][1]
    assert clean[100] == "Only Zebulon knows <phone> of all"


def test_edges(spark):
    rows = edge_rows() + [(20, "a@b.c a@b.c 1.2.3.4" + " +1 (555) 555-0100 4111 1111 1111 1111" * 300), (20, "other text x@y.zz"), (None, "x@y.zz again x@y.zz"), (21, "é漢 \U0001F600 x@y.zz")]
    want = plain_spans(rows)
    assert found(docs(spark, rows)) == want
    assert found(clashing(docs(spark, rows))) == want
    assert found(docs(spark, rows).limit(0)) == []
    table = clashing(docs(spark, rows))
    clean = pii.sanitise(table)
    assert clean.columns == table.columns and clean.count() == len(rows)
    assert rows_of(pii.sanitise(docs(spark, [(1, None), (None, "")]))) == rows_of(docs(spark, [(1, None), (None, "")]))


def test_query_equals_plain(spark):
    from quarry.llm.queries import op13_pii

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    want = {repr(i): ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in spans) for i, spans in plain_spans(rows)}
    assert {repr(r["doc_id"]): r["spans"] for r in op13_pii(spark, "/root/testdata/sf0.001").collect()} == want
