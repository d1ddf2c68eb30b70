"""Shared passages of few lines, wherever they stand in a document."""

import random

import corpus_pipeline
from quarry.llm import line_chunks
from tests.llm.helpers import docs


def brute_passages(rows, least=50):
    """Lines in a run of over ``least`` words that also occurs earlier, by comparing all runs; then what the chunks remove."""
    out, runs, seen = {}, {}, set()
    for doc, text in rows:
        lines, gone, at = text.split("\n"), set(), 0
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = "\n".join(lines[a:b + 1])
                if len(run.split()) > least:
                    if run not in runs:
                        runs[run] = (doc, b)
                    else:
                        home, upto = runs[run]
                        gone.update(range(max(a, upto + 1) if home == doc else a, b + 1))
        for chunk in line_chunks.chunks(text):
            body = "\n".join(chunk)
            if sum(1 for x in chunk if x.split()) >= 2 and body in seen:
                gone.update(range(at, at + len(chunk)))
            seen.add(body)
            at += len(chunk)
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def sentence(rnd, n):
    return " ".join(f"w{rnd.randrange(10**7)}" for _ in range(n))


def test_planted_passages_are_removed(spark):
    rnd = random.Random(12)
    passages = [[sentence(rnd, 52 // n + 2) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6) for _ in range(5)]
    rows, planted = [], {}
    for i in range(120):
        own = [[sentence(rnd, rnd.randrange(1, 30)) for _ in range(rnd.randrange(1, 4))] for _ in range(2)]
        planted[i] = passages[i % len(passages)]
        rows.append((i, "\n".join([*own[0], *planted[i], *own[1]])))
    got = {r.doc_id: r.text for r in line_chunks.dedup(docs(spark, rows), passages=True).collect()}
    for i, text in rows:
        passage = "\n".join(planted[i])
        assert (passage in got[i]) == (i < len(passages))
        if i >= len(passages):
            assert not set(planted[i]) & set(got[i].split("\n"))
            assert got[i] == text.replace(passage + "\n", "")
    staged = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs(spark, rows), "").collect()}
    assert staged == got


def test_passages_equal_brute_force(spark):
    rnd = random.Random(5)
    pool = [sentence(rnd, rnd.choice((0, 1, 8, 20, 60))) for _ in range(12)]
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 12)))) for i in range(60)]
    rows += [(100, "same\n" * 200), (101, "\n".join(["a b c d e", "f g h"] * 40)), (102, sentence(rnd, 70)), (103, ""), (104, "\n\n")]
    rows.append((105, rows[-3][1]))
    got = {r.doc_id: r.text for r in line_chunks.dedup(docs(spark, rows), passages=True).collect()}
    assert got == brute_passages(rows)
    assert got[105] == "" and got[100].count("same") >= 51
