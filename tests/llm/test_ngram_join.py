import random

import pytest

from quarry.llm import ngram_join
from tests.llm.helpers import clashing, docs, edge_rows


def brute(rows, k, percent):
    """Components of all pairs compared word by word."""
    sets = []
    for _, text in rows:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted((doc, len(sets[i]), least[root(i)]) for i, (doc, _) in enumerate(rows))


def family(rnd, base, copies, edits):
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80), (1, 50)])
def test_equal_to_all_pairs(spark, k, percent):
    rnd = random.Random(k)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 40))) for _ in range(60)]
    for size in (12, 45, 130):
        texts += family(rnd, rnd.choices(vocabulary, k=size), 25, 4)
    passage = " ".join(rnd.choices(vocabulary, k=30))
    texts += [passage + " " + " ".join(f"own{i}x{j}" for j in range(rnd.randrange(12))) for i in range(30)]
    texts += texts[5:15] + ["", "  ", "a b", "A B", "a  b c"]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    got = sorted(tuple(r) for r in ngram_join.components(docs(spark, rows), k, percent).collect())
    assert got == brute(rows, k, percent)


def test_edges(spark):
    got = sorted((tuple(r) for r in ngram_join.components(clashing(docs(spark, edge_rows()))).collect()), key=repr)
    by_id = {r[0]: r for r in got}
    assert len(got) == len(edge_rows())
    assert by_id[2] == (2, 0, 2) and by_id[3] == (3, 0, 3) and by_id[4] == (4, 0, 4)
    assert by_id[6][2] == 1 and by_id[10][2] == 5
    assert [r for r in got if r[0] == 8] == [(8, 1, 8)] * 2
    assert by_id[None][2] is None
    assert ngram_join.components(docs(spark, [(1, "a")]).limit(0)).collect() == []


def test_null_id_joins_the_class_of_others(spark):
    rows = [(None, "one two three four five six"), (7, "one two three four five six")]
    got = {r.doc_id: r.component_id for r in ngram_join.components(docs(spark, rows)).collect()}
    assert got == {None: 7, 7: 7}


def test_keep_one_keeps_all_columns(spark):
    df = clashing(docs(spark, edge_rows()))
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, 4, 5, 7, None, 8, 8, 9], key=repr)
