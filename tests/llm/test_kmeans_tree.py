import numpy as np
import pytest

from quarry.llm import kmeans_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def true_top(rows, query, k):
    ids = np.array([i for i, _ in rows])
    x = np.stack([np.asarray(v, np.float32).astype(float) for _, v in rows])
    s = x @ x[ids == query][0]
    s[ids == query] = -np.inf
    by = np.lexsort((ids, -s))[:k]
    return [(int(ids[p]), float(s[p])) for p in by if s[p] > -np.inf]


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 40)
    monkeypatch.setattr(kmeans_tree, "PART_ROWS", 30)
    monkeypatch.setattr(kmeans_tree, "BLOCK_ROWS", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    rows = [(i, centres[i % 12] + rng.normal(size=16) * 0.6) for i in range(2000)]
    got = kmeans_tree.search(frame(spark, rows), "vec_id % 20 = 0", 20).collect()
    found, total = 0, 0
    for q in range(0, 2000, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        want = true_top(rows, q, 20)
        scores = {i: s for i, s in true_top(rows, q, 2000)}
        assert all(r.score == pytest.approx(scores[r.vec_id], abs=1e-9) for r in mine)
        found += len({r.vec_id for r in mine} & {i for i, _ in want})
        total += 20
    assert found / total >= 0.9


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0]), (20, [1, 0]), (3, [1, 0]), (3, [1, 0]), (4, [0.5, 0.5]), (5, None), (6, [0, 0]), (7, [1, None]), (8, [nan, 1]), (9, [inf, 1]), (10, []), (11, [1, 2, 3]), (None, [1, 0]), (40, [0, 0])]
    got = kmeans_tree.search(frame(spark, rows), "vec_id % 20 = 0", 20).collect()
    by = {q: [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 20, 40)}
    assert by[0] == [(1, 3, 1.0), (2, 20, 1.0), (3, 4, 0.5)]
    assert by[20] == [(1, 0, 1.0), (2, 3, 1.0), (3, 4, 0.5)]
    assert by[40] == []
    assert kmeans_tree.search(frame(spark, rows).limit(0), "vec_id % 20 = 0").collect() == []
    assert kmeans_tree.search(frame(spark, [(0, [1, 2])]), "vec_id % 20 = 0").collect() == []


def test_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "LEAF_ROWS", 20)
    monkeypatch.setattr(kmeans_tree, "PART_ROWS", 16)
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0, 0] if i % 3 == 0 else (lambda v: v / np.linalg.norm(v))(rng.normal(size=3))) for i in range(600)]
    got = [r for r in kmeans_tree.search(frame(spark, rows), "vec_id % 20 = 0", 20).collect() if r.query_id == 300]
    assert sorted(r.vec_id for r in got) == list(range(0, 60, 3))
