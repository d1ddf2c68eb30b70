"""Product codes over cover trees against plain Lloyd rounds."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from quarry.llm import cover_codes
from tests.llm.helpers import clashing

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """The same codes by comparing every part with every entry."""
    rows = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not rows:
        return {}, ""
    width = len(rows[0][1]) // parts
    points = np.array([v for _, v, _ in rows]).reshape(len(rows), parts, width)
    books = points[sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]].transpose(1, 0, 2).copy()
    nearest = lambda: np.stack([((points[:, p, None] - books[p][None]) ** 2).sum(2).argmin(1) for p in range(parts)], 1)
    for _ in range(rounds):
        codes = nearest()
        for p in range(parts):
            for e in range(books.shape[1]):
                own = points[codes[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(0) // len(own)
    codes = nearest()
    error = ((points - books[np.arange(parts)[None], codes]) ** 2).sum((1, 2))
    label = defaultdict(int)
    for (_, _, g), e in zip(rows, error):
        label[g] += int(e)
    sha = hashlib.sha256(",".join(str(x) for x in books.reshape(-1)).encode()).hexdigest()
    return sorted((repr(i), "".join(f"{c:02x}" for c in code), int(e), label[g]) for (i, _, g), code, e in zip(rows, codes, error)), sha


def found(df):
    done, books = cover_codes.compress(df)
    rows = sorted((repr(r["vec_id"]), "".join(f"{c:02x}" for c in r["code"]), r["error"], r["label_error"]) for r in done.collect())
    return rows, cover_codes.digest(books)


@pytest.mark.parametrize("dims, spread", [(32, 0.2), (64, 1.0), (320, 0.5)])
def test_equals_plain(spark, dims, spread):
    rng = np.random.default_rng(dims)
    centres = rng.normal(0, spread, (9, dims))
    v = centres[rng.integers(0, 9, 700)] + rng.normal(0, spread / 4, (700, dims))
    v[100:300] = v[5]  # one very common vector, among the first entries too
    rows = [(int(i), [float(x) for x in r], None if i % 7 == 0 else int(i % 3)) for i, r in enumerate(v)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_edges(spark):
    rng = np.random.default_rng(1)
    vector = lambda: [float(x) for x in rng.normal(0, 1, 16)]
    same = vector()
    rows = [(3, vector(), 1), (None, vector(), None), (None, same, None), (7, same, 2), (7, same, 2), (7, vector(), 1), (1, None, 1), (2, [None, *same[1:]], 1),
            (4, [float("nan"), *same[1:]], 1), (5, [float("inf"), *same[1:]], 1), (6, [-float("inf"), *same[1:]], 3), (-5, vector(), 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain(rows)
    assert found(df) == want and found(clashing(df)) == want
    odd = df.union(spark.createDataFrame([(9, [], 1), (10, [1.0] * 3, 1), (11, [1.0] * 32, None)], SCHEMA))
    assert found(odd) == want
    assert found(df.limit(0))[0] == []
    with pytest.raises(ValueError):
        found(df.union(spark.createDataFrame([(12, [1e30] * 16, 1)], SCHEMA)))


def test_tree_covers_and_decides_whole_nodes():
    rng = np.random.default_rng(3)
    points = np.floor(rng.normal(0, 60, (5000, 4))).astype(np.int64)
    order, nodes, radii = cover_codes.grow(points)
    assert sorted(order) == list(range(5000))
    for (start, end, centre, lo, hi), radius in zip(nodes.tolist(), radii):
        own = points[order[start:end]]
        assert np.isclose(np.sqrt(((own - points[centre]) ** 2).sum(1)).max(), radius) and centre in order[start:end]
        if hi > lo:
            assert nodes[lo, 0] == start and nodes[hi - 1, 1] == end and (nodes[lo + 1:hi, 0] == nodes[lo:hi - 1, 1]).all()
    entries = points[:64]
    code, sums, counts = cover_codes.assign(points, (order, nodes, radii), entries)
    want = ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (code == want).all() and counts.tolist() == np.bincount(want, minlength=64).tolist()
    assert all((sums[e] == points[want == e].sum(0)).all() for e in range(64))
