import pytest
from pyspark.sql import functions as F

from quarry.llm import curriculum
from tests.llm.helpers import clashing, docs, edge_rows


def water_level(sizes, weights, budget=1.5):
    """Targets by handing out the excess again and again."""
    open_, target, left = dict(zip(sizes, weights)), {}, budget * sum(sizes.values())
    while open_:
        level = left / sum(open_.values())
        full = [s for s, w in open_.items() if level * w >= 2 * sizes[s]]
        if not full:
            return target | {s: level * w for s, w in open_.items()}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            del open_[s]
    return target


def test_targets_quota_and_positions(spark, monkeypatch):
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 7)
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 50)), "en", ["a", "Z", "é", "hot", None][4 if i % 11 == 0 else 3 if i % 3 == 0 else i % 3]) for i in range(300)]
    got = curriculum.plan(docs(spark, rows)).collect()
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = water_level({s: sizes[s] for s in order}, [(5, 2, 1)[i % 3] for i in range(len(order))])
    taken = {}
    for r in got:
        source = rows[r.doc_id][3]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(c.words for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
        taken[source] = taken.get(source, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - want[s]) <= 0.5
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_schedule_is_met_over_time(spark):
    """At any time, each source has had the integral of its schedule, but for the documents around that time."""
    rows = [(i, " ".join(["w"] * 10), "en", "abc"[i % 3]) for i in range(900)]
    planned = curriculum.plan(docs(spark, rows)).select("src", "target", F.explode("copies").alias("c")).select("src", "target", "c.*").collect()
    slope = dict(zip(("aa", "ab", "ac"), curriculum.SLOPES))
    for t in (0.1, 0.5, 0.9):
        for s in slope:
            target = next(r.target for r in planned if r.src == s)
            had = sum(r.words for r in planned if r.src == s and r.position <= t)
            assert abs(had - target * (t + slope[s] * (t - t * t))) <= 20


def test_curriculum_is_range_sorted(spark):
    rows = [(i, "w " * (i % 9), "en", "abcd"[i % 4]) for i in range(200)]
    got = [r.position for r in curriculum.curriculum(curriculum.plan(docs(spark, rows))).collect()]
    assert got == sorted(got) and got


def test_numbered_mix_by_document(spark):
    """Places number the range-sorted mix; rows with one id stay rows."""
    rows = [(i % 150, "w " * (i % 9), "en", "abcd"[i % 4]) for i in range(200)] + [(None, "w w w", "en", "a"), (None, "w w w", "en", "a"), (None, None, "en", None)]
    planned = curriculum.plan(docs(spark, rows))
    mix = curriculum.curriculum(planned).collect()
    numbered = curriculum.numbered(planned).orderBy("place").collect()
    assert [r.place for r in numbered] == list(range(1, len(mix) + 1))
    assert [(r.position, r.doc_id, r.copy) for r in numbered] == [(r.position, r.doc_id, r.copy) for r in mix]
    got = curriculum.per_document(planned).collect()
    want = planned.collect()
    key = lambda r, n: (str(r.doc_id), r.size, r.source_size, r.taken, n)
    assert sorted(key(r, r.n_copies) for r in got) == sorted(key(r, len(r.copies)) for r in want)
    assert all((r.first_place == 0) == (r.taken == 0) == (r.last_place == 0) == (r.first_position is None) for r in got)
    assert sum(r.n_copies for r in got) == len(mix)
    assert {(r.first_position, r.first_place) for r in got if r.taken} <= {(r.position, r.place) for r in numbered}
    assert curriculum.per_document(curriculum.plan(docs(spark, rows).limit(0))).collect() == []


def test_first_words(spark):
    row = spark.createDataFrame([(" one\n two  three ", 2)], "t string, n long").select(curriculum.first_words(F.col("t"), F.col("n")).alias("x")).first()
    assert row.x == " one\n two"


def test_edges(spark):
    df = clashing(docs(spark, edge_rows()))
    got = curriculum.plan(df, keep=tuple(df.columns)).collect()
    assert len(got) == len(edge_rows())
    assert all(r.taken == 0 and r.copies == [] for r in got if r.size == 0)
    assert {r.doc_id for r in got if r.size == 0} == {2, 3, 4}
    assert all(r.row.key == "x" for r in got)
    again = curriculum.plan(df, keep=tuple(df.columns)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    assert curriculum.plan(df.limit(0)).collect() == []
    empty = curriculum.plan(docs(spark, [(1, ""), (2, None)])).collect()
    assert [(r.target, r.taken) for r in empty] == [(0.0, 0), (0.0, 0)]
