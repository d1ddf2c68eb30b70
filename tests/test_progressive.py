"""Early stop: the same rows as a full scan, and files behind the cutoff unread."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.sources.progressive import file_bounds, first_matching
from quarry.sources.tables import take_first

SCHEMA = "doc_id long, text string"


def make(spark, path, groups):
    for i, rows in enumerate(groups):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def spoil(uri):
    """Overwrites the pages of a file; its footer stays."""
    path = uri.removeprefix("file://").removeprefix("file:")
    with open(path, "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * max(8, os.path.getsize(path) // 4))


def text(i):
    return f"document {i} on " + ("war" if i % 3 == 0 else "peace")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_files_behind_the_cutoff_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    whole = make(spark, path, [[(k, text(k)) for k in range(i * 50, i * 50 + 50)] for i in random.Random(1).sample(range(16), 16)])
    want = rows_of(take_first(whole.filter(F.col("text").contains("war")), 30))
    bounds = file_bounds(whole, "doc_id")
    assert [(b.low, b.rows) for b in bounds] == [(50 * i, 50) for i in range(16)]
    got, progress = first_matching(spark, path, F.col("text").contains("war"), 30)
    assert rows_of(got) == want and len(progress.files) < 8 and sorted(progress.files + progress.unread) == sorted(b.path for b in bounds)
    for late in progress.unread:
        spoil(late)
    with pytest.raises(Exception):
        whole.filter(F.col("text").contains("war")).count()
    got, _ = first_matching(spark, path, F.col("text").contains("war"), 30)
    assert rows_of(got) == want


@pytest.mark.parametrize("n", [1, 7, 40, 1000])
def test_any_layout_gives_the_full_scan(spark, tmp_path, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, *range(60)]) if rng.random() < 0.4 else 60 + i, text(rng.randrange(9))) for i in range(240)]
    for name, groups in (("shuffled", [rows[i::6] for i in range(6)]), ("sorted", [sorted(rows, key=lambda r: (r[0] is not None, r[0]))[i:i + 40] for i in range(0, 240, 40)])):
        path = str(tmp_path / name)
        whole = make(spark, path, groups)
        condition = F.col("text").contains("war")
        keys = sorted((r.doc_id for r in whole.filter(condition).collect()), key=lambda k: (k is not None, k))[:n]
        got, _ = first_matching(spark, path, condition, n)
        assert sorted((r.doc_id for r in got.collect()), key=lambda k: (k is not None, k)) == keys


def test_string_keys_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "s")
    for i in range(5):
        spark.createDataFrame([(f"k{i}é{j}", text(j)) for j in range(20)], "name string, text string").coalesce(1).write.mode("append").parquet(path)
    got, progress = first_matching(spark, path, F.lit(True), 5, "name")
    assert sorted(r.name for r in got.collect()) == sorted(f"k0é{j}" for j in range(20))[:5] and len(progress.files) == 1
    empty = str(tmp_path / "e")
    spark.createDataFrame([], SCHEMA).write.parquet(empty)
    assert first_matching(spark, empty, F.lit(True), 5)[0].count() == 0
    with pytest.raises(ValueError):
        first_matching(spark, str(tmp_path / "d"), F.lit(True), 5) if spark.createDataFrame([(1.5,)], "doc_id double").write.parquet(str(tmp_path / "d")) is None else None
