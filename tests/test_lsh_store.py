"""Increments against one run over everything."""

import random

import pytest

from quarry.operators import dedup
from quarry.operators.lsh_store import LshStore
from tests.conftest import docs_df


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    texts = [[word() for _ in range(rng.randrange(3, 40))] for _ in range(n // 3)]
    while len(texts) < n:
        copy = list(rng.choice(texts))
        if rng.random() < 0.7 and copy:
            copy[rng.randrange(len(copy))] = word()
        texts.append(copy)
    rng.shuffle(texts)
    return [" ".join(t) for t in texts] + ["one hot text of more than five words"] * 40


def one_run(df):
    return sorted((r.doc_id, r.cluster_id) for r in dedup.duplicate_clusters(df).collect())


@pytest.mark.parametrize("seed, n", [(1, 2), (2, 5)])
def test_increments_equal_one_run(spark, tmp_path, seed, n):
    df = docs_df(spark, corpus(seed)).repartition(3)
    want = one_run(df)
    store = LshStore(spark, str(tmp_path / "store"), table_buckets=8)
    for k in range(n):  # ids of all increments interleave: later ones hold smaller ids than stored ones
        store.add(df.filter(df.doc_id % n == n - 1 - k), f"part{k}")
    assert sorted((r.doc_id, r.cluster_id) for r in store.clusters().collect()) == want and len(want) > 40
    store.add(df, "part0")  # a name in the store is not added again
    assert store.runs() == [f"part{k}" for k in range(n)]


def test_crash_before_the_ledger(spark, tmp_path, monkeypatch):
    df = docs_df(spark, corpus(3, 60))
    store = LshStore(spark, str(tmp_path / "store"), table_buckets=4)
    store.add(df.filter("doc_id % 2 = 0"), "a")
    made = spark.createDataFrame
    runs = store.runs()
    monkeypatch.setattr(store, "runs", lambda: runs)
    monkeypatch.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")) if a and a[0] and a[0][0][0] == "b" else made(*a, **k))
    with pytest.raises(RuntimeError):
        store.add(df.filter("doc_id % 2 = 1"), "b")
    monkeypatch.undo()
    again = LshStore(spark, str(tmp_path / "store"), table_buckets=4)
    assert again.runs() == ["a"]
    again.add(df.filter("doc_id % 2 = 1"), "b")
    assert sorted((r.doc_id, r.cluster_id) for r in again.clusters().collect()) == one_run(df)


def test_stored_documents_are_not_shuffled(spark, tmp_path):
    store = LshStore(spark, str(tmp_path / "store"), table_buckets=8)
    df = docs_df(spark, corpus(4, 60))
    store.add(df.filter("doc_id % 2 = 0"), "a")
    keys = dedup.band_keys(dedup.minhash_signatures(df.filter("doc_id % 2 = 1")))
    plan = store.cross_edges(keys)._jdf.queryExecution().executedPlan().toString()
    new, old = plan[plan.index("SortMergeJoin"):].split("\n               +- ", 1)
    assert "Exchange hashpartitioning(band" in new and "Exchange" not in old and "Bucketed: true" in old


def test_nothing_to_add(spark, tmp_path):
    store = LshStore(spark, str(tmp_path / "store"), table_buckets=2)
    assert store.clusters().collect() == []
    store.add(docs_df(spark, ["a b"]).limit(0), "empty")
    assert store.clusters().collect() == [] and store.runs() == ["empty"]
