"""Vector jobs, budget, JSONL, streaming, the driver contract."""

import math
import os

import numpy as np
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quarry.operators import budget, quality, vectors
from quarry.session import scratch_path
from quarry.sources.tables import DOCUMENT_SCHEMA, corrupt_rows, read_jsonl, sound_rows, take_first, write_jsonl, write_kept_removed
from quarry.streaming.filter_stream import stream_filter
from tests.conftest import SF_CHECK, SF_SMALL, docs_df


def emb(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)],
                                 "vec_id long, embedding array<float>, label int")


def test_absmax_matches_numpy(spark):
    rng = np.random.default_rng(42)
    vals = (rng.standard_normal((6, 10)) * 10).astype(np.float32)
    out = vectors.absmax_quantize(emb(spark, vals.tolist()), "label").orderBy("vec_id").collect()
    scale = float(np.abs(vals.astype(np.float64)).max()) / 127
    for r, v in zip(out, vals):
        want = np.clip(np.rint(v.astype(np.float64) / scale), -127, 127).astype(int).tolist()
        assert r.q == want
        assert math.isclose(r.scale, scale)


def test_zero_and_constant_vectors(spark):
    out = vectors.absmax_quantize(emb(spark, [[0.0, 0.0]]), "row").first()
    assert out.q == [0, 0]
    z = vectors.zeropoint_quantize(emb(spark, [[2.0, 2.0, 2.0]]), "row").first()
    assert z.scale == 1 / 255 and z.zero_point == -510 and z.q == [0, 0, 0]


def test_half_to_even(spark):
    out = vectors.absmax_quantize(emb(spark, [[127.0, 2.5, 3.5, -2.5]]), "row").first()
    assert out.q == [127, 2, 4, -2]


def test_budget_constants(spark):
    n, d = budget.optimal_sizes(1e21)
    assert round(n / 1e6, 1) == 2498.2 and round(d / 1e9, 1) == 66.4
    assert round(budget.predicted_loss(n, d), 4) == 2.3324


def test_jsonl_round_trip_keeps_nulls_and_hangul(spark):
    df = docs_df(spark, ["한국어 텍스트", None, "plain"])
    path = scratch_path(spark, "test-jsonl")
    write_jsonl(df, path)
    lines = [ln for f in os.listdir(path.replace("file:", "")) if f.endswith(".json")
             for ln in open(os.path.join(path.replace("file:", ""), f), encoding="utf-8")]
    assert any("한국어" in ln for ln in lines) and any('"text":null' in ln for ln in lines)
    back = {r.doc_id: r.text for r in read_jsonl(spark, path).collect()}
    assert back == {0: "한국어 텍스트", 1: "", 2: "plain"}


def test_stream_equals_batch(spark):
    def annotate(df):
        return quality.gopher_annotate(df).select("doc_id", "reason")
    streamed = stream_filter(spark, SF_SMALL, DOCUMENT_SCHEMA, annotate, glob="documents.parquet")
    batch = annotate(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].n_blocks == rows[0].n_packed


def test_every_query_has_a_check():
    from quarry.catalog import QUERIES
    rows_only = {"quality_classifier", "quality_holdout"}
    assert set(QUERIES) - set(entry.oracle_sql()) <= rows_only


def test_results_independent_of_shuffle_partitions(spark):
    q = entry.queries()["mix_sources"]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(q(spark, SF_SMALL).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = sorted(q(spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_stream_resumes_from_checkpoint(spark):
    from quarry.streaming.filter_stream import run_available, stream_files
    src = scratch_path(spark, "stream-src")
    out = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-state")
    docs = docs_df(spark, [GOOD_TEXT, "tiny", GOOD_TEXT + " again"])

    def annotate(df):
        return quality.gopher_annotate(df).select("doc_id", "reason")
    write_jsonl(docs.filter("doc_id < 2"), f"{src}/part-a")
    run_available(stream_files(spark, f"{src}/*", DOCUMENT_SCHEMA, "json"), annotate, out, ckpt)
    assert spark.read.parquet(out).count() == 2
    write_jsonl(docs.filter("doc_id = 2"), f"{src}/part-b")
    run_available(stream_files(spark, f"{src}/*", DOCUMENT_SCHEMA, "json"), annotate, out, ckpt)
    got = sorted(r.doc_id for r in spark.read.parquet(out).collect())
    assert got == [0, 1, 2]  # each file processed once across restarts


def test_null_labels_are_a_scope(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [4.0, -8.0], None)], "vec_id long, embedding array<float>, label int")
    assert {r.vec_id: r.scale for r in vectors.absmax_quantize(df, "label").collect()} == {0: 2 / 127, 1: 8 / 127}
    assert vectors.zeropoint_quantize(df, "label").count() == 2


def test_lookup_keeps_unknown_ids(spark):
    ids = spark.createDataFrame([(0, [1, 7, 1])], "doc_id long, ids array<int>")
    table = spark.createDataFrame([(1, 0.5), (900, 1.0)], "vec_id long, norm double")
    for rows in (None, 256):
        got = sorted((r.pos, r.vec_id, r.norm) for r in vectors.embedding_lookup(ids, table, vocab_rows=rows).collect())
        assert got == [(0, 1, 0.5), (1, 7, None), (2, 1, 0.5)]


def test_take_first_binds(spark):
    df = spark.createDataFrame([(i % 40, f"t{i}") for i in range(60)] + [(None, "n")], "doc_id long, text string")
    assert [r.doc_id for r in take_first(df, 4).orderBy("doc_id").collect()] == [None, 0, 0, 1]
    assert take_first(df, 1).collect()[0].doc_id is None and take_first(df, 1000).count() == 61
    unique = docs_df(spark, [f"t{i}" for i in range(30)])
    plan = take_first(unique, 10)._jdf.queryExecution().sparkPlan().toString()
    assert "TakeOrdered" not in plan and take_first(unique, 10).count() == 10


def test_corrupt_lines_are_no_documents(spark):
    path = scratch_path(spark, "test-corrupt")
    write_jsonl(docs_df(spark, ["one", None]), path)
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.mode("append").text(path)
    read = read_jsonl(spark, path)
    assert sorted(r.text for r in sound_rows(read).collect()) == ["", "one"]
    assert [r[0] for r in corrupt_rows(read.cache()).collect()] == ["{not json"]


def test_kept_and_removed_sinks(spark):
    path = scratch_path(spark, "test-sinks")
    write_kept_removed(quality.gopher_annotate(docs_df(spark, [GOOD_TEXT, "tiny", GOOD_TEXT + " again"])), path)
    assert sorted(r.doc_id for r in spark.read.json(f"{path}/kept=true").collect()) == [0, 2]
    assert [(r.doc_id, r.reason) for r in spark.read.json(f"{path}/kept=false").collect()] == [(1, "short_doc")]


def test_no_ambient_checkpoint_folder():
    """The flagship, clusters and BPE training set their checkpoint folder themselves."""
    import subprocess
    import sys
    import tempfile
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("from quarry.session import build_session\nimport __spark_entry__ as e\ns = build_session('local[2]', shuffle_partitions=2)\n"
            "e.entry(s).collect()\nfrom quarry.operators import dedup, tokens\nd = s.createDataFrame([(1, 'a b c d e f'), (2, 'a b c d e f')], 'doc_id long, text string')\n"
            "assert dedup.duplicate_clusters(d).count() == 2 and len(tokens.bpe_train(d, 2)) == 2\nprint('DONE')")
    env = {**os.environ, "SPARK_CONF_DIR": tempfile.mkdtemp(), "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, timeout=600)
    assert "DONE" in out.stdout, out.stderr[-2000:]


GOOD_TEXT = " ".join(["the cat and the dog walked with care to the old mill"] * 5)


def test_quantisation_of_odd_elements(spark):
    """NULL and NaN elements become NULL, infinities the nearest bound; none of them moves the scale."""
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -2.0, nan], "a"), (2, [None, inf, -inf], "a"), (3, [nan, None], "b"), (4, None, "a"), (5, [], "c"), (6, [0.0, 0.0], "d")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string")
    a = {r.vec_id: (r.scale, r.q) for r in vectors.absmax_quantize(df).collect()}
    assert a[1] == (2 / 127, [64, -127, None]) and a[2][1] == [None, 127, -127] and a[3] == (None, [None, None])
    assert a[4] == (2 / 127, None) and a[5] == (None, []) and a[6] == (0.0, [0, 0])
    z = {r.vec_id: (r.scale, r.zero_point, r.q) for r in vectors.zeropoint_quantize(df).collect()}
    assert z[1] == (3 / 255, 170.0, [255, 0, None]) and z[2][2] == [None, 255, 0] and z[6][2] == [0, 0]
    both = {r.vec_id: {m.method: (m.scale, m.q) for m in r.quantized} for r in vectors.quantize_both(df).collect()}
    assert all(both[i] == {"absmax": a[i], "zeropoint": (z[i][0], z[i][2])} for i in both)
    flat = vectors.quantize_both(df).select("vec_id", "embedding", F.inline("quantized"))
    errors = {(r.vec_id, r.method): (r.se, r.n) for r in flat.select("vec_id", "method", vectors.squared_error_sum(F.col("embedding"), F.col("values")).alias("se"), vectors.error_count(F.col("embedding"), F.col("values")).alias("n")).collect()}
    assert errors[1, "absmax"][1] == 2 and errors[1, "absmax"][0] < 1e-4 and errors[2, "absmax"] == (0.0, 0) and errors[6, "zeropoint"] == (0.0, 2)


def test_lookup_with_hot_ids(spark):
    """Ids that hold most positions are joined by broadcast, and the rest spreads over all tasks."""
    import random
    rng = random.Random(4)
    rows = [(i, [7 if rng.random() < 0.3 else 8 if rng.random() < 0.1 else rng.randrange(4000) for _ in range(200)]) for i in range(200)] + [(900, None), (901, [])]
    ids = spark.createDataFrame(rows, "doc_id long, ids array<int>").repartition(4)
    table = spark.createDataFrame([(i, [float(i)]) for i in range(3900)], "vec_id long, embedding array<float>")
    got = sorted((r.doc_id, r.pos, r.vec_id, tuple(r.embedding or ())) for r in vectors.embedding_lookup_skewed(ids, table, share=0.02).collect())
    assert got == sorted((d, p, v, (float(v),) if v < 3900 else ()) for d, own in rows for p, v in enumerate(own or ()))
    exploded = ids.select(F.explode("ids").alias("vec_id"))
    hot = vectors.hot_ids(exploded.withColumn("vec_id", F.col("vec_id").cast("long")), "vec_id", 0.02)
    assert hot == [7, 8]
    parts = exploded.filter(~F.col("vec_id").isin(hot)).repartition(8, "vec_id").groupBy(F.spark_partition_id()).count().collect()
    sizes = sorted(r["count"] for r in parts)
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert vectors.embedding_lookup_skewed(ids.limit(0), table).count() == 0
