"""Restarts in the middle of a batch give what one batch run gives, in both sinks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import prompts, quality
from quarry.streaming import sinks
from quarry.streaming.filter_stream import stream_files, stream_filter

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
GOOD = "the people of the town have to be with that and the river " * 6


def texts(i):
    return GOOD + str(i) if i % 3 else f"short {i} war"


def feed(spark, path, first, n):
    spark.createDataFrame([(i, texts(i)) for i in range(first, first + n)] + [(None, None)], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def annotate(df):
    return quality.gopher_annotate(df).select("doc_id", "text", "reason", "kept")


OUT = T.StructType([*SCHEMA.fields, T.StructField("reason", T.StringType())])


def rows_of(df):
    return sorted((tuple(r[c] for c in ("doc_id", "text", "reason", "kept")) for r in df.collect()), key=repr)


@pytest.mark.parametrize("fail_at", ["rows", "ledger"])
def test_restart_in_mid_batch(spark, tmp_path, monkeypatch, fail_at):
    source, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    for k in range(3):
        feed(spark, source, 100 * k, 20)
    stream = lambda: stream_files(spark, source, SCHEMA, max_files_per_trigger=1)
    write = sinks.write_batch
    failed = []

    def crash(rows, batch, path, flag):
        if batch == 1 and not failed:
            failed.append(batch)
            if fail_at == "ledger":  # both sinks written, the ledger not
                monkeypatch.setattr(sinks, "_has_files", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
                write(rows, batch, path, flag)
            rows.limit(5).write.partitionBy(flag).json(f"{path}/rows/batch={batch}")  # a part of one
            raise RuntimeError("killed")
        write(rows, batch, path, flag)

    monkeypatch.setattr(sinks, "write_batch", crash)
    with pytest.raises(Exception, match="killed"):
        sinks.run_two_sinks(stream(), annotate, out, ckpt)
    monkeypatch.undo()
    assert failed and [r.batch for r in sinks.ledger(spark, out).collect()] == [0]
    feed(spark, source, 900, 7)
    sinks.run_two_sinks(stream(), annotate, out, ckpt)
    sinks.run_two_sinks(stream(), annotate, out, ckpt)  # nothing new
    want = rows_of(annotate(spark.read.schema(SCHEMA).parquet(source)))
    assert rows_of(sinks.read_sinks(spark, out, OUT)) == want
    kept, removed = (sinks.read_sinks(spark, out, OUT, k) for k in (True, False))
    assert rows_of(kept) == [r for r in want if r[3]] and rows_of(removed) == [r for r in want if not r[3]]
    entries = sinks.ledger(spark, out).collect()
    assert sorted(r.batch for r in entries) == [0, 1, 2, 3] and sum(r.n_kept for r in entries) == kept.count() and sum(r.n_removed for r in entries) == removed.count()


def test_nothing_arrived(spark, tmp_path):
    assert sinks.read_sinks(spark, str(tmp_path / "none"), OUT).collect() == []


def test_topic_filter_and_templates_stream_as_they_run(spark, tmp_path):
    source = str(tmp_path / "in")
    feed(spark, source, 0, 12)
    batch = spark.read.schema(SCHEMA).parquet(source)
    for step in (lambda df: quality.topic_extract(df, ["war", "peace"]), lambda df: quality.topic_extract(df, ["war", *(f"k{i}" for i in range(60))]),
                 lambda df: df.select("doc_id", prompts.instruction_text(F.col("text"), F.lit(None).cast("string"), F.lit("yes")).alias("text")),
                 lambda df: df.select("doc_id", prompts.gsm8k_prompt(F.col("text")).alias("text"))):
        got = stream_filter(spark, source, SCHEMA, step)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, step(batch).collect()))


@pytest.mark.parametrize("files", [1, 3])
def test_stream_queries_read_tables_of_one_file_or_several(spark, tmp_path, files):
    from quarry import catalog
    from quarry.sources.tables import DOCUMENT_SCHEMA
    base = str(tmp_path)
    docs = spark.createDataFrame([(i, texts(i) + (" license" if i % 2 else ""), "en", "s", 1) for i in range(30)], DOCUMENT_SCHEMA)
    for name, df in (("documents", docs), ("benchmark", docs.select(F.col("doc_id").alias("item_id"), "text"))):
        out = f"{base}/{name}.parquet"
        if files > 1:
            df.repartition(files).write.parquet(out)
        else:
            df.coalesce(1).write.parquet(f"{base}/{name}-parts")
            next((tmp_path / f"{name}-parts").glob("part-*")).rename(out)
    flagged = rows_of(annotate(docs))
    for query in (catalog.q_stream_filter, catalog.q_stream_sinks):
        assert sorted(tuple(r) for r in query(spark, base).select("doc_id", "kept").collect()) == [(i, kept) for i, _, _, kept in sorted(flagged)]
    assert sorted(r.doc_id for r in catalog.q_stream_topic(spark, base).collect()) == list(range(1, 30, 2))
    assert catalog.q_stream_prompts(spark, base).count() == prompts.format_gsm8k(prompts.worked_answer_rows(docs.select(F.col("doc_id").alias("item_id"), "text"))).count()
