"""The stages against plain versions of themselves, and the registered queries against their SQL."""

import re

import duckdb
import public_tokenizers
import pyarrow as pa
import sentencepiece

import __spark_entry__
import corpus_pipeline
from quarry.llm import curriculum, line_chunks
from tests.llm.helpers import SCHEMA, clashing, docs, edge_rows
from tests.llm.test_ngram_join import brute
from tests.llm.test_line_passages import brute_passages

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    read = {r.doc_id: r for r in table.collect()}
    out, seen = table, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out, SF).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(out.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == table.columns and out.dtypes == table.dtypes
    language, lines, near, mixed, tokens = seen
    assert all(read[r.doc_id] == r for r in language)
    assert len(language) >= 0.99 * len(read)
    was = {r.doc_id: r.text for r in language}
    want = {i: t for i, t in brute_passages(sorted(was.items())).items() if t.split() or t == was[i]}
    assert {r.doc_id: r.text for r in lines} == want and all(r.n_chars == len(r.text) for r in lines)
    keep = {d for d, _, c in brute([(r.doc_id, r.text) for r in lines], 5, 80) if d == c}
    assert {r.doc_id for r in near} == keep
    planned = curriculum.plan(spark.createDataFrame(near, SCHEMA)).collect()
    copies = sorted((p.doc_id, p.size) for p in planned for c in p.copies if 2 * c.words >= p.size)  # whole texts only
    assert sorted((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in mixed) == copies
    assert {r.doc_id: r.text for r in mixed} == {r.doc_id: r.text for r in near if r.doc_id in dict(copies)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r.doc_id, r.decoded) for r in tokens) == sorted((r.doc_id, r.text) for r in mixed)
    assert all(r.ids == library.encode(r.decoded, add_bos=True, add_eos=True) for r in tokens)


def test_stages_take_odd_rows(spark, tmp_path):
    many = "\n".join(f"row {i} of many" for i in range(30))
    out = clashing(docs(spark, edge_rows() + [(40, many), (41, many), (42, "row of many " * 20, None, None)]))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out, SF).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
    assert {40, 42} <= {r.doc_id for r in out.collect()}


def test_stages_take_no_rows(spark):
    empty = docs(spark, [(1, "a")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    names = [n for n in queries if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in queries
    for n in names:
        if n in sql:
            got = queries[n](spark, SF).toPandas()
            want = con.execute(sql[n]).df()[list(got.columns)]
            assert sorted(map(repr, got.astype(object).values.tolist())) == sorted(map(repr, want.astype(object).values.tolist())), n


def test_chunk_boundaries_cover_all_lines():
    text = "\n".join(map(str, range(100)))
    assert "\n".join("\n".join(c) for c in line_chunks.chunks(text)) == text


def test_arrow_batches_of_stages_are_bounded_in_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "concat(id, repeat(' word', 800)) AS text")  # 16 MB in one task
    try:
        corpus_pipeline.tokenise(spark, docs, "")
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"size": [b.nbytes]}) for b in batches), "size long")
        assert max(r.size for r in sizes.collect()) <= corpus_pipeline.BATCH_BYTES + 10_000
    finally:
        spark.conf.unset(key)
