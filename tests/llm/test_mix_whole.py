"""The mix emits whole texts, as near to each source's target as they come, and says how near."""

import corpus_pipeline
from pyspark.sql import functions as F

from quarry.llm import curriculum
from tests.llm.helpers import docs


def test_mix_emits_whole_texts(spark):
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(1 + i * 37 % 50 + (5000 if i % 40 == 0 else 0))), "en", "abcd"[i % 4]) for i in range(200)]
    table = docs(spark, rows)
    planned = curriculum.plan(table).collect()
    cut = [(r.doc_id, r.size, c.words) for r in planned for c in r.copies if c.words < r.size]
    assert cut  # there are copies at the end of a quota
    text = {r[0]: r[1] for r in rows}
    mixed = corpus_pipeline.mix(spark, table, "").collect()
    assert all(r.text == text[r.doc_id] and r.n_chars == len(r.text) for r in mixed)
    want = sorted(r.doc_id for r in planned for c in r.copies if c.words * 2 >= r.size)
    assert sorted(r.doc_id for r in mixed) == want
    got = {}
    for r in mixed:
        got["a" + r.source] = got.get("a" + r.source, 0) + len(r.text.split())
    said = {r.src: r for r in curriculum.differences(curriculum.plan(table)).collect()}
    for r in planned:
        assert said[r.src].words == got.get(r.src, 0)
        assert abs(said[r.src].difference - (got.get(r.src, 0) - r.target)) < 1e-6
    source = {r.doc_id: r.src for r in planned}
    for doc, size, words in cut:
        # Nearer than, or as near as, the other choice (targets are rounded to whole words).
        other = abs(words) if words * 2 >= size else abs(size - words)
        assert abs(said[source[doc]].difference) <= other + 0.5


def test_differences_are_written(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    table = docs(spark, [(i, "w " * (1 + i % 7), "en", "ab"[i % 2]) for i in range(40)])
    corpus_pipeline.mix(spark, table, "").count()
    written = spark.read.parquet(f"{tmp_path}/pipeline-mix-differences")
    assert written.columns == ["src", "target", "words", "difference"] and written.count() == 2
    assert written.filter(F.abs("difference") > 7).count() == 0
