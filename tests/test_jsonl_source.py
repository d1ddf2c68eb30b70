"""The data source: read equals written, files are bounded, a failed write leaves nothing."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.sources import jsonl_source
from quarry.sources.tables import DOCUMENT_SCHEMA, read_jsonl, sound_rows


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def table(spark, n=300):
    rows = [(i, None if i % 7 == 0 else f"text {i} é漢\n\"quoted\"   " + "x" * (i % 50), "en" if i % 2 else None, f"src{i % 3}", i) for i in range(n)]
    return spark.createDataFrame(rows + rows[:2] + [(None, "", None, None, None)], DOCUMENT_SCHEMA).repartition(4)


@pytest.mark.parametrize("split", [700, 1 << 20])
def test_read_equals_written(spark, tmp_path, split):
    jsonl_source.register(spark)
    path = str(tmp_path / "out")
    df = table(spark)
    df.write.format(jsonl_source.NAME).option("maxFileBytes", 2000).mode("append").save(path)
    files = [f for f in os.scandir(path)]
    assert len(files) > 8 and all(f.name.startswith("part-") and f.stat().st_size <= 2000 for f in files)
    read = spark.read.format(jsonl_source.NAME).schema(DOCUMENT_SCHEMA).option("splitBytes", split).load(path)
    assert rows_of(read) == rows_of(df)
    built_in = sound_rows(read_jsonl(spark, path)).select(*df.columns)  # a missing text reads as empty there
    assert rows_of(built_in) == rows_of(df.withColumn("text", F.coalesce("text", F.lit(""))))
    df.limit(3).write.format(jsonl_source.NAME).mode("append").save("file://" + path)
    assert spark.read.format(jsonl_source.NAME).schema(DOCUMENT_SCHEMA).load(path).count() == df.count() + 3
    df.limit(5).write.format(jsonl_source.NAME).mode("overwrite").save(path)
    assert spark.read.format(jsonl_source.NAME).schema(DOCUMENT_SCHEMA).load(path).count() == 5


def test_a_killed_task_leaves_no_file(spark, tmp_path):
    jsonl_source.register(spark)
    path = str(tmp_path / "out")
    table(spark, 20).write.format(jsonl_source.NAME).mode("append").save(path)
    before = sorted(os.listdir(path))
    broken = table(spark).withColumn("doc_id", F.when(F.col("doc_id") == 250, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("doc_id")))
    with pytest.raises(Exception, match="killed"):
        broken.write.format(jsonl_source.NAME).mode("append").save(path)
    assert sorted(os.listdir(path)) == before


def test_other_stores_and_types(spark, tmp_path):
    with pytest.raises(ValueError):
        jsonl_source.local_path("hdfs://host/x")
    jsonl_source.register(spark)
    os.makedirs(tmp_path / "e")
    with pytest.raises(Exception, match="other types"):
        spark.read.format(jsonl_source.NAME).schema("a array<int>").load(str(tmp_path / "e")).collect()
    assert spark.read.format(jsonl_source.NAME).schema("a int").load(str(tmp_path / "e")).collect() == []
