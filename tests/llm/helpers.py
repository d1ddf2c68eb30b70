"""Rows that every operator has to take: nulls, empty and long texts, ties, repeated rows, clashing column names."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def clashing(df):
    """The same rows with more columns, named like what operators use inside."""
    more = ("id", "body", "key", "size", "tokens", "rid", "conv", "place", "spans", "v", "leaf", "chance", "row", "words", "hash", "gid", "n", "_id", "_body", "_places", "_kept", "_lines", "rank", "share", "bucket", "blob", "found", "position", "copy")
    return df.select("*", *[F.lit("x").alias(c) for c in more if c not in df.columns])


def edge_rows():
    long = " ".join(f"word{i % 977} and" for i in range(30_000))
    return [(1, "Plain text of a few words here."), (2, None), (3, ""), (4, "   \n\t "), (5, long), (6, "Plain text of a few words here."), (7, "é漢字 \u0000 emoji \U0001F600 end"),
            (None, "A row without an id."), (8, "repeated row"), (8, "repeated row"), (9, "a"), (10, long)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
