"""Whole-word search for keyword lists of any length in one pass.

A regular expression tries its alternatives one after the other at every
place of a text; an Aho-Corasick automaton reads each character once, however
many keywords there are. It is built once, broadcast (its size is checked),
and run in Arrow batches over texts that Spark has lower-cased; a match counts only if no
letter, digit or underscore stands on either side, as with the regular
expression of ``functions.text``.
"""

from __future__ import annotations

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import text_or_empty
from quarry.plans.joins import BROADCAST_MAX_BYTES


def automaton(keywords: list[str]):
    """The automaton; a match's value is the keyword's number and length."""
    import ahocorasick
    if not all(keywords):
        raise ValueError("an empty keyword")
    built = ahocorasick.Automaton()
    for i, k in enumerate(keywords):
        if k in built:
            raise ValueError(f"keyword twice: {k!r}")
        built.add_word(k, (i, len(k)))
    built.make_automaton()
    size = len(pickle.dumps(built))
    if size > 8 * BROADCAST_MAX_BYTES:
        raise ValueError(f"the automaton of {len(keywords)} keywords takes {size} bytes; split the list")
    return built


def matched_keywords(text: Column, keywords: list[str], any_only: bool = False) -> Column:
    """Numbers of the keywords that occur in the lower-cased text as whole
    words, ascending (``array<int>``); a missing text has none. With
    ``any_only`` the search of a text ends with the first one found."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(automaton(keywords) if keywords else None)

    def search(texts: pa.Array) -> pa.Array:
        import unicodedata
        from functools import lru_cache

        import pyarrow as pa
        if shared.value is None:
            return pa.array([[]] * len(texts), pa.list_(pa.int32()))
        built = shared.value  # unpickled once for each worker

        @lru_cache(1 << 16)
        def wordy(c):
            return c == "_" or unicodedata.category(c)[0] in "LN"

        out = []
        for value in texts:
            found, t = set(), value.as_py()
            for end, (i, size) in built.iter(t) if t else ():
                if i not in found and (end + 1 == len(t) or not wordy(t[end + 1])) and (end < size or not wordy(t[end - size])):
                    found.add(i)
                    if any_only:
                        break
            out.append(sorted(found))
        return pa.array(out, pa.list_(pa.int32()))

    return F.arrow_udf(search, returnType="array<int>")(F.lower(text_or_empty(text)))


def keyword_hits(df: DataFrame, keywords: list[str], text_col: str = "text") -> DataFrame:
    """``keyword, n_docs`` for every keyword, in one pass over the texts."""
    hits = df.select(F.explode(matched_keywords(F.col(text_col), keywords)).alias("_i")).groupBy("_i").agg(F.count(F.lit(1)).alias("n_docs"))
    listed = df.sparkSession.createDataFrame(list(enumerate(keywords)), "_i int, keyword string")
    return listed.join(hits, "_i", "left").select("keyword", F.coalesce("n_docs", F.lit(0)).cast("long").alias("n_docs"))


def keyword_list(df: DataFrame, column: str, most: int = 1_000_000) -> list[str]:
    """The distinct values of a column as a keyword list, in order; more than ``most`` are an error, as a list is broadcast."""
    got = df.select(F.col(column).alias("_k")).filter("_k IS NOT NULL AND _k != ''").distinct().limit(most + 1).toArrow().column("_k").to_pylist()
    if len(got) > most:
        raise ValueError(f"more than {most} keywords")
    return sorted(got)
