"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle 1994).

A language's profile lists its most frequent character n-grams (one to three
characters, words padded with ``_``) in order. A text's own n-grams are ranked
the same way, and its distance from a language is how far its n-grams stand
out of place in that language's list. Profiles come from one aggregation over
all labelled documents: words first (each distinct word is cut into n-grams
once), then n-grams. They are a few hundred rows a language; texts are scored in
Arrow batches, each on its own, so nothing but words and n-grams is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import text_or_empty
from quarry.plans.parallel import filter_fenced

#: n-grams of one to so many characters.
LONGEST = 3
#: n-grams of a profile, and of a text's own ranking.
PROFILE = 300
#: Languages that are compared: profiles are broadcast.
MOST_LANGUAGES = 1000


def letters_only(text: Column) -> Column:
    """Lower-cased text with one space for every run of other characters than letters."""
    return F.regexp_replace(F.lower(text_or_empty(text)), r"[^\p{L}]+", " ")


def word_grams(word: Column) -> Column:
    """All n-grams of a word padded with ``_`` (not the padding alone)."""
    padded = F.concat(F.lit("_"), word, F.lit("_"))
    size = F.length(word) + 2

    def of_length(text: Column, count: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), count), lambda i: F.substring(text, i, F.lit(n)))

    return F.concat(of_length(word, F.length(word), 1), *[of_length(padded, size - (n - 1), n) for n in range(2, LONGEST + 1)])


def language_profiles(df: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``lang, gram, rank, n`` (rank from 1; ties by the n-gram) from all rows with a language."""
    labelled = df.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.explode(F.split(letters_only(F.col(text_col)), " ")).alias("word"))
    words = labelled.filter("word != ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    grams = words.select("lang", "n", F.explode(word_grams(F.col("word"))).alias("gram")).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # Ranked among a language's distinct n-grams, after aggregation; the limit is applied before the shuffle too.
    ranked = grams.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    return ranked.filter(F.col("rank") <= size).select("lang", "gram", "rank", "n")


def collected(profiles: DataFrame, most_languages: int = MOST_LANGUAGES, size: int = PROFILE) -> dict[str, dict[str, int]]:
    """The profiles on the driver: at most ``most_languages`` times ``size`` rows, else an error."""
    rows = profiles.select("lang", "gram", "rank").limit(most_languages * size + 1).collect()
    if len(rows) > most_languages * size:
        raise ValueError(f"more than {most_languages} languages")
    out: dict[str, dict[str, int]] = {}
    for r in sorted(rows):
        out.setdefault(r["lang"], {})[r["gram"]] = r["rank"]
    return out


def _order(gram: str) -> int:
    """A number by which n-grams stand in the order of their UTF-8 bytes: 21 bits a character."""
    return sum((ord(g) + 1) << 21 * (LONGEST - 1 - i) for i, g in enumerate(gram))


def _postings(profiles: dict[str, dict[str, int]]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Languages by name; the profiles' distinct n-grams as numbers in order; where the entries of each start and end, and these: language, rank."""
    names = sorted(profiles)
    entries = np.array(sorted((_order(g), i, rank) for i, name in enumerate(names) for g, rank in profiles[name].items() if len(g) <= LONGEST), np.int64).reshape(-1, 3)
    grams, starts = np.unique(entries[:, 0], return_index=True)
    return names, grams, np.append(starts, len(entries)), entries[:, 1], entries[:, 2]


def _nearest(texts: Iterable[str], postings: tuple, size: int) -> Iterator[tuple[str | None, int | None, int]]:
    """``predicted, distance, n_grams`` of each text, n-grams as numbers in flat arrays."""
    names, grams, starts, languages, ranks = postings
    pad = ord("_") + 1
    for text in texts:
        words = text.split()
        if not words:
            yield None, None, 0
            continue
        one = np.frombuffer(f"_{'__'.join(words)}_".encode("utf-32-le"), np.uint32).astype(np.int64) + 1
        inner = one != pad
        apart = inner[:-1] | inner[1:]  # not the end of a word and the start of the next
        two = one[:-1] << 42 | one[1:] << 21
        three = two[:-1] | one[2:]
        own, n = np.unique(np.concatenate([one[inner] << 42, two[apart], three[apart[:-1] & apart[1:]]]), return_counts=True)
        if len(own) > size:  # all that are as frequent as the last one
            frequent = n >= np.partition(n, len(n) - size)[len(n) - size]
            own, n = own[frequent], n[frequent]
        own = own[np.argsort(-n, kind="stable")[:size]]
        if not names:
            yield None, None, len(own)
            continue
        at = np.searchsorted(grams, own)
        place = np.flatnonzero(np.append(grams, -1)[at] == own)
        first = starts[at[place]]
        many = starts[at[place] + 1] - first
        at = np.repeat(first - np.cumsum(many) + many, many) + np.arange(many.sum())
        nearer = np.abs(np.repeat(place + 1, many) - ranks[at]) - size
        distance = size * len(own) + np.bincount(languages[at], nearer, len(names)).astype(np.int64)
        best = int(distance.argmin())
        yield names[best], int(distance[best]), len(own)


def identify(text: Column, profiles: dict[str, dict[str, int]], size: int = PROFILE) -> Column:
    """``struct<predicted string, distance long, n_grams int>``: the nearest
    language (ties: the first by name), the ranks by which the text's most
    frequent n-grams are out of place in its profile (``size`` for one that it
    lacks), and how many those are. A text without letters has NULL for both."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(_postings(profiles))

    def score(texts: pa.Array) -> pa.Array:
        import pyarrow as pa
        found = _nearest((value.as_py() for value in texts), shared.value, size)
        return pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(zip(*found), (pa.string(), pa.int64(), pa.int32()))], ["predicted", "distance", "n_grams"])

    return F.arrow_udf(score, returnType="struct<predicted string, distance long, n_grams int>")(letters_only(text))


def profile_filter(df: DataFrame, profiles: dict[str, dict[str, int]], languages: list[str], most_distance: float = 1.0, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """The rows whose predicted language is listed, with ``predicted`` and ``distance``: the mean share of a profile by which n-grams are out of place, at most ``most_distance``."""
    scored = df.withColumn("_found", identify(F.col(text_col), profiles, size))
    share = F.col("_found.distance") / (F.col("_found.n_grams") * size)
    out = scored.select(*df.columns, F.col("_found.predicted").alias("predicted"), share.alias("distance"))
    # A filter pushed below the projection would have every text scored a second time.
    return filter_fenced(out.withColumn("_near", F.col("predicted").isin(languages) & (F.col("distance") <= most_distance)), "_near")
