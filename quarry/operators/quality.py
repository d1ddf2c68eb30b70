"""Row-local quality and topic filters.

Each filter is one ``select`` of built-in expressions (split, filter, size,
aggregate over arrays, regex): it stays inside whole-stage code generation,
needs no shuffle, and runs unchanged on a batch or a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import text_or_empty, whole_word_pattern, words
from quarry.operators.keywords import keyword_hits, matched_keywords
from quarry.plans.parallel import filter_fenced
from quarry.sources.tables import take_first

# The Gopher stop-word list (Rae et al. 2021, appendix A).
GOPHER_STOP_WORDS = ["the", "be", "to", "of", "and", "that", "have", "with"]


@dataclass(frozen=True)
class GopherRules:
    """Thresholds. The first four are the ones the pipeline sets explicitly;
    the rest are the published Gopher defaults."""
    min_doc_words: int = 50
    max_doc_words: int = 100_000
    min_avg_word_length: float = 3
    max_avg_word_length: float = 10
    max_symbol_word_ratio: float = 0.1
    max_bullet_lines_ratio: float = 0.9
    max_ellipsis_lines_ratio: float = 0.3
    max_non_alpha_words_ratio: float = 0.8
    min_stop_words: int = 2
    stop_words: tuple[str, ...] = tuple(GOPHER_STOP_WORDS)


# Rule names in evaluation order; the first failing rule is the reason.
GOPHER_REASONS = ["short_doc", "long_doc", "avg_word_low", "avg_word_high",
                  "hash_ratio", "ellipsis_ratio", "bullet_lines", "ellipsis_lines",
                  "alpha_words", "stop_words"]


# A whole word that has a letter or a digit. The look behind keeps a long run
# of symbols from being tried again from each of its places.
ALNUM_WORD = r"(?<![^ \t\n\x0B\f\r])[^ \t\n\x0B\f\r\p{L}\p{N}]*+[\p{L}\p{N}][^ \t\n\x0B\f\r]*+"
# From a word's first letter to its end, or what lies between: the first group
# is one letter for each word with a letter.
LETTER_WORD = r"(\p{L})[^ \t\n\x0B\f\r]*+|[^\p{L}]++"


def _gopher_columns(df: DataFrame, text_col: str, rules: GopherRules) -> DataFrame:
    """Adds ``reason`` in staged projections: each array (words, lines) is
    built once. Words are counted by one pass of a regular expression over the
    text, and what only a later rule compares is counted where no earlier rule
    has failed."""
    t = text_or_empty(F.col(text_col))
    stops = F.array(*[F.lit(s) for s in rules.stop_words])
    c, ws, lines = F.col, F.col("_ws"), F.col("_lines")
    # Each such word as one "a"; what is left has no letter.
    s1 = df.withColumn("_marked", F.regexp_replace(t, ALNUM_WORD, "a"))
    s2 = s1.withColumn("_n_nsw", F.length("_marked") - F.length(F.replace("_marked", F.lit("a"), F.lit(""))))
    s2 = s2.withColumn("_nsw_chars", F.length(F.make_valid_utf8(t)) - F.length("_marked") + c("_n_nsw"))
    avg_len = c("_nsw_chars") / F.nullif(c("_n_nsw"), F.lit(0))
    s3 = s2.withColumn("_by_length", F.when(c("_n_nsw") < rules.min_doc_words, "short_doc")
                       .when(c("_n_nsw") > rules.max_doc_words, "long_doc")
                       .when(avg_len < F.lit(float(rules.min_avg_word_length)), "avg_word_low")
                       .when(avg_len > F.lit(float(rules.max_avg_word_length)), "avg_word_high"))
    passed = c("_by_length").isNull()
    s4 = s3.withColumn("_ws", F.when(passed, words(t))).withColumn("_lines", F.when(passed, F.split(t, "\n")))
    n_words, n_lines = F.size(ws), F.size(lines)
    n_hash = F.length(t) - F.length(F.replace(t, F.lit("#"), F.lit("")))
    n_ell = ((F.length(t) - F.length(F.replace(t, F.lit("..."), F.lit("")))) / 3
             + (F.length(t) - F.length(F.replace(t, F.lit("\u2026"), F.lit("")))))
    bullets = F.size(F.filter(lines, lambda ln: F.ltrim(ln).startswith("\u2022") | F.ltrim(ln).startswith("-")))
    ell_lines = F.size(F.filter(lines, lambda ln: F.rtrim(ln).endswith("...") | F.rtrim(ln).endswith("\u2026")))
    alpha = F.length(F.regexp_replace(t, LETTER_WORD, "$1"))
    n_stop = F.size(F.array_intersect(stops, ws))

    def over(num: Column, den: Column, limit: float) -> Column:
        return num > F.lit(float(limit)) * den

    reason = (F.when(~passed, c("_by_length"))
              .when(over(n_hash, n_words, rules.max_symbol_word_ratio), "hash_ratio")
              .when(over(n_ell, n_words, rules.max_symbol_word_ratio), "ellipsis_ratio")
              .when(over(bullets, n_lines, rules.max_bullet_lines_ratio), "bullet_lines")
              .when(over(ell_lines, n_lines, rules.max_ellipsis_lines_ratio), "ellipsis_lines")
              .when(alpha < F.lit(float(rules.max_non_alpha_words_ratio)) * n_words,
                    "alpha_words")
              .when(n_stop < rules.min_stop_words, "stop_words"))
    temp = [x for x in s4.columns if x.startswith("_") and x not in df.columns]
    return s4.withColumn("reason", reason).drop(*temp)


def gopher_annotate(df: DataFrame, text_col: str = "text",
                    rules: GopherRules = GopherRules()) -> DataFrame:
    """Adds ``reason`` (NULL = kept, else the first failing rule) and ``kept``."""
    return _gopher_columns(df, text_col, rules).withColumn("kept", F.col("reason").isNull())


def gopher_filter(df: DataFrame, text_col: str = "text",
                  rules: GopherRules = GopherRules()) -> DataFrame:
    flagged = _gopher_columns(df, text_col, rules).withColumn("_ok", F.col("reason").isNull())
    return filter_fenced(flagged.drop("reason"), "_ok")


def gopher_reasons(df: DataFrame, text_col: str = "text",
                   rules: GopherRules = GopherRules()) -> DataFrame:
    """Rows per reason; passing rows are counted under ``kept``."""
    return (_gopher_columns(df.select(text_col), text_col, rules)
            .select(F.coalesce("reason", F.lit("kept")).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


# Common function words per language, used for the
# stop-word-overlap language score.
LANGUAGE_STOP_WORDS = {
    "en": ["the", "and", "of", "to", "is", "in", "that", "it", "with", "for"],
    "fr": ["le", "la", "les", "et", "des", "un", "une", "du", "est", "pour"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "den"],
    "es": ["el", "los", "las", "y", "es", "una", "que", "del", "por", "con"],
}


def language_annotate(df: DataFrame, text_col: str = "text",
                      stop_words: dict[str, list[str]] = LANGUAGE_STOP_WORDS) -> DataFrame:
    """Adds ``predicted`` and ``score``: the language whose stop words make up
    the largest share of the lower-cased words (ties: first listed)."""
    ws = df.withColumn("_lw", words(F.lower(text_or_empty(F.col(text_col)))))
    n = F.nullif(F.size("_lw"), F.lit(0))

    def member_of(arr: Column):
        return lambda w: F.array_contains(arr, w)

    langs = list(stop_words)
    scored = ws.select("*", *[
        (F.size(F.filter("_lw", member_of(F.array(*[F.lit(s) for s in stop_words[l]])))) / n)
        .alias(f"_s_{l}") for l in langs])
    best = F.greatest(*[F.col(f"_s_{l}") for l in langs])
    pred = F.lit(None).cast("string")
    for l in reversed(langs):
        pred = F.when(F.col(f"_s_{l}") == F.col("_best"), F.lit(l)).otherwise(pred)
    out = scored.withColumn("_best", best)
    out = out.withColumn("predicted", pred).withColumn("score", F.coalesce("_best", F.lit(0.0)))
    return out.drop("_lw", "_best", *[f"_s_{l}" for l in langs])


def language_select(df: DataFrame, languages: list[str], lang_col: str = "lang") -> DataFrame:
    """Keep rows whose language column is listed; the predicate reaches the
    Parquet scan."""
    return df.filter(F.col(lang_col).isin(languages))


def language_filter(df: DataFrame, languages: list[str], min_score: float = 0.0,
                    text_col: str = "text") -> DataFrame:
    """Keep rows whose predicted language is listed and scores at least
    ``min_score``."""
    out = language_annotate(df, text_col)
    out = out.withColumn("_ok", F.col("predicted").isin(languages) & (F.col("score") >= min_score))
    return filter_fenced(out, "_ok")


# The history keywords of the topic collection step.
HISTORY_KEYWORDS = ["history", "ancient", "war", "century", "empire",
                    "civilization", "dynasty", "archaeology"]


# Up to so many keywords a regular expression is faster than an automaton.
REGEX_KEYWORDS = 32


def topic_match(text: Column, keywords: list[str]) -> Column:
    """Lower-cased text contains any keyword as a whole word: by a regular
    expression, or for long lists by an automaton that reads a text once."""
    if len(keywords) > REGEX_KEYWORDS:
        return F.size(matched_keywords(text, keywords, any_only=True)) > 0
    return F.lower(text_or_empty(text)).rlike(whole_word_pattern(keywords))


def topic_extract(df: DataFrame, keywords: list[str] = HISTORY_KEYWORDS,
                  limit: int | None = None, text_col: str = "text",
                  order_by: str = "doc_id") -> DataFrame:
    """Original records whose text mentions a keyword; with ``limit`` only the
    first of them in ``order_by`` order (a collection target)."""
    hits = df.filter(topic_match(F.col(text_col), keywords))
    return take_first(hits, limit, order_by) if limit else hits


def topic_hits(df: DataFrame, keywords: list[str] = HISTORY_KEYWORDS,
               text_col: str = "text") -> DataFrame:
    """Documents matching each keyword: one pass, one boolean column per
    keyword, a global partial/final sum, then unpivot; for long lists one
    search of each text for all keywords (:mod:`quarry.operators.keywords`)."""
    if len(keywords) > REGEX_KEYWORDS:
        return keyword_hits(df, keywords, text_col)
    low = F.lower(text_or_empty(F.col(text_col)))
    flags = [F.sum(low.rlike(whole_word_pattern([k])).cast("long")).alias(f"k{i}")
             for i, k in enumerate(keywords)]
    sums = df.agg(*flags)
    stack = ", ".join("'" + k.replace("\\", "\\\\").replace("'", "\\'") + f"', k{i}"
                      for i, k in enumerate(keywords))
    return sums.selectExpr(f"stack({len(keywords)}, {stack}) as (keyword, n_docs)").select(
        "keyword", F.coalesce(F.col("n_docs"), F.lit(0)).cast("long").alias("n_docs"))
