"""Column expressions over text: word splitting, normalisation, whole-word
matching. All are built-in Spark expressions (JVM side, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as one explicit class so Java regex and RE2 agree exactly.
WHITESPACE = r"[ \t\n\x0B\f\r]+"
# A "word character" for whole-word matching: letter, digit or underscore.
WORD_CHAR = r"[\p{L}\p{N}_]"


def text_or_empty(col: Column | str) -> Column:
    """Missing text reads as the empty string."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def words(text: Column) -> Column:
    """Non-empty whitespace-separated tokens, as ``str.split()`` gives."""
    return F.array_remove(F.split(text, WHITESPACE), "")


def normalise(text: Column) -> Column:
    """Lower case, every run of non letters/digits becomes one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def normalised_words(text: Column) -> Column:
    return F.filter(F.split(normalise(text), " "), lambda w: w != "")


def whole_word_pattern(keywords: list[str]) -> str:
    """Regex that finds any keyword as a whole word (no letter, digit or
    underscore on either side), the meaning of ``\\b`` in Python."""
    alts = "|".join(_escape(k) for k in keywords)
    return f"(?<!{WORD_CHAR})(?:{alts})(?!{WORD_CHAR})"


def _escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch)
    return "".join(out)


def preview(text: Column, n: int = 100, placeholder: str = "[No Text Found]") -> Column:
    """First ``n`` characters followed by ``...``; a placeholder when empty."""
    t = text_or_empty(text)
    return F.when(t != "", F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(
        F.lit(placeholder))


def capitalize(s: Column) -> Column:
    """First character upper case, the rest lower case (not per word)."""
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 1 << 30)))
