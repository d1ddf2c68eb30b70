"""Deterministic hashing shared by every operator that needs randomness.

The only randomness anywhere is an MD5 of a string: it is stable across
engines, executors, retries and releases, so a re-run reproduces the same
shuffle, draws and signatures.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_prefix_int(s: Column, hex_digits: int) -> Column:
    """The first ``hex_digits`` hex digits of md5(s) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(s), 1, hex_digits), 16, 10).cast("bigint")


def md5_u32(s: Column) -> Column:
    """Uniform 32-bit integer in [0, 2^32)."""
    return md5_prefix_int(s, 8)
