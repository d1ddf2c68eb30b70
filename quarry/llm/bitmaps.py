"""A bitmap of fixed size that lets a second pass over the texts skip what cannot matter.

It is made by Spark (one row for each 64 bits), so at most ``2**(bits - 6)``
numbers reach the driver and every task. A bit set by another entry only lets
more through; an exact join follows wherever that matters.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """``slots`` has a column ``slot`` from 0 to ``2**bits - 1``."""
    words = slots.select((F.col("slot") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, cast(slot % 64 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(1 << (bits - 6), np.int64)
    got = words.toArrow()
    table[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return table.view(np.uint64)


def inside(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether the bit of each slot is set."""
    return (table[slots >> 6] >> (slots & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
