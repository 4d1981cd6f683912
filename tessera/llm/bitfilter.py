"""A filter of 64-bit keys as one bit array of bounded size: what was put in passes, some others may."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and the bound on all bits: 8 MB.
BITS_EACH, MOST_BITS = 16, 1 << 26


def bit_filter(keys: DataFrame, column: str, most: int = MOST_BITS) -> np.ndarray:
    """keys: uniform longs. The bits by word of 64, set in a distributed way; the words come to the driver."""
    n = keys.count()
    bits = 1 << max(10, min(most.bit_length() - 1, (BITS_EACH * n).bit_length()))
    place = F.col(column).bitwiseAND(F.lit(bits - 1))
    words = (
        keys.select(F.shiftright(place, 6).alias("w"), F.expr(f"shiftleft(1L, cast({column} & 63L as int))").alias("b"))
        .groupBy("w")
        .agg(F.bit_or("b").alias("b"))
        .toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out.view(np.uint64)


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of these 64-bit keys pass."""
    place = keys.astype(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
