"""A Bloom filter of fixed size, built on the cluster: the only thing sent to every task is BITS / 8 bytes.

It only spares shuffling rows that cannot join; the join itself follows, so more keys than the filter is
made for cost time, never results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 24
_MASK = np.uint64(BITS - 1)


def build(keys: DataFrame, column: str) -> np.ndarray:
    """Bitmap (2 MB) with two bits per 64-bit key of ``column``."""
    k = F.col(column)
    both = keys.select(F.explode(F.array(_low(k), _low(F.shiftrightunsigned(k, 32)))).alias("bit"))
    words = both.groupBy(F.shiftright("bit", 5).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 31 AS int)))").alias("v"))
    out = np.zeros(BITS >> 5, dtype=np.uint32)
    got = words.toArrow()  # at most BITS / 32 rows
    out[got["w"].to_numpy()] = got["v"].to_numpy().astype(np.uint32)
    return out


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(BITS - 1).cast("long"))


def test(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    k = keys.view(np.uint64)
    hit = np.ones(len(k), dtype=bool)
    for part in (k & _MASK, (k >> np.uint64(32)) & _MASK):
        hit &= (bitmap[part >> np.uint64(5)] >> (part & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1
    return hit
