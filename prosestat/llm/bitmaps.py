"""A bitmap of fixed size that tells tasks what may be frequent elsewhere.

It has a bit for each of ``BITS`` hash values: 16 MB, whatever the size of the
table. A set bit may stand for several keys, so it can let through what isn't
wanted and never loses what is: results must not depend on it, only work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27
_BUCKET = 32_768  # bits in a row of the built-in functions, which count from 1


def bitmap_of(df: DataFrame, hashed: Column) -> np.ndarray:
    """The bitmap of all values of a 64-bit hash, put together from ``BITS / 32768`` rows at most."""
    bit = F.pmod(hashed, F.lit(BITS)) + 1
    parts = df.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(BITS // 8, np.uint8)
    for r in parts.collect():
        at = (r.bucket - 1) * _BUCKET // 8
        out[at: at + _BUCKET // 8] = np.frombuffer(r.bits, np.uint8)
    return out


def has(bitmap: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether the bits of unsigned 64-bit hashes are set."""
    bit = hashed % np.uint64(BITS)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & 1) > 0
