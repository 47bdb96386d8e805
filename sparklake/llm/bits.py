"""Bit filters over hashed keys: built by an aggregate, sized by a count, probed in numpy.

A key that was put in is always found; others are found now and then, so an exact step follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_KEY = 16  # bits for each key; with three probes about one other key in 200 passes
PROBES = (0, 17, 34)  # where in a key the bits of a probe begin
LEAST, MOST = 1 << 15, 1 << 30  # bits; a filter takes 128 MB at most, whatever the number of keys


def size_for(keys: int) -> int:
    """The number of bits, a power of two, for so many keys."""
    return min(MOST, max(LEAST, 1 << (keys * PER_KEY - 1).bit_length() if keys else LEAST))


def bits_of(key: Column, size: int) -> Column:
    return F.array(*[F.shiftrightunsigned(key, k).bitwiseAND(F.lit(size - 1).cast("bigint")) for k in PROBES])


def build(keys: DataFrame, key: str, size: int) -> np.ndarray:
    """The filter over column ``key``, eight bits a byte.

    Bitmaps of 4 KB are made before the shuffle; the driver gets at most ``size / 2^15`` of them.
    """
    place = F.col("place") + 1
    parts = keys.select(F.explode(bits_of(F.col(key), size)).alias("place"))
    parts = parts.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    packed = np.zeros(size // 8, np.uint8).reshape(-1, LEAST // 8)
    for part, bitmap in parts.groupBy("part").agg(F.bitmap_construct_agg("bit")).collect():
        packed[part - 1] = np.frombuffer(bitmap, np.uint8)
    return packed.ravel()


def probe(packed: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys the filter may hold."""
    key, last = key.view(np.uint64), np.uint64(len(packed) * 8 - 1)
    found = np.ones(len(key), np.uint8)
    for k in PROBES:
        bit = (key >> np.uint64(k)) & last
        found &= packed[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)
    return found & 1 == 1
