"""A bitmap of bounded size that tells which 64-bit keys may be in a set.

It never denies a key of the set; other keys pass with a small chance, which grows once the set
has outgrown the largest bitmap. So it may only thin rows ahead of an exact step.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyFilter:
    """Two bits per key, taken from either half of it.

    With a session the words are a broadcast variable, which a Python worker holds once. In the
    closure of a function it would hold them twice, as the function and as what that was read from.
    """

    def __init__(self, words: np.ndarray, spark: SparkSession | None = None):
        self.held = spark.sparkContext.broadcast(words) if spark else words
        self.mask = np.uint64(64 * len(words) - 1)

    @property
    def words(self) -> np.ndarray:
        return self.held if isinstance(self.held, np.ndarray) else self.held.value

    def _bit(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.view(np.uint64)
        return (self._bit(keys & self.mask) & self._bit((keys >> np.uint64(34)) & self.mask)).astype(bool)


def key_filter(keys: DataFrame, column: str = "key", bits_per_key: int = 16, most_bits: int = 1 << 27) -> KeyFilter:
    """The filter of a column of well mixed longs. Spark sets the bits; at most ``most_bits`` (16 MB) reach the driver."""
    size = 64
    wanted = min(most_bits, bits_per_key * keys.count())
    while size < wanted:
        size *= 2
    places = F.array(F.col(column).bitwiseAND(size - 1), F.shiftrightunsigned(column, 34).bitwiseAND(size - 1))
    bits = keys.select(F.explode(places).alias("p")).select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b"))
    rows = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(size // 64, np.uint64)
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return KeyFilter(words, keys.sparkSession)
