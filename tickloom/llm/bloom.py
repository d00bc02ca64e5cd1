"""Bloom filters of a size fixed beforehand: bits are set in tasks, summed by word, and sent to every task.

Keys are two independent 64-bit hashes, columns `a` and `b`. What is broadcast is the bits, never more than MOST_BITS.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import text

MOST_BITS = 1 << 30


def hashed(key: Column) -> list[Column]:
    """The two hashes of a key."""
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


class Filter:
    def __init__(self, bits: int, hashes: int, salt: int, words: np.ndarray | None = None):
        if bits > MOST_BITS:
            raise ValueError(f"a filter of {bits} bits is over the bound of {MOST_BITS}: split the keys")
        self.size, self.hashes, self.salt = max(64, -(-bits // 64) * 64), hashes, salt
        self.words = np.zeros(self.size // 64, np.uint64) if words is None else words

    @classmethod
    def for_rate(cls, keys: int, rate: float, salt: int = 0) -> Filter:
        """Empty, for a share `rate` of other keys let through."""
        bits = math.log2(1 / rate)
        return cls(math.ceil(keys * bits / math.log(2)), max(1, round(bits)), salt)

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(hashes, keys): the bit of each key under each hash."""
        salt = np.uint64((self.salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        start, step = text.mix(a.view(np.uint64) ^ salt), text.mix(b.view(np.uint64) + salt)
        turns = np.arange(self.hashes, dtype=np.uint64)[:, None]
        return text.mix(start + turns * (step | np.uint64(1))) % np.uint64(self.size)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.places(a, b)
        return ((self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)

    def filled(self, keys: DataFrame) -> Filter:
        """With the keys `a`, `b`: tasks send one row for each word that they touch, words are joined by OR."""
        bare = Filter(self.size, self.hashes, self.salt, np.zeros(0, np.uint64))  # places need no words

        def touched(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = np.sort(bare.places(batch.column(0).to_numpy(), batch.column(1).to_numpy()).ravel())
            cuts, words = text.cut(at >> np.uint64(6))
            ones = np.uint64(1) << (at & np.uint64(63))
            joined = np.bitwise_or.reduceat(ones, [s for s, _ in cuts]) if cuts else ones
            return pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(joined.view(np.int64))], ["word", "bits"])

        rows = keys.select("a", "b").mapInArrow(text.by_batch(touched), "word long, bits long")
        table = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        words = self.words.copy()
        words[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
        return Filter(self.size, self.hashes, self.salt, words)
