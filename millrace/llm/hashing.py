"""Hashes of all substrings of a text, and fixed-size filters of hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts are worked on in stretches of about this many bytes; a task's arrays have some
#: hundred bytes for each.
CHUNK_BYTES = 1 << 19
FILTER_BITS = 1 << 24


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Rolling:
    """Hashes of all substrings of a byte array: sums of byte codes times powers."""

    base = 0x9E3779B97F4A7C15 | 1
    powers = np.ones(1, "uint64")
    inverse = np.ones(1, "uint64")

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(self.powers) < n:
            size = max(n, CHUNK_BYTES + (1 << 16))
            for name, base in (("powers", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
                row = np.full(size, base, "uint64")
                row[0] = 1
                setattr(Rolling, name, np.multiply.accumulate(row))
        code = mix(np.arange(1, 257, dtype="uint64"))[data]
        self.sums = np.zeros(n, "uint64")
        np.cumsum(code * self.powers[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def each(self, size: int) -> np.ndarray:
        """Those of all substrings of one size, in order, without arrays of their places."""
        sums = self.sums[size:] - self.sums[: len(self.sums) - size]
        sums *= self.inverse[: len(sums)]
        return mix(sums)


def bit_table(keys: DataFrame, key: Column) -> np.ndarray:
    """A bit array of fixed size (2 MB), whatever the number of keys, that holds the 64-bit
    hashes ``key`` of ``keys``."""
    at = F.pmod(key, F.lit(FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    # As Arrow: a Python object for each of up to 262,144 rows is what the driver would hold most of.
    words = keys.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, "uint64")
    table[words["word"].to_numpy()] = words["bits"].to_numpy().view("uint64")
    return table


def held(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the hashes may be among those of a ``bit_table``."""
    bits = hashes % FILTER_BITS
    return (table[bits >> 6] >> (bits & 63).astype("uint64") & np.uint64(1)).astype(bool)


def in_table(table: np.ndarray, asked: Column) -> Column:
    """``held`` as a column."""

    @F.pandas_udf("boolean")
    def test(hashes: pd.Series) -> pd.Series:
        return pd.Series(held(table, hashes.to_numpy("int64")))

    return test(asked)


def maybe_in(keys: DataFrame, key: Column, asked: Column) -> Column:
    """True where ``asked`` may be among the 64-bit hashes ``key`` of ``keys``, false only
    where it is not, by a ``bit_table``. It thins rows before a join and decides nothing."""
    return in_table(bit_table(keys, key), asked)
