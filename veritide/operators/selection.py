"""The k smallest rows of a table of any size, exactly, without sorting it.

The k-th smallest key is found by histograms that narrow: each pass counts the rows of the range that holds it in 4,096
bins, and the next looks into one of them. Only counts of bins come to the driver, and a pass reads the key columns alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN_BITS = 12


def kth_smallest(table: DataFrame, k: int, keys: dict[str, int]) -> list[int]:
    """The k-th smallest tuple of the whole, non-negative columns ``keys``, given with the bits that each has at most.

    ``k`` counts from 1. Of rows with one tuple any are meant, so keys that end with a row number tell all rows apart.
    """
    if k < 1 or any(bits > 60 for bits in keys.values()):
        raise ValueError("k counts from 1, and keys have 60 bits at most")
    found: list[int] = []
    for name, bits in keys.items():
        equal = reduce(Column.__and__, (F.col(c) == v for c, v in zip(keys, found)), F.lit(True))
        shift, prefix = -(-bits // BIN_BITS) * BIN_BITS, 0
        while shift:
            inside = equal & (F.shiftright(F.col(name), shift) == prefix)
            shift -= BIN_BITS
            counts = table.where(inside).groupBy(F.shiftright(F.col(name), shift).alias("bin")).agg(F.count("*").alias("n"))
            prefix, k = _bin_of(sorted(counts.collect()), k)
        found.append(prefix)
    return found


def _bin_of(counts: list, k: int) -> tuple[int, int]:
    """The bin that holds the k-th row, and its place there."""
    for number, n in counts:
        if k <= n:
            return number, k
        k -= n
    raise ValueError("there are fewer rows than asked for")


def at_most(keys: list[str], bound: list[int]) -> Column:
    """Whether a row's keys come no later than ``bound``."""
    last = F.lit(True)
    for name, value in reversed(list(zip(keys, bound, strict=True))):
        last = (F.col(name) < value) | ((F.col(name) == value) & last)
    return last
