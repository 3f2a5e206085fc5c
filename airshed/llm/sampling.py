"""Bounded samples of rows for fitting small models on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_ALL = 1 << 52


def share_of(n: int, size: int) -> int:
    """The share (of 2**52) that makes about ``size`` of ``n`` rows."""
    return _ALL if n <= size else int(size / n * _ALL)


def drawn(key: str, share: int, seed: int = 0) -> Column:
    """Whether a row belongs to the sample: a hash of ``key``, so the same
    rows are drawn wherever the key stands."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("long")), 12) < F.lit(share)


def bounded_sample(df: DataFrame, key: str, size: int, seed: int = 0) -> DataFrame:
    """About ``size`` rows (all, if there are no more), the same ones each
    time, spread over all partitions. The count reads one column only."""
    return df.where(drawn(key, share_of(df.select(key).count(), size), seed))
