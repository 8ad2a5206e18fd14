"""Joins of a large table with one that is mostly small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Stored bytes that are sent to all tasks at most; in memory they are some times as many.
MOST = 8 << 20


def join_small(large: DataFrame, small: DataFrame, on: str, how: str, most: int = MOST) -> DataFrame:
    """`small` is a stored table, whose size Spark knows from its files. Up to `most` bytes it is sent to all tasks and the large table
    stays where it is; beyond, both are shuffled. The result is the same."""
    stored = int(str(small._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return large.join(F.broadcast(small) if stored <= most else small, on, how)
