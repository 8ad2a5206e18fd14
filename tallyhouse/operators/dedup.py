"""One row per key.

`row_number() = 1` lets Spark keep only the best row per key in each task before the
shuffle (WindowGroupLimit), so a hot key sends one row per task, not all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    cols = [cols] if isinstance(cols, str | Column) else list(cols)
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def full_row_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """All columns as a tie-break: rows that tie on it are equal anyway."""
    return [F.col(c).asc_nulls_last() for c in df.columns if c not in skip]


def keep_latest(df: DataFrame, key, order) -> DataFrame:
    """First row per key in the given order (columns, mostly `.desc_nulls_last()`), ties by the whole row."""
    return keep_top(df, key, order, 1)


def keep_top(df: DataFrame, key, order, n: int) -> DataFrame:
    window = Window.partitionBy(*_cols(key)).orderBy(*_cols(order), *full_row_order(df))
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def keep_one(df: DataFrame, key) -> DataFrame:
    """Any row per key, but the same one in every run."""
    return keep_latest(df, key, [])


def keep_last(df: DataFrame, key, ordinal: Sequence[str]) -> DataFrame:
    """The last row in file order; `ordinal` as given by `sources.csv.read_csv_staging`."""
    return keep_latest(df, key, [F.col(c).desc() for c in ordinal])


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys on more than one row, with their number of rows."""
    return df.groupBy(*_cols(key)).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
