"""Checks over whole tables; each returns rows, so a report is itself a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import dedup, merge, referential, rules


@dataclass(frozen=True)
class Constraints:
    """NOT NULL columns, key, foreign keys (column -> (parent, parent column)) and row checks."""

    not_null: Sequence[str] = ()
    key: Sequence[str] = ()
    foreign: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)
    checks: Sequence[rules.Rule] = ()


def check_constraints(df: DataFrame, spec: Constraints) -> DataFrame:
    """`rule`, `broken`: rows per broken rule, keys per duplicate key, rows per orphan key."""
    out = []
    row_rules = [*rules.required(*spec.not_null, blank="allowed"), *spec.checks]
    if row_rules:
        out.append(rules.count_broken(df, row_rules))
    if spec.key:
        name = "duplicate key " + ", ".join(spec.key)
        out.append(dedup.duplicate_keys(df, spec.key).agg(F.count(F.lit(1)).alias("broken")).select(F.lit(name).alias("rule"), "broken"))
    for col, (parent, parent_col) in spec.foreign.items():
        lost = referential.orphans(df, parent, col, parent_col)
        out.append(lost.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("broken")).select(F.lit(f"orphan {col}").alias("rule"), "broken"))
    return reduce(DataFrame.unionByName, out)


def scorecard(df: DataFrame, required: Sequence[str], accurate: Sequence[rules.Rule], parent: DataFrame, key: str, parent_key: str, at: str, as_of: Column) -> DataFrame:
    """One row: completeness, accuracy, consistency (shares) and hours since the last row."""
    filled = reduce(lambda a, b: a + b, [F.count(c) for c in required])
    good = reduce(lambda a, b: a & b, [~r.broken() for r in accurate])
    n = F.count(F.lit(1))
    base = df.agg(
        n.alias("row_count"),
        S.ratio(filled, n * len(required)).alias("completeness"),
        S.ratio(F.count_if(good), n).alias("accuracy"),
        S.hours_between(as_of, F.max(at)).alias("hours_behind"),
    )
    lost = referential.orphans(df, parent, key, parent_key).agg(F.coalesce(F.sum("row_count"), F.lit(0))).scalar()
    return base.withColumn("consistency", 1.0 - S.ratio(lost, F.col("row_count")))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def load_report(staged: DataFrame, merged: DataFrame, skipped: Column) -> DataFrame:
    """total, inserted, updated, skipped of one load, as one row."""
    zero = F.lit(0).cast("long")
    read = staged.agg(F.count(F.lit(1)).alias("total"), zero.alias("inserted"), zero.alias("updated"), F.count_if(skipped).alias("skipped"))
    done = merge.action_counts(merged).select(zero.alias("total"), "inserted", "updated", zero.alias("skipped"))
    return read.unionByName(done).agg(*[F.sum(c).alias(c) for c in read.columns])
