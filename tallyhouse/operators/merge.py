"""Upserts and appends as pure functions (current, incoming) -> new.

The current table is the large side. Nothing here needs a full outer join, so with a
small batch Spark broadcasts the batch and reads the current table without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def upsert(current: DataFrame, incoming: DataFrame, key, compare: Sequence[str] | None = None, like_sized: bool = False) -> DataFrame:
    """The new table with a column `action`: insert, update, same or keep.

    A row is updated only where a compared column differs (NULL equals NULL). Columns
    are those of `current`; keys are unique and not NULL on both sides. A small batch is
    broadcast, and the current table, read twice, stays where it is. For a batch about as
    large as the table `like_sized` reads and shuffles both once, in a full outer join.
    """
    keys = _keys(key)
    values = [c for c in current.columns if c not in keys]
    compare = list(compare) if compare is not None else values
    batch = incoming.select(*keys, *[F.col(c).alias(f"_in_{c}") for c in values], F.lit(True).alias("_in"))
    changed = F.lit(False)
    for c in compare:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_in_{c}"))
    action = F.when(F.col("_in").isNull(), "keep").when(changed, "update").otherwise("same")
    if like_sized:
        known = current.withColumn("_now", F.lit(True))
        merged = known.join(batch, keys, "full").withColumn("action", F.when(F.col("_now").isNull(), "insert").otherwise(action))
        taken = F.col("action").isin("insert", "update")
        return merged.select(*[c if c in keys else F.when(taken, F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c) for c in current.columns], "action")
    touched = (
        current.join(batch, keys, "left")
        .withColumn("action", action)
        .select(
            *keys,
            *[F.when(F.col("action") == "update", F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c) for c in values],
            "action",
        )
    )
    # Only the key columns of the current table are read for this side.
    present = current.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    fresh = incoming.select(*current.columns).join(present, keys, "left_anti").withColumn("action", F.lit("insert"))
    return touched.select(*current.columns, "action").unionByName(fresh)


def action_counts(merged: DataFrame) -> DataFrame:
    return merged.agg(
        F.count_if(F.col("action") == "insert").alias("inserted"),
        F.count_if(F.col("action") == "update").alias("updated"),
        F.count_if(F.col("action") == "same").alias("unchanged"),
        F.count_if(F.col("action") == "keep").alias("untouched"),
    )


def append_new(target: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Incoming rows whose key the target lacks: what an idempotent append writes."""
    keys = _keys(key)
    known = target.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    return incoming.join(known, keys, "left_anti")


def insert_absent(current: DataFrame, incoming: DataFrame, key) -> DataFrame:
    """Current rows plus the incoming rows with a new key."""
    return current.unionByName(append_new(current, incoming, key).select(*current.columns))


def replace_groups(current: DataFrame, recomputed: DataFrame, key) -> DataFrame:
    """Groups that were recomputed replace their old row; NULL is a key value of its own."""
    keys = _keys(key)
    fresh = recomputed.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return current.join(fresh, same, "left_anti").unionByName(recomputed.select(*current.columns))


def accumulate(current: DataFrame, delta: DataFrame, key, how: Mapping[str, str]) -> DataFrame:
    """Running totals: `how` maps each value column to sum, min or max; a NULL sum counts as 0."""
    both = current.unionByName(delta.select(*current.columns))
    types = dict(current.dtypes)
    return both.groupBy(*_keys(key)).agg(*[_fold(c, kind).cast(types[c]).alias(c) for c, kind in how.items()]).select(*current.columns)


def _fold(col: str, kind: str) -> Column:
    if kind == "sum":
        return F.sum(F.coalesce(F.col(col), F.lit(0)))
    return {"min": F.min, "max": F.max}[kind](col)
