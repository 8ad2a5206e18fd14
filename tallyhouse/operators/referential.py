"""Keys that have to exist in a parent table.

The parent side is reduced to its distinct keys. A hot key on the child side is
either aggregated away before the shuffle (reports, gates) or split by the adaptive
skew join (drops), which covers semi and anti joins with the hot side on the left.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.rules import GateError


def _parent_keys(parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]) -> DataFrame:
    return parent.select(*[F.col(p).alias(c) for c, p in zip(child_keys, parent_keys, strict=True)])


def _lists(key, parent_key) -> tuple[list[str], list[str]]:
    keys = [key] if isinstance(key, str) else list(key)
    if parent_key is None:
        return keys, keys
    return keys, [parent_key] if isinstance(parent_key, str) else list(parent_key)


def fk_keep(df: DataFrame, parent: DataFrame, key, parent_key=None, null_fk: str = "drop") -> DataFrame:
    """Rows whose key is in the parent; a NULL key is dropped, or kept with null_fk="keep"."""
    keys, parents = _lists(key, parent_key)
    known = _parent_keys(parent, keys, parents)
    if null_fk == "drop":
        return df.join(known, keys, "left_semi")
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    return df.where(~some_null).join(known, keys, "left_semi").unionByName(df.where(some_null))


def membership(df: DataFrame, parent: DataFrame, key, parent_key=None) -> DataFrame:
    """`key IN (SELECT parent_key ...)`."""
    return fk_keep(df, parent, key, parent_key)


def orphans(df: DataFrame, parent: DataFrame, key, parent_key=None) -> DataFrame:
    """Distinct non-NULL child keys that the parent lacks, with their number of rows.

    The child is aggregated by key first, so the anti join sees one row per key.
    """
    keys, parents = _lists(key, parent_key)
    found = df.dropna("any", subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return found.join(_parent_keys(parent, keys, parents), keys, "left_anti")


def orphan_counts(df: DataFrame, parent: DataFrame, key, parent_key=None) -> DataFrame:
    """One row: number of orphan keys and of rows that have one; `orphans` names every key."""
    lost = orphans(df, parent, key, parent_key)
    return lost.agg(F.count(F.lit(1)).alias("orphan_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"))


def fk_gate(df: DataFrame, parent: DataFrame, key, parent_key=None, message: str = "unknown keys") -> DataFrame:
    """Stop the batch when a key is not in the parent; NULL keys count as missing."""
    keys, parents = _lists(key, parent_key)
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    lost = found.join(_parent_keys(parent, keys, parents), keys, "left_anti").agg(F.sum("row_count")).first()[0]
    if lost:
        raise GateError(message, {",".join(keys): lost})
    return df
