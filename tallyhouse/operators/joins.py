"""Joins that keep a large fact table whole when one key holds much of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "inner", salts: int | None = None, hot: Sequence[int] | None = None) -> DataFrame:
    """Join a fact to a table with one row per key.

    Spark broadcasts the dimension when its measured size is below the threshold, and
    else the adaptive skew join splits a hot key. `salts` spreads every key over that
    many tasks without relying on either, at the price of a dimension that many times
    larger; with `hot`, the keys named by `windows.hot_keys`, only these are spread and
    only their dimension rows repeated. The salt comes from the row itself, so a retried
    task gives the same one.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if not salts or salts < 2 or hot is not None and not hot:
        return fact.join(dim, keys, how)
    if how not in ("inner", "left", "left_semi"):
        raise ValueError("a salted lookup is inner, left or left_semi")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salts)).cast("int")
    copies = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        # Hashes are of the fact's key types, which the dimension's may differ from.
        spread = F.xxhash64(*[F.col(k).cast(fact.schema[k].dataType) for k in keys]).isin(list(hot))
        salt, copies = F.when(F.xxhash64(*keys).isin(list(hot)), salt).otherwise(0), F.when(spread, copies).otherwise(F.array(F.lit(0)))
    return fact.withColumn("_salt", salt).join(dim.withColumn("_salt", F.explode(copies)), [*keys, "_salt"], how).drop("_salt")


def latest_per_key(df: DataFrame, key, value: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The value columns of the last row per key in `order`.

    An aggregate, so a hot key is reduced to one row per task before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    last = F.max_by(F.struct(*value), F.struct(*order))
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def first_per_key(df: DataFrame, key, value: Sequence[str], order: Sequence[str]) -> DataFrame:
    """As `latest_per_key`, for the first row."""
    keys = [key] if isinstance(key, str) else list(key)
    first = F.min_by(F.struct(*value), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*keys, "_first.*")


# A key with more spans than these is cut by time.
MANY_SPANS = 64


def in_interval(df: DataFrame, spans: DataFrame, on, at: str, start: str, end: str, how: str = "left", width: str = "month", many: int = MANY_SPANS) -> DataFrame:
    """Equi-join plus `start <= at < end`; an open end is NULL.

    Within a key every row would meet every span. So the spans of a key that has more than `many` are laid out over the
    `width`s (month, day, hour) of time they touch, as far as `df` reaches, and the bucket joins the equality; a row then meets
    the spans of its bucket. Other keys are one bucket. The result does not depend on either.
    """
    keys = [on] if isinstance(on, str) else list(on)
    named = [F.col(k).alias(f"_k_{k}") for k in keys]
    right = spans.select(*named, *[c for c in spans.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    busy = spans.groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > many).drop("_n").withColumn("_busy", F.lit(True))

    def cut(time: Column) -> Column:
        return F.date_trunc(width, time.cast("timestamp"))

    reach = df.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    lo, hi = reach.select("lo").scalar(), reach.select("hi").scalar()
    first, last = F.greatest(F.col(start), lo), F.coalesce(F.least(F.col(end), hi), hi)
    touched = F.when(first <= last, F.sequence(cut(first), cut(last), F.expr(f"interval 1 {width}")))
    whole = F.lit("1970-01-01").cast("timestamp")
    right = right.join(busy, [f"_k_{k}" for k in keys], "left")
    right = right.withColumn("_bucket", F.explode(F.when(F.col("_busy"), touched).otherwise(F.array(whole)))).drop("_busy")
    left = df.join(busy, same, "left").drop(*[f"_k_{k}" for k in keys])
    left = left.withColumn("_of", F.when(F.col("_busy"), cut(F.col(at))).otherwise(whole)).drop("_busy")
    cond = same & (F.col("_of") == F.col("_bucket")) & (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    return left.join(right, cond, how).drop(*[f"_k_{k}" for k in keys], "_of", "_bucket")


def carried_forward(fact: DataFrame, spans: DataFrame, key: str, at: str, start: str, end: str, width: str = "month") -> DataFrame:
    """As `in_interval` with how="left", for spans of a key that don't overlap: each row gets the span that began last, if that has not ended.

    Rows and spans are merged into one stream per key and `width` of time, in which the last span is carried forward; a key's
    buckets begin with what the earlier ones end with. So a hot key is spread over its buckets, nothing is laid out over the time it
    lasts, and rows are shuffled once, whatever the keys are like. Columns are those of both, without the span's key.
    """
    def bucket(time: str) -> Column:
        return F.date_trunc(width, F.col(time).cast("timestamp"))

    values = [c for c in spans.columns if c != key]
    # Of spans that begin together all but one have no length: the one that ends last counts.
    span = F.struct(F.col(start).alias("since"), F.col(end).isNull().alias("open"), F.col(end).alias("until"), F.struct(*values).alias("values"))
    begun = spans.where(F.col(key).isNotNull() & F.col(start).isNotNull()).select(F.col(key).alias("_key"), bucket(start).alias("_bucket"), F.col(start).alias("_at"), span.alias("_span"))
    rows = fact.select(F.col(key).alias("_key"), bucket(at).alias("_bucket"), F.col(at).alias("_at"), F.struct(*fact.columns).alias("_row"))
    no_span = F.lit(None).cast(begun.schema["_span"].dataType)
    # A bucket of a key is one row here, however many rows it has.
    buckets = rows.select("_key", "_bucket", no_span.alias("_span")).unionByName(begun.select("_key", "_bucket", "_span")).groupBy("_key", "_bucket").agg(F.max("_span").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    opening = buckets.withColumn("_span", F.last("_last", ignorenulls=True).over(before)).where(F.col("_span").isNotNull())
    no_row = F.lit(None).cast(rows.schema["_row"].dataType)
    merged = (
        rows.select("_key", "_bucket", "_at", F.lit(2).alias("_kind"), no_span.alias("_span"), "_row")
        .unionByName(begun.select("_key", "_bucket", "_at", F.lit(1).alias("_kind"), "_span", no_row.alias("_row")))
        .unionByName(opening.select("_key", "_bucket", F.col("_span.since").alias("_at"), F.lit(0).alias("_kind"), "_span", no_row.alias("_row")))
    )
    sofar = Window.partitionBy("_key", "_bucket").orderBy("_at", "_kind", "_span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = merged.withColumn("_span", F.last("_span", ignorenulls=True).over(sofar)).where(F.col("_kind") == 2)
    valid = F.col("_span.open") | (F.col("_at") < F.col("_span.until"))
    return carried.select("_row.*", *[F.when(valid, F.col(f"_span.values.{c}")).alias(c) for c in values])
