"""Order-dependent measures that do not put a whole key, or a whole table, in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.session import settle


# A window over so many rows of one key still sorts within a task's memory.
HOT_ROWS = 1_000_000


def neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    lag: Sequence[str] = (),
    lead: Sequence[str] = (),
    running: Sequence[str] = (),
    bucket: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds `prev_<c>`, `next_<c>` and `run_<c>` (sum up to this row) per key in `order`.

    A key with more than `hot_rows` rows is cut by `bucket`, which must never fall as
    `order` rises, NULL first (the hour of the time, say), so that no task holds all of
    it; the others, and all keys without a bucket, are one window each. Both ways give
    the same result, also where keys, order columns or values are NULL. Which keys are hot is
    a job of its own, see `hot_keys`.
    """
    plain = (list(keys), order, lag, lead, running)
    if bucket is None:
        return _within(df, *plain)
    if hot_rows <= 0:
        return _cut(df, bucket, *plain)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return _cut(df, bucket, *plain)
    if not hot:
        return _within(df, *plain)
    is_hot = is_key(keys, hot)
    return _within(df.where(~is_hot), *plain).unionByName(_cut(df.where(is_hot), bucket, *plain))


# Keys that a sketch of frequent keys tracks, and hot ones that are named at most.
TRACKED = 8192
NAMED = 1024


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int) -> list[int] | None:
    """Hashes of the keys with more than `rows` rows, or None if there may be more than `NAMED`.

    From a sketch of frequent items that every task makes of its rows and that are merged, so keys are neither shuffled nor counted
    one by one. A count may be too high by the rows divided by about `TRACKED`, so another key may be named, but none that is hot is
    missed unless hot keys are fewer rows than that; the hash may name a second key too. Callers treat a named key another way with
    the same result.
    """
    named = df.select(F.xxhash64(*keys).alias("h")).agg(F.call_function("approx_top_k", F.col("h"), F.lit(NAMED), F.lit(TRACKED)).alias("top")).first()["top"] or []
    hot = [r["item"] for r in named if r["count"] > rows]
    return None if len(hot) == NAMED else hot


def is_key(keys: Sequence[str], hashes: Sequence[int]) -> Column:
    return F.xxhash64(*keys).isin(list(hashes))


def _same_keys(keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return same


def _cut(df: DataFrame, bucket: Column, keys, order, lag, lead, running) -> DataFrame:
    """Windows per key and bucket. What crosses bucket borders is the first row, the last
    row and the sum of each bucket, handed over on one row per key and bucket."""
    cut = df.withColumn("_b", bucket)
    at, lead_column = F.struct(*order), list(order)[:1]
    aggs = []
    # The edge of the leading order column itself is a plain max or min, which hashes;
    # that of other columns has to carry a row along, for which Spark sorts.
    if lag:
        last = F.struct(F.max(order[0]).alias(order[0])) if list(lag) == lead_column else F.max_by(F.struct(*lag), at)
        aggs.append(last.alias("_last"))
    if lead:
        first = F.struct(F.min(order[0]).alias(order[0])) if list(lead) == lead_column else F.min_by(F.struct(*lead), at)
        aggs.append(first.alias("_first"))
    aggs += [F.sum(c).alias(f"_sum_{c}") for c in running]
    edges = cut.groupBy(*keys, "_b").agg(*aggs)
    across = Window.partitionBy(*keys).orderBy("_b")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = [*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_b").alias("_kb")]
    if lag:
        carried.append(F.lag("_last").over(across).alias("_last"))
    if lead:
        carried.append(F.lead("_first").over(across).alias("_first"))
    carried += [F.sum(f"_sum_{c}").over(before).alias(f"_sum_{c}") for c in running]
    same = F.col("_b").eqNullSafe(F.col("_kb")) & _same_keys(keys)
    joined = _within(cut.join(edges.select(*carried), same, "left"), [*keys, "_b"], order, lag, lead, running)
    out = [F.col(c) for c in df.columns]
    edge = Window.partitionBy(*keys, "_b").orderBy(*order)
    if lag:
        first = F.row_number().over(edge) == 1
        joined = joined.withColumn("_is_first", first)
        out += [F.when(F.col("_is_first"), F.col(f"_last.{c}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}") for c in lag]
    if lead:
        last = F.lead(F.lit(1)).over(edge).isNull()
        joined = joined.withColumn("_is_last", last)
        out += [F.when(F.col("_is_last"), F.col(f"_first.{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}") for c in lead]
    # As with one window: NULL only while no value has come yet.
    out += [F.coalesce(F.col(f"run_{c}") + F.col(f"_sum_{c}"), F.col(f"run_{c}"), F.col(f"_sum_{c}")).alias(f"run_{c}") for c in running]
    return joined.select(*out)


def _within(df, keys, order, lag, lead, running) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy(*order)
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    new = {f"prev_{c}": F.lag(c).over(ordered) for c in lag}
    new |= {f"next_{c}": F.lead(c).over(ordered) for c in lead}
    new |= {f"run_{c}": F.sum(c).over(upto) for c in running}
    return df.withColumns(new)


def minutes_since_previous(df: DataFrame, keys: Sequence[str], at: str, order: Sequence[str] = (), out: str = "session_duration_minutes", width: str | None = "hour", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Minutes since the previous event of the key, NULL for the first; ties by `order`."""
    bucket = F.date_trunc(width, F.col(at).cast("timestamp")) if width else None
    stepped = neighbours(df, keys, [at, *order], lag=[at], bucket=bucket, hot_rows=hot_rows)
    return stepped.withColumn(out, S.minutes_between(at, f"prev_{at}")).drop(f"prev_{at}")


# -- over periods: one row per period, so the row count is bounded by the calendar


def running_total(df: DataFrame, values: Sequence[str], order: Sequence[str], partition: Sequence[str] = ()) -> DataFrame:
    """`running_<c>` over rows already aggregated to one per period (and partition)."""
    window = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({f"running_{c}": F.sum(c).over(window) for c in values})


def growth(df: DataFrame, value: str, order: str, steps: dict[str, int], partition: Sequence[str] = ()) -> DataFrame:
    """Previous value and relative growth per step, over a gap-free period spine.

    `steps` names the comparisons: {"mom": 1, "yoy": 12} adds `mom_previous`, `mom_growth`, ...
    """
    window = Window.partitionBy(*partition).orderBy(order)
    for name, n in steps.items():
        df = df.withColumn(f"{name}_previous", F.lag(value, n).over(window))
        previous = F.col(f"{name}_previous")
        df = df.withColumn(f"{name}_growth", S.ratio(F.col(value) - previous, previous))
    return df


def month_spine(df: DataFrame, at: str) -> DataFrame:
    """Every month from the first to the last of `df`, as its first day."""
    ends = df.agg(F.min(at).alias("a"), F.max(at).alias("b"))
    first, last = F.trunc("a", "month"), F.trunc("b", "month")
    return ends.select(F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("month"))


def first_seen(df: DataFrame, key, period: Column, out: str = "period") -> DataFrame:
    """New keys per period; their running sum is the cumulative distinct count."""
    keys = [key] if isinstance(key, str) else list(key)
    first = df.groupBy(*keys).agg(F.min(period).alias(out))
    return first.groupBy(out).agg(F.count(F.lit(1)).alias("new_keys"))


# -- over a whole table


def share_of_total(df: DataFrame, shares: Mapping[str, str]) -> DataFrame:
    """Adds the share of each column's total, named as given: {"value": "share"}.

    The totals are scalar subqueries, not a window in one task. `df` is settled, since
    rows and totals both read it.
    """
    df = settle(df, "share")
    return df.withColumns({out: S.ratio(F.col(value), df.agg(F.sum(value)).scalar()) for value, out in shares.items()})


# Distinct values summed in one task.
RANGE_ROWS = 1_000_000


def _ranges(df: DataFrame, value: str) -> int:
    """So many ranges that one holds about `RANGE_ROWS` distinct values, 8 at least."""
    distinct = df.agg(F.approx_count_distinct(value)).first()[0]
    return max(8, -(-distinct // RANGE_ROWS))


def descending_prefix(df: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """For every distinct value, from the highest down: rows and sum at it and above it.

    Columns: `value`, n, n_before, distinct_before, n_through, sum_through. Values are
    grouped first, so equal rows are one row however many there are; the values are cut
    at quantiles into ranges, each summed in its own task, and only the range totals
    go through one. `buckets` is the number of ranges; without it, it follows the number
    of distinct values.
    """
    buckets = buckets or _ranges(df, value)
    at = [i / buckets for i in range(1, buckets)]
    cuts = sorted(set(df.select(F.col(value).cast("double").alias("v")).approxQuantile("v", at, 0.2 / buckets))) if at else []
    values = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    values = values.withColumn("s", F.col(value) * F.col("n")).withColumn("_v", F.col(value).cast("double"))
    if cuts:
        ranges = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_v", outputCol="_b")
        values = ranges.transform(values)
    else:
        values = values.withColumn("_b", F.lit(0.0))
    totals = values.groupBy("_b").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"), F.count(F.lit(1)).alias("td"))
    above = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"o{c}") for c in ("tn", "ts", "td")])
    inside = Window.partitionBy("_b").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        values.join(offsets, "_b")
        .withColumns({"cn": F.sum("n").over(inside), "cs": F.sum("s").over(inside), "cd": F.count(F.lit(1)).over(inside)})
        .select(
            value,
            "n",
            (F.col("otn") + F.col("cn") - F.col("n")).alias("n_before"),
            (F.col("otd") + F.col("cd") - 1).alias("distinct_before"),
            (F.col("otn") + F.col("cn")).alias("n_through"),
            (F.col("ots") + F.col("cs")).alias("sum_through"),
        )
    )


def rank_desc(df: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """Adds `rank` and `dense_rank` over the whole table, highest value first.

    `df` is read several times: give it a settled table when it is costly.
    """
    places = descending_prefix(df, value, buckets).select(value, (F.col("n_before") + 1).alias("rank"), (F.col("distinct_before") + 1).alias("dense_rank"))
    return df.join(places, value)


def cumulative_share(df: DataFrame, value: str, buckets: int | None = None) -> DataFrame:
    """Adds the share of rows and of the total at or above each row's value.

    Rows of equal value share one result. `df` is settled first, since it is read several times.
    """
    df = settle(df, "cumulative")
    places = descending_prefix(df, value, buckets)
    total = df.agg(F.sum(value)).scalar()
    count = df.agg(F.count(value)).scalar()
    shares = places.select(value, S.ratio(F.col("n_through"), count).alias("row_share"), S.ratio(F.col("sum_through"), total).alias("value_share"))
    return df.join(shares, value)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, out: str = "place") -> DataFrame:
    """First n rows per group; each task keeps only n rows per group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)
