"""Type-2 dimensions: every change of a tracked attribute opens a new version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import dedup, joins, windows
from tallyhouse.session import settle

VERSION_COLUMNS = ("start_date", "end_date", "is_current", "version_number")


def init(src: DataFrame, as_of: Column | str) -> DataFrame:
    """Version 1 of every row."""
    start = F.col(as_of) if isinstance(as_of, str) else as_of
    kept = [c for c in src.columns if c != as_of] if isinstance(as_of, str) else src.columns
    return src.select(
        *kept,
        start.cast("timestamp_ntz").alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
    )


def merge(
    dim: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: Sequence[str],
    at: Column | str,
    ties: Sequence[str] = (),
    null_safe: bool = True,
    width: str | None = None,
    hot_rows: int = windows.HOT_ROWS,
) -> DataFrame:
    """The dimension after `incoming`, which may hold several states of one key.

    States are applied in the order of `at` (a column, or one time for all), ties by
    `ties`; a state that equals the one before it in the tracked columns changes
    nothing, so other attributes of the open version stay as they were. A state older
    than the open version counts from that version's start. `null_safe=False` compares
    with plain `!=`, where NULL is never a change; it takes the last state per key.
    `width` ("month", "hour") cuts the history of a key with more than `hot_rows` states
    into pieces, see `windows.neighbours`.

    Closed versions and keys without news are passed on unshuffled when the batch is
    small enough to be broadcast.
    """
    attrs = [c for c in dim.columns if c not in VERSION_COLUMNS]
    when = (F.col(at) if isinstance(at, str) else at).cast("timestamp_ntz")
    news = incoming.withColumn("_at", when)
    if not null_safe:
        news = dedup.keep_latest(news, key, [F.col("_at").desc(), *[F.col(t).desc() for t in ties]])
    order = [f"_t{i}" for i in range(len(ties))]
    news = news.select(*attrs, "_at", *[F.col(t).alias(o) for t, o in zip(ties, order, strict=True)])

    batch_keys = news.select(key)
    open_rows = dim.where(F.col("is_current"))
    touched = open_rows.join(batch_keys, key, "left_semi")
    untouched = open_rows.join(batch_keys, key, "left_anti")

    floors = touched.select(key, F.col("start_date").alias("_floor"))
    news = news.join(floors, key, "left").withColumn("_at", F.greatest("_at", "_floor")).drop("_floor")
    types = dict(news.dtypes)
    base = touched.select(
        *attrs, F.col("start_date").alias("_at"), *[F.lit(None).cast(types[o]).alias(o) for o in order], F.lit(0).alias("_new"), F.col("version_number").alias("_step")
    )
    states = base.unionByName(news.withColumns({"_new": F.lit(1), "_step": F.lit(1)})).withColumn("_one", F.lit(1))

    bucket = None
    if width:
        # The stored state comes first, then states without a time.
        bucket = F.when(F.col("_new") == 0, F.lit(-(1 << 62))).when(F.col("_at").isNull(), F.lit(-(1 << 61))).otherwise(F.unix_micros(F.date_trunc(width, F.col("_at").cast("timestamp"))))
    sequence = ["_new", "_at", *order]
    seen = windows.neighbours(states, [key], sequence, lag=[*tracked, "_one"], bucket=bucket, hot_rows=hot_rows)
    changed = F.col("prev__one").isNull()
    for c in tracked:
        differs = ~F.col(c).eqNullSafe(F.col(f"prev_{c}")) if null_safe else F.coalesce(F.col(c) != F.col(f"prev_{c}"), F.lit(False))
        changed = changed | differs
    versions = seen.where(changed).select(*attrs, "_at", *order, "_new", "_step")
    if width:
        # Finding and cutting hot keys reads the input again; the changes are few, so they are written once here.
        versions = settle(versions, "versions")
    dated = windows.neighbours(versions, [key], sequence, lead=["_at"], running=["_step"], bucket=bucket, hot_rows=hot_rows)
    fresh = dated.select(
        *attrs,
        F.col("_at").alias("start_date"),
        F.col("next__at").alias("end_date"),
        F.col("next__at").isNull().alias("is_current"),
        F.col("run__step").cast("int").alias("version_number"),
    )
    closed = dim.where(~F.col("is_current"))
    return closed.unionByName(untouched).unionByName(fresh).select(*dim.columns)


def build(
    incoming: DataFrame, key: str, tracked: Sequence[str], at: str, ties: Sequence[str] = (), width: str | None = None, hot_rows: int = windows.HOT_ROWS
) -> DataFrame:
    """History from a change feed alone."""
    attrs = [c for c in incoming.columns if c != at and c not in ties]
    empty = init(incoming.select(*attrs), F.lit(None)).where(F.lit(False))
    return merge(empty, incoming, key, tracked, at, ties, width=width, hot_rows=hot_rows)


def splice(
    dim: DataFrame,
    incoming: DataFrame,
    known: DataFrame | None,
    seen: DataFrame,
    key: str,
    tracked: Sequence[str],
    at: str,
    ties: Sequence[str] = (),
    width: str | None = None,
    hot_rows: int = windows.HOT_ROWS,
) -> DataFrame:
    """As `merge`, but a state that comes late takes the place its time gives it, whatever order states come in.

    `known` are all states that the dimension was made from, also those that changed nothing, and `seen` the time of the last one
    per key, as `at`. A key with news up to that time is built again from all its states: the interval that a late state falls in
    is split, later versions are renumbered, and neighbours that have become equal are one. Only such keys read `known`; all others
    are merged at their open version.
    """
    last = seen.select(key, F.col(at).alias("_seen"))
    # Times are compared with NULL lowest, as they are ordered.
    order = lambda c: F.struct(F.col(c).isNotNull(), F.col(c))
    firsts = incoming.groupBy(key).agg(F.min(order(at)).alias("_first")).join(last, key)
    late = settle(firsts.where(F.col("_first") <= order("_seen")).select(key), "late-keys")
    if known is None or late.isEmpty():
        return merge(dim, incoming, key, tracked, at, ties, width=width, hot_rows=hot_rows)
    states = known.select(*incoming.columns).unionByName(incoming).join(late, key, "left_semi")
    again = build(states, key, tracked, at, ties, width=width, hot_rows=hot_rows)
    rest = merge(dim.join(late, key, "left_anti"), incoming.join(late, key, "left_anti"), key, tracked, at, ties, width=width, hot_rows=hot_rows)
    return rest.unionByName(again)


def current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def with_id(dim: DataFrame, key: str, out: str) -> DataFrame:
    """Surrogate id of a version."""
    return dim.withColumn(out, S.surrogate(key, "version_number"))


def as_of(fact: DataFrame, dim: DataFrame, key: str, at: str, columns: Sequence[str], how: str = "left", width: str = "month") -> DataFrame:
    """Attributes that were valid at the time of each fact row, NULL or with how="inner" no row where there was no version.

    Versions of a key don't overlap, so the last one is carried forward, see `joins.carried_forward`."""
    if how not in ("left", "inner"):
        raise ValueError("how is left or inner")
    spans = dim.select(key, "start_date", "end_date", *columns)
    found = joins.carried_forward(fact, spans, key, at, "start_date", "end_date", width)
    return (found if how == "left" else found.where(F.col("start_date").isNotNull())).drop("start_date", "end_date")


def check(dim: DataFrame, key: str, width: str | None = None) -> DataFrame:
    """Number of breaches per integrity rule: one open version, no gap or overlap, versions 1..n.

    `dim` is read several times, so it should be a stored table.
    """
    bucket = F.date_trunc(width, F.col("start_date").cast("timestamp")) if width else None
    rows = dim.select(key, "start_date", "end_date", "is_current", "version_number")
    seen = windows.neighbours(rows, [key], ["start_date", "version_number"], lag=["version_number"], lead=["start_date"], bucket=bucket)
    follow = F.col("next_start_date")
    steps = seen.agg(
        F.count_if(F.col("end_date").isNotNull() & follow.isNotNull() & (F.col("end_date") > follow)).alias("overlap"),
        F.count_if(follow.isNotNull() & (F.col("end_date").isNull() | (F.col("end_date") < follow))).alias("gap"),
        F.count_if(F.col("version_number") != F.coalesce(F.col("prev_version_number"), F.lit(0)) + 1).alias("version_jump"),
        F.count_if(F.col("is_current") != F.col("end_date").isNull()).alias("open_flag"),
    )
    per_key = rows.groupBy(key).agg(F.count_if("is_current").alias("n"))
    currents = per_key.agg(F.count_if(F.col("n") != 1).alias("n"))
    named = [F.struct(F.lit(c).alias("rule"), F.col(c).alias("breaches")) for c in ("overlap", "gap", "version_jump", "open_flag")]
    return steps.select(F.inline(F.array(*named))).unionByName(currents.select(F.lit("one_current").alias("rule"), F.col("n").alias("breaches")))
