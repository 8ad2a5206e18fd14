"""Dimensions without history: dates, games, locations, machines, devices.

Surrogate ids are hashes of the natural key, so every run and every retried task
gives a row the same id and no counter has to be shared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import presets as P
from tallyhouse.functions import scalars as S
from tallyhouse.operators import merge


def time_id(col: Column | str) -> Column:
    """Readable date key, 20240131."""
    return F.date_format(F.col(col) if isinstance(col, str) else col, "yyyyMMdd").cast("int")


def date_parts(dates: DataFrame, pad: bool = False) -> DataFrame:
    """Date rows from a table with the column `full_date`."""
    d = F.col("full_date")
    return dates.select(
        time_id(d).alias("time_id"),
        d,
        S.day_name(d, pad).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_month"),
        S.month_name(d, pad).alias("month_name"),
        F.month(d).alias("month_number"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        S.is_weekend(d).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def date_dim(df: DataFrame, at: str, pad: bool = False) -> DataFrame:
    """One row per calendar date on which `df` has an event."""
    dates = df.select(F.to_date(at).alias("full_date")).where(F.col("full_date").isNotNull()).distinct()
    return date_parts(dates, pad)


def date_dim_range(spark: SparkSession, first: str, last: str, pad: bool = False) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("full_date"))
    return date_parts(days, pad)


def date_dim_span(df: DataFrame, at: str, pad: bool = False) -> DataFrame:
    """Every date from the first to the last event of `df`."""
    ends = df.agg(F.to_date(F.min(at)).alias("a"), F.to_date(F.max(at)).alias("b"))
    return date_parts(ends.select(F.explode(F.sequence("a", "b")).alias("full_date")), pad)


def ensure_dates(dim: DataFrame, df: DataFrame, at: str) -> DataFrame:
    """The date dimension with the dates of arriving rows added, in one set-based step."""
    return merge.insert_absent(dim, date_dim(df, at), "full_date")


def dim_type0(src: DataFrame, key: str, attrs: Sequence[str], dim: DataFrame | None = None) -> DataFrame:
    """First seen row per key stays: insert if absent. Of rows that repeat a key the least one counts, by an aggregate, so rows are ordered by key at most."""
    least = F.min(F.struct(*[F.struct(F.col(a).isNull().alias("n"), F.col(a).alias("v")).alias(a) for a in attrs])).alias("row")
    rows = src.groupBy(key).agg(least).select(key, *[F.col(f"row.{a}.v").alias(a) for a in attrs])
    return rows if dim is None else merge.insert_absent(dim, rows, key)


def dim_flagged(src: DataFrame, key: str, attrs: Sequence[str], flag: Column, name: str = "is_active", dim: DataFrame | None = None) -> DataFrame:
    return dim_type0(src.withColumn(name, flag), key, [*attrs, name], dim)


def game_dim(game: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    src = game.select(
        S.surrogate("game_name").alias("game_id"), "game_name", F.col("type").alias("game_type"), "min_bet", "max_bet", F.lit(True).alias("is_active")
    )
    return dim_type0(src, "game_name", [c for c in src.columns if c != "game_name"], dim)


def location_dim(location: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    src = location.select(
        S.surrogate("location_code").alias("location_id"), "location_code", F.col("name").alias("location_name"), "city", "state", "country", F.lit(True).alias("is_active")
    )
    return dim_type0(src, "location_code", [c for c in src.columns if c != "location_code"], dim)


def slot_machine_dim(machine: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    src = machine.withColumn("slot_machine_id", S.surrogate("machine_code"))
    return dim_flagged(src, "machine_code", ["slot_machine_id", "model"], F.col("status") == P.MACHINE_ACTIVE, dim=dim)


def device_dim(logins: DataFrame, dim: DataFrame | None = None, device: str = "device") -> DataFrame:
    """One row per device type and text; the three flags exclude each other."""
    kind = S.device_class(device)
    src = logins.select(kind.alias("device_type"), F.col(device).alias("device_model")).distinct()
    rows = src.select(
        S.surrogate("device_type", "device_model").alias("device_id"),
        "device_type",
        "device_model",
        F.lit(None).cast("string").alias("operating_system"),
        F.lit(None).cast("string").alias("browser"),
        (F.col("device_type") == "Mobile").alias("is_mobile"),
        (F.col("device_type") == "Tablet").alias("is_tablet"),
        (F.col("device_type") == "Desktop").alias("is_desktop"),
    )
    if dim is None:
        return rows
    # A device text may be NULL, which an equi-join would take for new each time.
    return merge.insert_absent(dim, rows, "device_id")


def player_rows(player: DataFrame, as_of: Column, tiers=P.TIERS_WAREHOUSE, bands=P.BANDS_WAREHOUSE, bands_default=P.BANDS_WAREHOUSE_DEFAULT) -> DataFrame:
    """Attributes of the player dimension, before versions."""
    return player.select(
        F.col("email").alias("player_key"),
        "first_name",
        "last_name",
        S.age_band("dob", as_of, bands, bands_default).alias("age_group"),
        F.to_date("registration_date").alias("registration_date"),
        S.tier("loyalty_points", tiers).alias("loyalty_tier"),
    )


def staff_rows(staff: DataFrame) -> DataFrame:
    """Attributes of the staff dimension, before versions."""
    return staff.select(
        F.col("staff_email").alias("staff_key"),
        "first_name",
        "last_name",
        "position",
        S.department("position").alias("department"),
        "hire_date",
        F.lit(True).alias("is_active"),
    )


PLAYER_TRACKED = ("first_name", "last_name", "loyalty_tier")
STAFF_TRACKED = ("first_name", "last_name", "position")
