"""Fact tables of plays and transactions.

Everything known per game (table, place, staff) and per player (version, device) is
brought to one row per game and one row per player first, so the fact passes through
two joins instead of ten, and no join can multiply its rows unless fanout="all" asks
for that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, joins, merge, windows


def one_table_per_game(table_game: DataFrame) -> DataFrame:
    """The table with the lowest code, with its location."""
    return joins.first_per_key(table_game, "game_name", ["table_code", "location_code"], ["table_code", "location_code"])


def active_shifts(shifts: DataFrame, dim_staff: DataFrame) -> DataFrame:
    """(table_code, staff_key) of every shift of staff who are active and current."""
    staff = dim_staff.where(F.col("is_active") & F.col("is_current")).select("staff_key")
    return shifts.select("table_code", F.col("staff_email").alias("staff_key")).join(staff, "staff_key", "left_semi")


def one_staff_per_table(shifts: DataFrame, dim_staff: DataFrame) -> DataFrame:
    return active_shifts(shifts, dim_staff).groupBy("table_code").agg(F.min("staff_key").alias("staff_key"))


def all_tables_and_shifts(table_game: DataFrame, shifts: DataFrame, dim_staff: DataFrame) -> DataFrame:
    """Every table of a game with every shift of the table; an inactive one's shift counts with no staff."""
    staff = dim_staff.where(F.col("is_active") & F.col("is_current")).select("staff_key", F.col("staff_key").alias("staff_email"))
    worked = shifts.select("table_code", "staff_email").join(staff, "staff_email", "left").select("table_code", "staff_key")
    return table_game.select("game_name", "table_code", "location_code").join(worked, "table_code", "left")


def staff_on_shift(plays: DataFrame, shifts: DataFrame, at: str = "play_time") -> DataFrame:
    """Adds `staff_email` of the shift at the play's table during the play, lowest key first.

    `plays` needs a table_code and a unique `play_id`.
    """
    spans = shifts.select("table_code", "shift_start", "shift_end", "staff_email")
    found = joins.in_interval(plays.select("play_id", "table_code", at), spans, "table_code", at, "shift_start", "shift_end", "inner", width="day")
    picked = found.groupBy("play_id").agg(F.min("staff_email").alias("staff_email"))
    return plays.join(picked, "play_id", "left")


def latest_device(logins: DataFrame) -> DataFrame:
    """Device of the last login per player, ties by login id."""
    last = joins.latest_per_key(logins, "player_email", ["device"], ["login_time", "login_id"])
    kind = S.device_class("device")
    return last.select("player_email", kind.alias("device_type"), F.col("device").alias("device_model"), S.surrogate(kind, "device").alias("device_id"))


def machine_of_play(slot_play: DataFrame, slot_machine: DataFrame) -> DataFrame:
    """One machine per player and second, with its location."""
    used = slot_play.groupBy("player_email", "play_time").agg(F.min("machine_code").alias("machine_code"))
    return used.join(slot_machine.select("machine_code", F.col("location_code").alias("machine_location")), "machine_code", "left")


def gaming_fact(
    plays: DataFrame,
    dim_player: DataFrame,
    dim_game: DataFrame,
    table_game: DataFrame,
    shifts: DataFrame,
    dim_staff: DataFrame,
    dim_location: DataFrame | None = None,
    slot_play: DataFrame | None = None,
    slot_machine: DataFrame | None = None,
    logins: DataFrame | None = None,
    fanout: str = "one",
    existing: DataFrame | None = None,
    grain: str = "natural",
    session: str | None = "hour",
    salts: int | None = None,
) -> DataFrame:
    """One row per play with the keys of its dimensions and its net result.

    Plays of unknown players or games are dropped (`referential.fk_gate` refuses them
    instead). fanout="all" repeats a play for every table of its game and every shift
    of the table. `existing` makes the build an idempotent append, by (player, game,
    time) or with grain="day" by (player, game, date). `session` adds the minutes since
    the player's previous play; it is the bucket width that bounds a task.
    """
    if session:
        plays = windows.minutes_since_previous(plays, ["player_email"], "play_time", ["game_name", "amount_bet", "amount_won"], width=session)
    else:
        plays = plays.withColumn("session_duration_minutes", F.lit(None).cast("int"))

    player_side = dim_player.where(F.col("is_current")).select(F.col("player_key").alias("player_email"), S.surrogate("player_key", "version_number").alias("player_id"))
    if logins is not None:
        player_side = player_side.join(latest_device(logins), "player_email", "left")
    else:
        player_side = player_side.withColumns({"device_type": F.lit(None).cast("string"), "device_model": F.lit(None).cast("string"), "device_id": F.lit(None).cast("long")})

    games = dim_game.select("game_name", "game_id")
    if fanout == "one":
        place = one_table_per_game(table_game).join(one_staff_per_table(shifts, dim_staff), "table_code", "left")
    elif fanout == "all":
        place = all_tables_and_shifts(table_game, shifts, dim_staff)
    else:
        raise ValueError("fanout is one or all")
    game_side = games.join(place, "game_name", "left")

    rows = joins.lookup(plays, player_side, "player_email", salts=salts)
    rows = joins.lookup(rows, game_side, "game_name", salts=salts)
    if slot_play is not None:
        rows = rows.join(machine_of_play(slot_play, slot_machine), ["player_email", "play_time"], "left")
        rows = rows.withColumn("location_code", F.coalesce("location_code", "machine_location"))
    else:
        rows = rows.withColumn("machine_code", F.lit(None).cast("string"))
    if dim_location is not None:
        known = dim_location.select("location_code", F.col("location_code").alias("_known"))
        rows = rows.join(known, "location_code", "left").withColumn("location_code", F.col("_known"))

    fact = rows.select(
        dimensions.time_id(F.to_date("play_time")).alias("time_id"),
        F.to_date("play_time").alias("full_date"),
        "play_time",
        "player_id",
        F.col("player_email").alias("player_key"),
        "game_id",
        "game_name",
        "table_code",
        S.surrogate("location_code").alias("location_id"),
        "location_code",
        "machine_code",
        "staff_key",
        "device_id",
        "device_type",
        "device_model",
        F.col("amount_bet").alias("bet_amount"),
        F.col("amount_won").alias("win_amount"),
        (F.coalesce("amount_won", F.lit(0)) - F.coalesce("amount_bet", F.lit(0))).cast(S.MONEY).alias("net_result"),
        "session_duration_minutes",
        F.lit(1).alias("plays_count"),
    )
    if existing is None:
        return fact
    keys = {"natural": ["player_key", "game_name", "play_time"], "day": ["player_key", "game_name", "full_date"]}[grain]
    return merge.append_new(existing, fact, keys)


def gaming_fact_one_place(plays: DataFrame, dim_player: DataFrame, dim_game: DataFrame, table_game: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Smaller variant without machine, staff and device; a play without a place is dropped."""
    game_side = dim_game.select("game_name", "game_id").join(one_table_per_game(table_game), "game_name")
    game_side = game_side.join(dim_location.select("location_code", "location_id"), "location_code")
    player_side = dim_player.where(F.col("is_current")).select(F.col("player_key").alias("player_email"))
    rows = windows.minutes_since_previous(plays, ["player_email"], "play_time", ["game_name", "amount_bet", "amount_won"])
    rows = joins.lookup(joins.lookup(rows, player_side, "player_email"), game_side, "game_name")
    return rows.select(
        F.to_date("play_time").alias("full_date"),
        "play_time",
        F.col("player_email").alias("player_key"),
        "game_name",
        "location_code",
        F.col("amount_bet").alias("bet_amount"),
        F.col("amount_won").alias("win_amount"),
        (F.col("amount_won") - F.col("amount_bet")).cast(S.MONEY).alias("net_result"),
        "session_duration_minutes",
    )


def fanout_totals(plays: DataFrame, dim_game: DataFrame, table_game: DataFrame, shifts: DataFrame) -> DataFrame:
    """Totals per game and location of the fact that fanout="all" would build.

    Plays are summed per game, and (table, shift) pairs counted per game and location,
    before the two meet; no repeated row is ever made.
    """
    played = plays.groupBy("game_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("amount_bet", F.lit(0))).alias("bet"), F.sum(F.coalesce("amount_won", F.lit(0))).alias("won")
    )
    worked = shifts.groupBy("table_code").agg(F.count(F.lit(1)).alias("shifts"))
    copies = table_game.join(worked, "table_code", "left").groupBy("game_name", "location_code").agg(F.sum(F.coalesce("shifts", F.lit(1))).alias("copies"))
    spread = dim_game.select("game_name").join(played, "game_name").join(copies, "game_name", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    return spread.select(
        "game_name",
        "location_code",
        (F.col("n") * F.col("copies")).alias("total_plays"),
        (F.col("bet") * F.col("copies")).alias("total_bets"),
        (F.col("won") * F.col("copies")).alias("total_wins"),
    )


def txn_fact(
    transactions: DataFrame,
    dim_player: DataFrame,
    table_game: DataFrame,
    shifts: DataFrame,
    dim_staff: DataFrame,
    fanout: str = "one",
    existing: DataFrame | None = None,
    grain: str = "natural",
    salts: int | None = None,
) -> DataFrame:
    """One row per transaction with place, staff and loyalty points; arguments as `gaming_fact`."""
    player_side = dim_player.where(F.col("is_current")).select(F.col("player_key").alias("player_email"), S.surrogate("player_key", "version_number").alias("player_id"))
    if fanout == "one":
        place = one_table_per_game(table_game).join(one_staff_per_table(shifts, dim_staff), "table_code", "left")
    else:
        place = all_tables_and_shifts(table_game, shifts, dim_staff)
    rows = joins.lookup(transactions, player_side, "player_email", salts=salts)
    rows = rows.join(place.select("game_name", "location_code", "staff_key"), "game_name", "left")
    fact = rows.select(
        "transaction_code",
        dimensions.time_id(F.to_date("transaction_time")).alias("time_id"),
        F.to_date("transaction_time").alias("full_date"),
        "transaction_time",
        "player_id",
        F.col("player_email").alias("player_key"),
        "location_code",
        "staff_key",
        "transaction_type",
        "amount",
        S.points_earned("transaction_type", "amount").alias("loyalty_points_earned"),
        S.points_redeemed("transaction_type", "amount").alias("loyalty_points_redeemed"),
    )
    if existing is None:
        return fact
    keys = {"natural": ["transaction_code"], "day": ["full_date", "player_key", "transaction_type", "amount"]}[grain]
    return merge.append_new(existing, fact, keys)
