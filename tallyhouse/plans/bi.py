"""Dashboard measures: trends, funnels, shares, heatmaps, drill-downs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import presets as P
from tallyhouse.functions import scalars as S
from tallyhouse.operators import windows
from tallyhouse.session import settle

TOTAL = "decimal(22,2)"


def _n() -> Column:
    return F.count(F.lit(1))


def _sum(col: str | Column) -> Column:
    return F.sum(col).cast(TOTAL)


def _months(fact: DataFrame, *aggs: Column) -> DataFrame:
    """One row per month from the first to the last, months without rows included."""
    month = F.trunc("full_date", "month").alias("month")
    grouped = fact.groupBy(month).agg(*aggs)
    return windows.month_spine(grouped, "month").join(grouped, "month", "left")


# -- executive summary


def revenue_trend(fact: DataFrame) -> DataFrame:
    """Bets per month with running total and growth on the month and the year before."""
    months = _months(fact, S.total(fact, "bet_amount").alias("revenue")).withColumn("revenue", F.coalesce("revenue", F.lit(0)).cast(TOTAL))
    running = windows.running_total(months, ["revenue"], ["month"])
    return windows.growth(running, "revenue", "month", {"mom": 1, "yoy": 12})


def cumulative_players(fact: DataFrame) -> DataFrame:
    """New players per month and all players seen so far."""
    first = windows.first_seen(fact, "player_key", F.trunc("full_date", "month"), "month")
    months = windows.month_spine(fact, "full_date").join(first, "month", "left").withColumn("new_keys", F.coalesce("new_keys", F.lit(0)))
    return windows.running_total(months, ["new_keys"], ["month"]).select("month", F.col("new_keys").alias("new_players"), F.col("running_new_keys").alias("cumulative_players"))


def active_versus_registered(player: DataFrame, player_game: DataFrame) -> DataFrame:
    played = player_game.select("player_email").distinct().withColumn("active", F.lit(True))
    both = player.select(F.col("email").alias("player_email")).join(played, "player_email", "left")
    out = both.agg(_n().alias("registered_players"), F.count("active").alias("active_players"))
    return out.withColumn("active_share", S.ratio(F.col("active_players"), F.col("registered_players")))


def top_games(fact: DataFrame, k: int = 3) -> DataFrame:
    """Games with the highest bets, ties by name."""
    totals = fact.groupBy("game_name").agg(S.total(fact, "bet_amount").alias("revenue"), _n().alias("total_plays"))
    return totals.orderBy(F.desc_nulls_first("revenue"), "game_name").limit(k)


def revenue_per_player(fact: DataFrame) -> DataFrame:
    """Bets, players and bets per player by month, with growth."""
    per_player = fact.groupBy(F.trunc("full_date", "month").alias("month"), "player_key").agg(S.total(fact, "bet_amount").alias("bet"))
    months = per_player.groupBy("month").agg(_sum("bet").alias("revenue"), F.count("player_key").alias("players"))
    spine = windows.month_spine(months, "month").join(months, "month", "left")
    spine = spine.withColumns({"revenue": F.coalesce("revenue", F.lit(0)).cast(TOTAL), "players": F.coalesce("players", F.lit(0))})
    out = spine.withColumn("revenue_per_player", S.ratio(F.col("revenue"), F.col("players")))
    return windows.growth(out, "revenue", "month", {"mom": 1})


# -- operations


def heatmap(player_game: DataFrame) -> DataFrame:
    """Plays per hour (rows) and weekday (columns d0 = Sunday ... d6)."""
    cells = player_game.groupBy(F.hour("play_time").alias("hour_of_day"), S.day_of_week("play_time").alias("dow")).agg(_n().alias("n"))
    pivoted = cells.groupBy("hour_of_day").pivot("dow", list(range(7))).agg(F.sum("n"))
    return pivoted.select("hour_of_day", *[F.coalesce(F.col(str(d)), F.lit(0)).alias(f"d{d}") for d in range(7)])


def peak_hours(player_game: DataFrame) -> DataFrame:
    """Hours ranked by plays; at most 24 rows pass through the window."""
    hours = player_game.groupBy(F.hour("play_time").alias("hour_of_day")).agg(_n().alias("total_plays"))
    return hours.withColumn("place", F.rank().over(Window.orderBy(F.desc("total_plays"))))


def game_utilisation(fact: DataFrame) -> DataFrame:
    """Every game with its rank by plays."""
    totals = settle(fact.groupBy("game_name").agg(_n().alias("total_plays")), "utilisation")
    return windows.rank_desc(totals, "total_plays")


def staff_utilisation(shifts: DataFrame, fact: DataFrame) -> DataFrame:
    """Shifts, scheduled hours, plays and bets per staff member."""
    hours = F.unix_micros(F.col("shift_end").cast("timestamp")) - F.unix_micros(F.col("shift_start").cast("timestamp"))
    planned = shifts.groupBy(F.col("staff_email").alias("staff_key")).agg(_n().alias("shifts"), F.sum(hours).alias("micros"))
    served = fact.groupBy("staff_key").agg(_n().alias("plays"), S.total(fact, "bet_amount").alias("revenue"))
    out = planned.join(served, "staff_key", "left")
    hours_total = F.col("micros").cast("double") / F.lit(3_600_000_000.0)
    return out.select(
        "staff_key",
        "shifts",
        hours_total.alias("scheduled_hours"),
        F.coalesce("plays", F.lit(0)).alias("plays"),
        F.coalesce("revenue", F.lit(0)).cast(TOTAL).alias("revenue"),
        S.ratio(F.coalesce("plays", F.lit(0)), hours_total).alias("plays_per_hour"),
    )


def equipment_availability(table_game: DataFrame, slot_machine: DataFrame) -> DataFrame:
    """Units, working units and their share per location and kind."""
    tables = table_game.select("location_code", F.lit("table").alias("kind"), F.col("status").isin("Available", "In Use").alias("up"))
    machines = slot_machine.select("location_code", F.lit("machine").alias("kind"), (F.col("status") == P.MACHINE_ACTIVE).alias("up"))
    out = tables.unionByName(machines).groupBy("location_code", "kind").agg(_n().alias("units"), F.count_if("up").alias("units_up"))
    return out.withColumn("uptime_share", S.ratio(F.col("units_up"), F.col("units")))


# -- customers


def segment_spending(fact: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Players and bets per tier, with the tier's share of all bets; players without plays count."""
    spent = fact.groupBy("player_key").agg(S.total(fact, "bet_amount").alias("bet"), _n().alias("n"))
    people = dim_player.where(F.col("is_current")).select("player_key", "loyalty_tier").join(spent, "player_key", "left")
    tiers = people.groupBy("loyalty_tier").agg(
        _n().alias("players"), F.coalesce(_sum("bet"), F.lit(0)).cast(TOTAL).alias("total_bets"), F.coalesce(F.sum("n"), F.lit(0)).alias("total_plays")
    )
    return windows.share_of_total(tiers, {"total_bets": "bet_share"})


def funnel(player: DataFrame, player_game: DataFrame, days: int = P.RETENTION_DAYS) -> DataFrame:
    """Registered, played, and played at least `days` days after registering."""
    last = player_game.groupBy("player_email").agg(F.max("play_time").alias("last_play"))
    both = player.select(F.col("email").alias("player_email"), "registration_date").join(last, "player_email", "left")
    late = F.col("last_play") >= F.col("registration_date") + F.expr(f"interval {int(days)} days")
    return both.agg(_n().alias("registered"), F.count("last_play").alias("played"), F.count_if(late).alias("retained"))


def lifetime_value(fact: DataFrame, width: str | None = None) -> DataFrame:
    """Bets per player and month and their running total; a player has one row per month."""
    monthly = fact.groupBy("player_key", F.trunc("full_date", "month").alias("month")).agg(S.total(fact, "bet_amount").alias("revenue"))
    return windows.neighbours(monthly, ["player_key"], ["month"], running=["revenue"], bucket=F.trunc("month", width) if width else None).withColumnRenamed("run_revenue", "lifetime_value")


def revenue_concentration(fact: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per player: the share of players who bet at least as much, and their share of all bets."""
    totals = fact.groupBy("player_key").agg(S.total(fact, "bet_amount").alias("revenue"))
    return windows.cumulative_share(totals, "revenue", buckets)


# -- finance


def cash_flow(transaction: DataFrame) -> DataFrame:
    """Deposits minus withdrawals per day and since the start."""
    day = F.to_date("transaction_time").alias("day")

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("transaction_type") == kind, F.col("amount")).otherwise(F.lit(0))).cast(TOTAL)

    days = transaction.groupBy(day).agg(of("Deposit").alias("deposits"), of("Withdraw").alias("withdrawals"))
    days = days.withColumn("net_flow", (F.col("deposits") - F.col("withdrawals")).cast(TOTAL))
    return windows.running_total(days, ["net_flow"], ["day"])


def margin_by_type(fact: DataFrame, dim_game: DataFrame) -> DataFrame:
    """Net of wins and bets per game type, and its share of the bets."""
    per_game = fact.groupBy("game_name").agg(S.total(fact, "bet_amount").alias("bet"), S.total(fact, "win_amount").alias("won"))
    types = per_game.join(dim_game.select("game_name", "game_type"), "game_name").groupBy("game_type")
    out = types.agg(_sum("bet").alias("total_bets"), _sum("won").alias("total_wins"))
    out = out.withColumn("net_revenue", (F.col("total_wins") - F.col("total_bets")).cast(TOTAL))
    return out.withColumn("margin", S.ratio(F.col("net_revenue"), F.col("total_bets")))


def type_mix(transaction: DataFrame) -> DataFrame:
    """Number and amount per transaction type with their shares."""
    out = transaction.groupBy("transaction_type").agg(_n().alias("transactions"), S.total(transaction, "amount").alias("amount"))
    return windows.share_of_total(out, {"transactions": "count_share", "amount": "amount_share"})


def trend_forecast(fact: DataFrame, ahead: int = 3) -> DataFrame:
    """Straight line through the monthly bets: slope, intercept and the next `ahead` months.

    The sums behind the line are exact; one division at the end gives a double.
    """
    months = _months(fact, S.total(fact, "bet_amount").alias("y")).withColumn("y", F.coalesce("y", F.lit(0)).cast(TOTAL))
    start = months.agg(F.min("month")).scalar()
    x = F.floor(F.months_between(F.col("month"), start)).cast("long")
    points = months.select(x.alias("x"), "y", "month")
    big = "decimal(38,2)"
    sums = points.agg(
        _n().alias("n"),
        F.sum("x").alias("sx"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum("y").cast(big).alias("sy"),
        F.sum((F.col("y") * F.col("x").cast("decimal(10,0)")).cast("decimal(32,2)")).cast(big).alias("sxy"),
        F.max("month").alias("last"),
    )
    bottom = (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
    slope = S.ratio(F.col("n").cast("double") * F.col("sxy").cast("double") - F.col("sx").cast("double") * F.col("sy").cast("double"), bottom)
    lined = sums.withColumn("slope", slope).withColumn("intercept", (F.col("sy").cast("double") - F.col("slope") * F.col("sx").cast("double")) / F.col("n").cast("double"))
    step = F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("step")
    out = lined.select("last", "n", "slope", "intercept", step)
    return out.select(
        F.add_months("last", F.col("step")).alias("month"),
        "slope",
        "intercept",
        (F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("step")).cast("double")).alias("forecast"),
    )


# -- drill-down and filters


def drilldown(df: DataFrame, levels: Sequence[str], aggs: Sequence[Column], how: str = "rollup") -> DataFrame:
    """Totals at every level of a hierarchy (rollup) or every combination (cube); `level` is the grouping id."""
    grouped = df.rollup(*levels) if how == "rollup" else df.cube(*levels)
    return grouped.agg(F.grouping_id().cast("int").alias("level"), *aggs)


def time_drilldown(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Year > quarter > month > day. Only one row per day is expanded into the levels."""
    daily = fact.groupBy("full_date").agg(_n().alias("n"), S.total(fact, "bet_amount").alias("bet"))
    levels = ["year", "quarter", "month_number", "day_of_month"]
    return drilldown(daily.join(dim_time.select("full_date", *levels), "full_date"), levels, [F.sum("n").alias("total_plays"), _sum("bet").alias("total_bets")])


def location_drilldown(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Country > state > city > venue."""
    per_place = fact.groupBy("location_code").agg(_n().alias("n"), S.total(fact, "bet_amount").alias("bet"))
    levels = ["country", "state", "city", "location_name"]
    return drilldown(per_place.join(dim_location.select("location_code", *levels), "location_code"), levels, [F.sum("n").alias("total_plays"), _sum("bet").alias("total_bets")])


def game_drilldown(fact: DataFrame, dim_game: DataFrame) -> DataFrame:
    """Type > game."""
    per_game = fact.groupBy("game_name").agg(_n().alias("n"), S.total(fact, "bet_amount").alias("bet"))
    return drilldown(per_game.join(dim_game.select("game_name", "game_type"), "game_name"), ["game_type", "game_name"], [F.sum("n").alias("total_plays"), _sum("bet").alias("total_bets")])


def customer_drilldown(fact: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Tier > player > type of game played."""
    per_pair = fact.groupBy("player_key", "game_name").agg(_n().alias("n"), S.total(fact, "bet_amount").alias("bet"))
    people = dim_player.where(F.col("is_current")).select("player_key", "loyalty_tier")
    return drilldown(per_pair.join(people, "player_key"), ["loyalty_tier", "player_key", "game_name"], [F.sum("n").alias("total_plays"), _sum("bet").alias("total_bets")])


def filter_cube(fact: DataFrame, dim_player: DataFrame) -> DataFrame:
    """Totals for every choice of tier, age band and game, "all" included."""
    per_pair = fact.groupBy("player_key", "game_name").agg(_n().alias("n"), S.total(fact, "bet_amount").alias("bet"))
    people = dim_player.where(F.col("is_current")).select("player_key", "loyalty_tier", "age_group")
    cells = per_pair.join(people, "player_key").groupBy("loyalty_tier", "age_group", "game_name").agg(F.sum("n").alias("n"), _sum("bet").alias("bet"))
    return drilldown(cells, ["loyalty_tier", "age_group", "game_name"], [F.sum("n").alias("total_plays"), _sum("bet").alias("total_bets")], how="cube")


def filtered(fact: DataFrame, dates: tuple[str, str] | None = None, dims: Mapping[str, tuple[DataFrame, Mapping[str, Sequence]]] | None = None) -> DataFrame:
    """Fact rows within the dates (both included) and whose dimension rows have the chosen values.

    `dims` maps the fact's key to (dimension, {attribute: accepted values}); the date
    range reaches the scan, and a dimension is cut down before it meets the fact.
    """
    out = fact
    if dates:
        out = out.where(F.col("full_date").between(F.lit(dates[0]).cast("date"), F.lit(dates[1]).cast("date")))
    for key, (dim, chosen) in (dims or {}).items():
        kept = dim
        for attr, values in chosen.items():
            kept = kept.where(F.col(attr).isin(*values))
        out = out.join(kept.select(key), key, "left_semi")
    return out


# -- tables that have no report of their own


def reward_use(player_reward: DataFrame, reward: DataFrame) -> DataFrame:
    """Redemptions, players and points spent per reward."""
    per_player = player_reward.groupBy("reward_code", "player_email").agg(_n().alias("n"))
    used = per_player.groupBy("reward_code").agg(F.sum("n").alias("redemptions"), F.count("player_email").alias("players"))
    out = reward.select("reward_code", "name", "points_required").join(used, "reward_code")
    return out.withColumn("points_spent", F.col("points_required").cast("long") * F.col("redemptions"))


def player_rewards(player_reward: DataFrame, reward: DataFrame) -> DataFrame:
    """Redemptions and points spent per player."""
    used = player_reward.groupBy("player_email", "reward_code").agg(_n().alias("n"))
    priced = used.join(reward.select("reward_code", "points_required"), "reward_code")
    return priced.groupBy("player_email").agg(F.sum("n").alias("redemptions"), F.sum(F.col("points_required").cast("long") * F.col("n")).alias("points_spent"))


def login_activity(login_history: DataFrame) -> DataFrame:
    """Logins, first and last time per player and device class."""
    return login_history.groupBy("player_email", S.device_class("device").alias("device_type")).agg(
        _n().alias("logins"), F.min("login_time").alias("first_login"), F.max("login_time").alias("last_login")
    )


def audit_activity(audit_log: DataFrame) -> DataFrame:
    """Audit events per staff member and type."""
    return audit_log.groupBy("performed_by", "event_type").agg(_n().alias("events"), F.max("event_time").alias("last_event"))


def slot_performance(slot_play: DataFrame, slot_machine: DataFrame) -> DataFrame:
    """Plays and money per model and location."""
    per_machine = slot_play.groupBy("machine_code").agg(_n().alias("n"), S.total(slot_play, "bet_amount").alias("bet"), S.total(slot_play, "win_amount").alias("won"))
    joined = slot_machine.select("machine_code", "model", "location_code").join(per_machine, "machine_code")
    out = joined.groupBy("model", "location_code").agg(_n().alias("machines"), F.sum("n").alias("plays"), _sum("bet").alias("total_bets"), _sum("won").alias("total_wins"))
    return out.withColumn("win_share", S.ratio(F.col("total_wins"), F.col("total_bets")))


def results_by_table(game_result: DataFrame) -> DataFrame:
    """Results and different outcomes per table and day."""
    day = F.to_date("result_time").alias("day")
    per_outcome = game_result.groupBy("table_code", day, "outcome_description").agg(_n().alias("n"))
    return per_outcome.groupBy("table_code", "day").agg(F.sum("n").alias("results"), F.count("outcome_description").alias("outcomes"))
