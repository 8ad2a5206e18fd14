"""The analytic reports, each one function over tables in the declared shape.

Tables of plays and facts are reduced by the keys that a report needs before they meet
a dimension, and distinct players are counted on rows that are already one per group
and player. Sums are exact decimals; averages are sum over count, unrounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import presets as P
from tallyhouse.functions import scalars as S

TOTAL = "decimal(22,2)"


def _since(df: DataFrame, at: str, since: str | None) -> DataFrame:
    return df.where(F.col(at) >= F.lit(since).cast(dict(df.dtypes)[at])) if since else df


def _n() -> Column:
    return F.count(F.lit(1))


def _plays_by(plays: DataFrame, *keys) -> DataFrame:
    """Additive measures of plays: n, bet, won and nb, the number of bets that are not NULL."""
    bet, won = S.total(plays, "amount_bet"), S.total(plays, "amount_won")
    return plays.groupBy(*keys).agg(_n().alias("n"), bet.alias("bet"), won.alias("won"), F.count("amount_bet").alias("nb"))


def _fact_by(fact: DataFrame, *keys) -> DataFrame:
    """Additive measures of the fact, with minutes of session and the number of known ones."""
    return fact.groupBy(*keys).agg(
        _n().alias("n"),
        S.total(fact, "bet_amount").alias("bet"),
        S.total(fact, "win_amount").alias("won"),
        F.count("bet_amount").alias("nb"),
        F.sum("session_duration_minutes").alias("minutes"),
        F.count("session_duration_minutes").alias("nm"),
    )


def _again(df: DataFrame, *keys, extra: Sequence[Column] = ()) -> DataFrame:
    """Sum the additive measures once more on fewer keys."""
    measures = [F.sum(c).alias(c) for c in ("n", "bet", "won", "nb", "minutes", "nm") if c in df.columns]
    return df.groupBy(*keys).agg(*measures, *extra)


def _net(top: str = "won", bottom: str = "bet") -> Column:
    return F.round(F.col(top) - F.col(bottom), 2).cast(TOTAL)


def _year(at: str) -> Column:
    return F.year(at).alias("year")


def _month(at: str) -> Column:
    return F.month(at).alias("month")


# -- on the operational tables


def game_popularity_monthly(player_game: DataFrame, game: DataFrame, since: str | None = P.SINCE) -> DataFrame:
    """Plays and money per game, year and month."""
    played = _plays_by(_since(player_game, "play_time", since), "game_name", _year("play_time"), _month("play_time"))
    named = played.join(game.select("game_name", F.col("type").alias("game_type")), "game_name")
    return named.select(
        "game_name",
        "game_type",
        "year",
        "month",
        F.col("n").alias("total_plays"),
        F.col("bet").cast(TOTAL).alias("total_bets"),
        F.col("won").cast(TOTAL).alias("total_wins"),
        S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"),
        _net().alias("net_revenue"),
    ).orderBy(F.desc("year"), F.desc("month"), F.desc("total_plays"))


def player_loyalty(player: DataFrame, player_game: DataFrame, k: int = P.TOP_LOYAL, tiers=P.TIERS_REPORT) -> DataFrame:
    """Top players with plays, by points and then by spending."""
    per_game = _plays_by(player_game, "player_email", "game_name")
    per_player = _again(per_game, "player_email", extra=[F.count("game_name").alias("games_played_count")])
    # Only players with plays stay, so the outer join of the report is an inner one.
    rows = player.withColumnRenamed("email", "player_email").join(per_player, "player_email")
    return (
        rows.select(
            F.col("player_email").alias("email"),
            "first_name",
            "last_name",
            "loyalty_points",
            "registration_date",
            F.col("n").alias("total_games_played"),
            F.col("bet").cast(TOTAL).alias("total_amount_bet"),
            F.col("won").cast(TOTAL).alias("total_amount_won"),
            _net().alias("net_result"),
            S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"),
            "games_played_count",
            S.tier("loyalty_points", tiers).alias("loyalty_tier"),
        )
        .orderBy(F.desc_nulls_first("loyalty_points"), F.desc_nulls_first("total_amount_bet"), "email")
        .limit(k)
    )


def transactions_by_type_time(transaction: DataFrame, game: DataFrame, since: str | None = P.SINCE) -> DataFrame:
    """Transactions per type, year, month, weekday and game; those without a known game stay."""
    kept = _since(transaction, "transaction_time", since)
    dow = S.day_of_week("transaction_time").alias("day_of_week")
    grouped = kept.groupBy("transaction_type", _year("transaction_time"), _month("transaction_time"), dow, "game_name").agg(
        _n().alias("n"), S.total(kept, "amount").alias("total"), F.count("amount").alias("nb"), F.min("amount").alias("low"), F.max("amount").alias("high")
    )
    known = game.select("game_name", F.col("game_name").alias("known_game"), F.col("type").alias("game_type"))
    named = grouped.join(known, "game_name", "left")
    # A game that the game table lacks is reported as NULL, so such groups fall together.
    out = named.groupBy("transaction_type", "year", "month", "day_of_week", F.col("known_game").alias("game_name"), "game_type").agg(
        F.sum("n").alias("transaction_count"),
        F.sum("total").cast(TOTAL).alias("total_amount"),
        S.mean(F.sum("total"), F.sum("nb")).alias("avg_amount"),
        F.min("low").alias("min_amount"),
        F.max("high").alias("max_amount"),
    )
    return out.orderBy("transaction_type", F.desc("year"), F.desc("month"), F.desc_nulls_first("total_amount"))


def monthly_revenue(player_game: DataFrame, since: str | None = P.SINCE) -> DataFrame:
    return (
        _plays_by(_since(player_game, "play_time", since), _year("play_time"), _month("play_time"))
        .select("year", "month", F.col("bet").alias("total_bets"), F.col("won").alias("total_wins"), _net().alias("net_revenue"), F.col("n").alias("total_plays"))
        .orderBy(F.desc("year"), F.desc("month"))
    )


def top_bettors(player: DataFrame, player_game: DataFrame, k: int = P.TOP_BETTORS) -> DataFrame:
    per_player = _plays_by(player_game, "player_email")
    named = player.select(F.col("email").alias("player_email"), "first_name", "last_name").join(per_player, "player_email")
    return (
        named.select(F.col("player_email").alias("email"), "first_name", "last_name", F.col("bet").alias("total_bet"), F.col("won").alias("total_won"), F.col("n").alias("total_plays"))
        .orderBy(F.desc_nulls_first("total_bet"), "email")
        .limit(k)
    )


def game_popularity(player_game: DataFrame, game: DataFrame) -> DataFrame:
    named = _plays_by(player_game, "game_name").join(game.select("game_name", "type"), "game_name")
    return named.select(
        "game_name", "type", F.col("n").alias("total_plays"), F.col("bet").alias("total_bets"), S.mean(F.col("bet"), F.col("nb")).alias("avg_bet")
    ).orderBy(F.desc("total_plays"))


def hourly_activity(player_game: DataFrame, since: str | None = P.SINCE) -> DataFrame:
    per_player = _plays_by(_since(player_game, "play_time", since), F.hour("play_time").alias("hour_of_day"), "player_email")
    hours = _again(per_player, "hour_of_day", extra=[F.count("player_email").alias("unique_players")])
    return hours.select(
        "hour_of_day", F.col("n").alias("total_plays"), F.col("bet").cast(TOTAL).alias("total_bets"), S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"), "unique_players"
    ).orderBy("hour_of_day")


def retention(player: DataFrame, player_game: DataFrame, days: int = P.RETENTION_DAYS) -> DataFrame:
    """Per registration month: players, and those with a play at least `days` days after it.

    A play that late exists just when the last play is that late, so the plays are one
    row per player before the join and nothing has to be counted distinct.
    """
    last = player_game.groupBy("player_email").agg(F.max("play_time").alias("last_play"))
    both = player.select(F.col("email").alias("player_email"), "registration_date").join(last, "player_email", "left")
    active = F.col("last_play") >= F.col("registration_date") + F.expr(f"interval {int(days)} days")
    months = both.groupBy(F.year("registration_date").alias("reg_year"), F.month("registration_date").alias("reg_month")).agg(
        _n().alias("registered_players"), F.count_if(active).alias("active_players")
    )
    rate = S.round_ratio(F.col("active_players"), F.col("registered_players"), 100)
    return months.withColumn("retention_rate", rate).orderBy(F.desc_nulls_first("reg_year"), F.desc_nulls_first("reg_month"))


def financial_summary(transaction: DataFrame, since: str | None = P.SINCE, by: str = "month") -> DataFrame:
    """Money per transaction type, one row per month (or day), with the net of wins and bets."""
    kept = _since(transaction, "transaction_time", since)
    keys = [_year("transaction_time"), _month("transaction_time")]
    if by == "day":
        keys.append(F.dayofmonth("transaction_time").alias("day"))

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("transaction_type") == kind, F.col("amount")).otherwise(F.lit(0))).cast(TOTAL)

    out = kept.groupBy(*keys).agg(
        of("Deposit").alias("total_deposits"),
        of("Withdraw").alias("total_withdrawals"),
        of("Bet").alias("total_bets"),
        of("Win").alias("total_wins"),
        F.count_if(F.col("transaction_type") == "Deposit").alias("deposit_count"),
        F.count_if(F.col("transaction_type") == "Withdraw").alias("withdrawal_count"),
    )
    return out.withColumn("gaming_revenue", _net("total_wins", "total_bets")).orderBy(F.desc("year"), F.desc("month"))


# -- on the star


def activity_trend(fact: DataFrame, dim_time: DataFrame, since: str | None = P.SINCE) -> DataFrame:
    """Players, plays, money and session minutes per year, quarter, month and weekday."""
    per_day = _fact_by(_since(fact, "full_date", since), "full_date", "player_id")
    keys = ("year", "quarter", "month_name", "day_of_week")
    dated = per_day.join(dim_time.select("full_date", *keys), "full_date")
    per_player = _again(dated, *keys, "player_id")
    out = _again(per_player, *keys, extra=[F.count("player_id").alias("unique_players")])
    return out.select(
        *keys,
        "unique_players",
        F.col("n").alias("total_activities"),
        F.col("bet").cast(TOTAL).alias("total_bets"),
        F.col("won").cast(TOTAL).alias("total_wins"),
        _net().alias("net_revenue"),
        S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"),
        F.col("minutes").alias("total_session_time"),
        S.round_ratio(F.col("minutes"), F.col("nm")).alias("avg_session_duration"),
    ).orderBy(F.desc("year"), F.desc("quarter"), "month_name", "day_of_week")


def _players(dim_player: DataFrame, current_only: bool) -> DataFrame:
    return dim_player.where(F.col("is_current")) if current_only else dim_player


def segmentation(fact: DataFrame, dim_player: DataFrame, current_only: bool = True) -> DataFrame:
    """Players, plays and money per value tier and age band."""
    per_game = _fact_by(fact, "player_id", "game_name")
    people = _players(dim_player, current_only).select("player_id", "loyalty_tier", "age_group")
    joined = per_game.join(people, "player_id")
    keys = ("loyalty_tier", "age_group")
    totals = _again(_again(joined, *keys, "player_id"), *keys, extra=[F.count("player_id").alias("player_count")])
    games = joined.select(*keys, "game_name").distinct().groupBy(*keys).agg(F.count("game_name").alias("games_played_count"))
    out = totals.join(games, [*keys], "left")
    return out.select(
        *keys,
        "player_count",
        S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"),
        F.col("bet").cast(TOTAL).alias("total_bets"),
        F.col("won").cast(TOTAL).alias("total_wins"),
        _net().alias("net_revenue"),
        F.col("n").alias("total_activities"),
        S.round_ratio(F.col("minutes"), F.col("nm")).alias("avg_session_duration"),
        F.coalesce("games_played_count", F.lit(0)).alias("games_played_count"),
        S.round_ratio(F.col("bet"), F.col("player_count")).alias("avg_player_bet"),
    ).orderBy(F.desc_nulls_first("total_bets"), F.desc("player_count"))


def _games(dim_game: DataFrame, active_only: bool) -> DataFrame:
    return dim_game.where(F.col("is_active")) if active_only else dim_game


def _game_place_totals(fact: DataFrame, dim_game: DataFrame, dim_location: DataFrame, active_only: bool, place: Sequence[str]) -> DataFrame:
    """Per game and place name: codes that share a name are one group, their players counted once.

    Each code is mapped to the lowest code of its name on the small side, so the fact is
    grouped by codes and the names are looked up for the result only.
    """
    named = dim_location.select("location_code", *place).withColumn("place_code", F.min("location_code").over(Window.partitionBy(*place)))
    plays = fact.withColumnsRenamed({"bet_amount": "amount_bet", "win_amount": "amount_won"}).join(named.select("location_code", "place_code"), "location_code")
    per_player = _plays_by(plays, "game_name", "place_code", "player_id")
    per_place = _again(per_player, "game_name", "place_code", extra=[F.count("player_id").alias("unique_players")])
    games = _games(dim_game, active_only).select("game_name", "game_type")
    names = named.where(F.col("location_code") == F.col("place_code")).select("place_code", *place)
    return per_place.join(games, "game_name").join(names, "place_code")


def game_performance(fact: DataFrame, dim_game: DataFrame, dim_location: DataFrame, active_only: bool = True) -> DataFrame:
    """Players, plays, money and win percentage per game and location."""
    joined = _game_place_totals(fact, dim_game, dim_location, active_only, ["location_name", "city", "state"])
    return joined.select(
        "game_name",
        "game_type",
        "location_name",
        "city",
        "state",
        "unique_players",
        F.col("n").alias("total_plays"),
        F.col("bet").cast(TOTAL).alias("total_bets"),
        F.col("won").cast(TOTAL).alias("total_wins"),
        _net().alias("net_revenue"),
        S.round_ratio(F.col("won"), F.col("bet"), 100).alias("win_percentage"),
        S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"),
        S.round_ratio(F.col("bet"), F.col("n")).alias("avg_bet_per_play"),
    ).orderBy(F.desc_nulls_first("net_revenue"), F.desc("total_plays"))


def game_popularity_by_location(fact: DataFrame, dim_game: DataFrame, dim_location: DataFrame, active_only: bool = True) -> DataFrame:
    joined = _game_place_totals(fact, dim_game, dim_location, active_only, ["location_name"])
    return joined.select(
        "game_name",
        "game_type",
        "location_name",
        F.col("n").alias("total_plays"),
        F.col("bet").cast(TOTAL).alias("total_bets"),
        S.mean(F.col("bet"), F.col("nb")).alias("avg_bet"),
        "unique_players",
    ).orderBy(F.desc("total_plays"))


def monthly_revenue_star(fact: DataFrame, dim_time: DataFrame, since: str | None = P.SINCE) -> DataFrame:
    kept = _since(fact, "full_date", since)
    per_day = kept.groupBy("full_date").agg(_n().alias("n"), S.total(kept, "bet_amount").alias("bet"), S.total(kept, "win_amount").alias("won"))
    keys = ("year", "month_number", "month_name")
    out = _again(per_day.join(dim_time.select("full_date", *keys), "full_date"), *keys)
    return out.select(
        *keys, F.col("bet").cast(TOTAL).alias("total_bets"), F.col("won").cast(TOTAL).alias("total_wins"), _net().alias("net_revenue"), F.col("n").alias("total_plays")
    ).orderBy(F.desc("year"), F.desc("month_number"))


def top_bettors_star(fact: DataFrame, dim_player: DataFrame, k: int = P.TOP_BETTORS, current_only: bool = True) -> DataFrame:
    """By name, tier and band as the report groups them, so namesakes of one segment count as one."""
    keys = ("first_name", "last_name", "loyalty_tier", "age_group")
    named = _fact_by(fact, "player_id").join(_players(dim_player, current_only).select("player_id", *keys), "player_id")
    return (
        _again(named, *keys)
        .select(
            *keys,
            F.col("bet").cast(TOTAL).alias("total_bet"),
            F.col("won").cast(TOTAL).alias("total_won"),
            F.col("n").alias("total_plays"),
            S.round_ratio(F.col("minutes"), F.col("nm")).alias("avg_session_duration"),
        )
        .orderBy(F.desc_nulls_first("total_bet"), *keys)
        .limit(k)
    )


def hourly_activity_star(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """The hour comes from the play time on the fact; the date has to be in the date dimension."""
    per_player = _fact_by(fact, "full_date", F.hour("play_time").alias("hour_of_day"), "player_id").join(dim_time.select("full_date"), "full_date", "left_semi")
    hours = _again(_again(per_player, "hour_of_day", "player_id"), "hour_of_day", extra=[F.count("player_id").alias("unique_players")])
    return hours.select(
        "hour_of_day",
        F.col("n").alias("total_activities"),
        F.col("bet").cast(TOTAL).alias("total_bets"),
        S.mean(F.col("bet"), F.col("nb")).alias("avg_bet_amount"),
        "unique_players",
        S.round_ratio(F.col("minutes"), F.col("nm")).alias("avg_session_duration"),
    ).orderBy("hour_of_day")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Both results side by side with differences; a missing side counts as 0."""
    a = left.select(*keys, *[F.col(m).alias(f"{m}_left") for m in measures])
    b = right.select(*keys, *[F.col(m).alias(f"{m}_right") for m in measures])
    out = a.join(b, list(keys), "full")
    zero = F.lit(0)
    return out.withColumns({f"{m}_difference": F.coalesce(f"{m}_right", zero) - F.coalesce(f"{m}_left", zero) for m in measures})
