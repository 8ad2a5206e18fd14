"""Bridge and daily summaries, whole or only for the groups that were touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import merge
from tallyhouse.session import settle

BRIDGE_KEY = ("player_key", "game_name")
BRIDGE_FOLDS = {
    "first_play_date": "min",
    "last_play_date": "max",
    "total_plays": "sum",
    "total_bet_amount": "sum",
    "total_win_amount": "sum",
}
DAILY_KEY = ("full_date", "location_code", "game_name")
PLAYER_DAY_KEY = ("full_date", "player_key", "game_name")


def bridge(fact: DataFrame) -> DataFrame:
    """First and last play, plays and totals per player and game."""
    return fact.groupBy(*BRIDGE_KEY).agg(
        F.min("play_time").alias("first_play_date"),
        F.max("play_time").alias("last_play_date"),
        F.count(F.lit(1)).alias("total_plays"),
        F.coalesce(S.total(fact, "bet_amount"), F.lit(0)).cast("decimal(22,2)").alias("total_bet_amount"),
        F.coalesce(S.total(fact, "win_amount"), F.lit(0)).cast("decimal(22,2)").alias("total_win_amount"),
    )


def bridge_add(current: DataFrame, new_fact: DataFrame) -> DataFrame:
    """The bridge after new plays, from running totals alone."""
    return merge.accumulate(current, bridge(new_fact), BRIDGE_KEY, BRIDGE_FOLDS)


def daily_summary(fact: DataFrame, keys: Sequence[str] = DAILY_KEY) -> DataFrame:
    """Players, totals, average bet and plays per date, location and game.

    Per (group, player) first: the distinct count and the sums then come from one small
    aggregate, and a hot group is reduced map-side on its players.
    """
    per_player = fact.groupBy(*keys, "player_key").agg(
        S.total(fact, "bet_amount").alias("bet"),
        S.total(fact, "win_amount").alias("win"),
        S.total(fact, "net_result").alias("net"),
        F.count(F.lit(1)).alias("n"),
        F.count("bet_amount").alias("nb"),
    )
    return per_player.groupBy(*keys).agg(
        F.count("player_key").alias("total_players"),
        F.sum("bet").cast("decimal(22,2)").alias("total_bets"),
        F.sum("win").cast("decimal(22,2)").alias("total_wins"),
        F.sum("net").cast("decimal(22,2)").alias("net_revenue"),
        S.mean(F.sum("bet"), F.sum("nb")).alias("average_bet_amount"),
        F.sum("n").alias("total_plays"),
    )


def player_day_summary(fact: DataFrame) -> DataFrame:
    """Per date, player and game, with the win rate (0 without bets)."""
    bet, won = S.total(fact, "bet_amount"), S.total(fact, "win_amount")
    return fact.groupBy(*PLAYER_DAY_KEY).agg(
        F.count(F.lit(1)).alias("total_plays"),
        bet.alias("total_bet_amount"),
        won.alias("total_win_amount"),
        S.total(fact, "net_result").alias("net_result"),
        S.mean(bet, F.count("bet_amount")).alias("average_bet"),
        S.win_rate(won, bet).alias("win_rate"),
    )


def touched_rows(fact: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All fact rows of the groups that the batch has rows in; NULL is a group of its own.

    `batch` is reduced to its distinct groups, and its dates also reach the scan of a
    fact partitioned by date.
    """
    groups = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return fact.join(groups, same, "left_semi")


def refresh(summary: DataFrame, fact: DataFrame, batch: DataFrame, keys: Sequence[str] = DAILY_KEY) -> DataFrame:
    """The summary after a batch: recompute the touched groups, keep the others."""
    fresh = daily_summary(touched_rows(fact, batch, keys), keys)
    return merge.replace_groups(summary, fresh, keys)


# -- players that can be counted again over any groups of days, places and games


# Hash ranges in which new players are numbered.
NUMBER_RANGES = 64


def number_players(players: DataFrame, known: DataFrame | None = None, key: str = "player_key", ranges: int = NUMBER_RANGES) -> DataFrame:
    """`key` and `number` of every player that `known` lacks, without gaps from 1 or from the highest known number on.

    Players are numbered range by range, each in its own task; only the sizes of the ranges meet.
    """
    new = players.select(key).where(F.col(key).isNotNull()).distinct()
    if known is not None:
        new = merge.append_new(known, new, key)
    new = settle(new.withColumn("_range", F.pmod(F.xxhash64(key), F.lit(ranges))), "new-players")
    sizes = new.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_range", F.coalesce(F.sum("n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    last = F.lit(0) if known is None else F.coalesce(known.agg(F.max("number")).scalar(), F.lit(0))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return new.join(before, "_range").select(key, (last + F.col("before") + place).cast("long").alias("number"))


def daily_players(fact: DataFrame, numbers: DataFrame, keys: Sequence[str] = DAILY_KEY) -> DataFrame:
    """Per group the set of its players, as bitmaps of their numbers, one row for each 32,768 numbers that occur."""
    seen = fact.where(F.col("player_key").isNotNull()).select(*keys, "player_key").distinct().join(numbers, "player_key")
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return seen.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("players"))


def fold_players(daily: DataFrame, *groups) -> DataFrame:
    """Distinct players of coarser groups (months, regions, all games), exact and without another look at the plays."""
    merged = daily.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("players").alias("players"))
    names = [c for c in merged.columns if c not in ("bucket", "players")]
    return merged.groupBy(*names).agg(F.sum(F.bitmap_count("players")).alias("total_players"))
