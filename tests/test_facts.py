from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import presets as P
from tallyhouse.operators import dimensions, facts, scd2, summaries
from tallyhouse.plans import insights


def at(day, hour=12, minute=0):
    return datetime(2024, 1, day, hour, minute)


def money(df, *cols):
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in cols})


@pytest.fixture(scope="module")
def world(spark):
    """Two players, two games, three tables, two shifts, a slot machine, logins."""
    make = spark.createDataFrame
    players = make(
        [("p1", "Ann", "A", date(2000, 2, 29), at(1), 12000), ("p2", "Bob", "B", date(1980, 1, 1), at(1), 10)],
        "email string, first_name string, last_name string, dob date, registration_date timestamp_ntz, loyalty_points int",
    )
    staff = make([("s1", "Sam", "S", "Dealer", date(2020, 1, 1)), ("s2", "Tom", "T", "Manager", date(2020, 1, 1))], "staff_email string, first_name string, last_name string, position string, hire_date date")
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    game = make([("g1", "Poker", 1, 5), ("g2", "Slot", 1, 5)], "game_name string, type string, min_bet int, max_bet int")
    location = make([("L1", "One", "a", "c1", "s1", "x"), ("L2", "Two", "b", "c2", "s2", "x")], "location_code string, name string, address string, city string, state string, country string")
    plays = make(
        [("p1", "g1", at(1), "10", "4"), ("p1", "g1", at(1, 13, 30), "5", None), ("p2", "g2", at(2), "7", "9"), ("zz", "g1", at(2), "1", "1"), ("p2", "gX", at(2), "1", "1")],
        "player_email string, game_name string, play_time timestamp_ntz, amount_bet string, amount_won string",
    )
    return {
        "player": players,
        "plays": money(plays, "amount_bet", "amount_won"),
        "dim_player": scd2.init(dimensions.player_rows(players, F.lit("2024-02-01").cast("date")), as_of),
        "dim_staff": scd2.init(dimensions.staff_rows(staff), as_of).withColumn("is_active", F.col("staff_key") == "s1"),
        "dim_game": dimensions.game_dim(game),
        "dim_location": dimensions.location_dim(location),
        "table_game": make([("t2", "g1", "L2"), ("t1", "g1", "L1")], "table_code string, game_name string, location_code string"),
        "shifts": make([("s1", "t1"), ("s2", "t1"), ("s2", "t2")], "staff_email string, table_code string"),
        "slot_play": make([("m2", "p2", at(2)), ("m1", "p2", at(2))], "machine_code string, player_email string, play_time timestamp_ntz"),
        "slot_machine": make([("m1", "L2"), ("m2", "L1")], "machine_code string, location_code string"),
        "logins": make([("p1", at(1), "a", "My Mobile"), ("p1", at(3), "c", "Tablet X"), ("p1", at(3), "b", "PC")], "player_email string, login_time timestamp_ntz, login_id string, device string"),
    }


def build(w, **kwargs):
    return facts.gaming_fact(
        w["plays"], w["dim_player"], w["dim_game"], w["table_game"], w["shifts"], w["dim_staff"], w["dim_location"], w["slot_play"], w["slot_machine"], w["logins"], **kwargs
    )


def test_one_row_per_known_play(world, rows):
    got = build(world).select("player_key", "game_name", "table_code", "location_code", "machine_code", "staff_key", "device_model", "net_result", "session_duration_minutes")
    assert rows(got) == [
        ("p1", "g1", "t1", "L1", None, "s1", "Tablet X", Decimal("-5.00"), 90),
        ("p1", "g1", "t1", "L1", None, "s1", "Tablet X", Decimal("-6.00"), None),
        ("p2", "g2", None, "L2", "m1", None, None, Decimal("2.00"), None),
    ]


def test_salted_build_is_the_same(world, rows):
    assert rows(build(world, salts=3)) == rows(build(world))


def test_fanout_repeats_per_table_and_shift(world, rows):
    wide = build(world, fanout="all", session=None)
    assert wide.count() == 2 * 3 + 1
    by_place = wide.where("game_name = 'g1'").groupBy("game_name", "location_code").agg(F.count(F.lit(1)), F.sum("bet_amount"), F.sum(F.coalesce("win_amount", F.lit(0))))
    known = world["plays"].where("player_email <> 'zz'")
    totals = facts.fanout_totals(known, world["dim_game"], world["table_game"], world["shifts"]).where("game_name = 'g1'")
    assert rows(totals) == rows(by_place)
    staff = wide.where("game_name = 'g1'").groupBy("staff_key").count()
    assert dict(rows(staff)) == {"s1": 2, None: 4}


def test_append_grain(world, rows):
    first = build({**world, "plays": world["plays"].where(F.col("play_time") == at(1))}, session=None)
    assert build(world, existing=first, session=None).count() == 2
    # By the day, the second play of that day is taken for known.
    assert build(world, existing=first, grain="day", session=None).count() == 1


def test_transactions(spark, world, rows):
    txn = spark.createDataFrame(
        [("t1", "p1", "9.99", "Bet", at(1), "g1"), ("t2", "p1", "3.50", "Withdraw", at(1), None), ("t3", "p2", "3.50", "Win", at(1), "g1"), ("t4", "no", "1", "Bet", at(1), "g1")],
        "transaction_code string, player_email string, amount string, transaction_type string, transaction_time timestamp_ntz, game_name string",
    )
    args = (money(txn, "amount"), world["dim_player"], world["table_game"], world["shifts"], world["dim_staff"])
    fact = facts.txn_fact(*args)
    got = fact.select("transaction_code", "location_code", "staff_key", "loyalty_points_earned", "loyalty_points_redeemed")
    assert rows(got) == [("t1", "L1", "s1", 9, 0), ("t2", None, None, 0, 3), ("t3", "L1", "s1", 0, 0)]
    assert facts.txn_fact(*args, fanout="all").count() == 3 + 1 + 3
    assert facts.txn_fact(*args, existing=fact.where("transaction_code = 't1'")).count() == 2


def test_staff_during_shift(spark, rows):
    plays = spark.createDataFrame([(1, "t1", at(1, 10)), (2, "t1", at(1, 18)), (3, "t9", at(1, 10))], "play_id int, table_code string, play_time timestamp_ntz")
    shifts = spark.createDataFrame([("s2", "t1", at(1, 9), at(1, 18)), ("s1", "t1", at(1, 8), at(1, 11))], "staff_email string, table_code string, shift_start timestamp_ntz, shift_end timestamp_ntz")
    assert rows(facts.staff_on_shift(plays, shifts), "play_id", "staff_email") == [(1, "s1"), (2, None), (3, None)]


def test_summaries_and_refresh(world, rows):
    fact = build(world, session=None)
    whole = summaries.daily_summary(fact)
    assert {(r["full_date"], r["location_code"], r["total_players"], r["total_plays"], r["average_bet_amount"]) for r in whole.collect()} == {(date(2024, 1, 1), "L1", 1, 2, 7.5), (date(2024, 1, 2), "L2", 1, 1, 7.0)}
    early = fact.where(F.col("play_time") == at(1))
    late = fact.where(F.col("play_time") != at(1))
    assert rows(summaries.refresh(summaries.daily_summary(early), fact, late)) == rows(whole)
    assert rows(summaries.bridge_add(summaries.bridge(early), late)) == rows(summaries.bridge(fact))


def test_win_rate_without_bets(spark):
    fact = spark.createDataFrame([(date(2024, 1, 1), "p", "g", 0, 5, 5)], "full_date date, player_key string, game_name string, bet_amount int, win_amount int, net_result int")
    assert summaries.player_day_summary(fact).first()["win_rate"] == 0.0


def test_star_query_ignores_closed_versions(spark, world, rows):
    fact = build(world)
    dim = scd2.with_id(world["dim_player"], "player_key", "player_id")
    assert rows(insights.segmentation(fact, dim), "loyalty_tier", "age_group", "player_count", "games_played_count") == [("Bronze", "35-44", 1, 1), ("Platinum", "18-24", 1, 1)]
    closed = dim.withColumn("is_current", F.col("player_key") != "p2")
    assert rows(insights.segmentation(fact, closed), "loyalty_tier") == [("Platinum",)]


def test_operational_reports(world, rows):
    plays, players = world["plays"], world["player"]
    top = insights.player_loyalty(players, plays, tiers=P.TIERS_REPORT).collect()
    assert [(r["email"], r["total_games_played"], r["games_played_count"], r["loyalty_tier"]) for r in top] == [("p1", 2, 1, "Platinum"), ("p2", 2, 2, "Bronze")]
    kept = insights.retention(players, plays, days=1).first()
    assert (kept["registered_players"], kept["active_players"], kept["retention_rate"]) == (2, 1, Decimal("50.00"))


def test_reconciliation_shows_the_fanout(world):
    wide = build(world, fanout="all", session=None)
    time = dimensions.date_dim(world["plays"], "play_time")
    star = insights.monthly_revenue_star(wide, time).withColumnRenamed("month_number", "month")
    row = insights.reconcile(insights.monthly_revenue(world["plays"]), star, ["year", "month"], ["total_plays"]).first()
    assert (row["total_plays_left"], row["total_plays_right"], row["total_plays_difference"]) == (5, 7, 2)


def test_dimensions(spark, world, rows):
    first = dimensions.device_dim(world["logins"].where("device <> 'PC'"))
    again = dimensions.device_dim(world["logins"].union(spark.createDataFrame([("p", at(1), "z", None)], world["logins"].schema)), first)
    assert rows(again, "device_type", "device_model", "is_mobile", "is_tablet", "is_desktop") == [
        ("Desktop", "PC", False, False, True),
        ("Desktop", None, False, False, True),
        ("Mobile", "My Mobile", True, False, False),
        ("Tablet", "Tablet X", False, True, False),
    ]
    assert rows(dimensions.device_dim(world["logins"], again), "device_id") == rows(again, "device_id")
    dates = dimensions.date_dim_range(spark, "2024-02-28", "2024-03-01")
    assert rows(dates, "time_id", "day_of_month", "is_weekend") == [(20240228, 28, False), (20240229, 29, False), (20240301, 1, False)]
