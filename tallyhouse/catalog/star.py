"""Facts, bridge and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.history import DEVICE
from tallyhouse.catalog.registry import query
from tallyhouse.operators import dimensions, facts, joins, summaries
from tallyhouse.session import scratch, settle
from tallyhouse.sources import tables

PLACES = f"""{Q.PLAYS},
one AS (SELECT l_partkey AS game_name, min({Q.TABLE_CODE}) AS table_code FROM lineitem GROUP BY 1),
place AS (SELECT one.game_name, table_code, table_code % 2147483648 AS staff_key, s_nationkey AS place_code FROM one JOIN supplier ON s_suppkey = table_code % 2147483648)"""
MINUTES = """(epoch_us(play_time) - epoch_us(lag(play_time) OVER (PARTITION BY player_email ORDER BY play_time, game_name, amount_bet, amount_won)) + 30000000) // 60000000"""


@query(
    "fact_gaming_one",
    f"""WITH {PLACES}, {DEVICE},
    machine AS (SELECT player_email, play_time, min(l_suppkey) AS machine_code FROM plays GROUP BY 1, 2),
    last AS (SELECT user_id, device_type, device AS device_model FROM devices QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT CAST(CAST(play_time AS DATE) AS VARCHAR) AS full_date, player_email AS player_key, game_name, table_code, place_code AS location_code, machine_code, staff_key, device_type, device_model,
      {Q.dbl('amount_bet')} AS bet_amount, {Q.dbl('amount_won')} AS win_amount, {Q.dbl('amount_won - amount_bet')} AS net_result, {MINUTES} AS session_duration_minutes, 1 AS plays_count
    FROM plays JOIN part ON p_partkey = game_name JOIN customer ON c_custkey = player_email LEFT JOIN place USING (game_name) LEFT JOIN machine USING (player_email, play_time) LEFT JOIN last ON user_id = player_email""",
)
def fact_gaming_one(t):
    """The whole fact: one row per play with table, place, machine, staff and device."""
    fact = facts.gaming_fact(
        t.plays(),
        t.dim_player(),
        t.dim_game(),
        t.table_game(),
        t.shifts(),
        t.dim_staff(),
        t.dim_location(),
        t.slot_play(),
        t.slot_machine(),
        t.login_history(),
        session="day",
    )
    return fact.drop("time_id", "play_time", "player_id", "game_id", "location_id", "device_id")


@query(
    "fact_gaming_fanout",
    f"""WITH {Q.LINES}, copies AS (SELECT l_partkey AS game_name, s_nationkey AS location_code, count(*) AS copies FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2),
    p AS (SELECT game_name, count(*) AS n, sum(amount_bet) AS bet, sum(amount_won) AS won FROM lines GROUP BY 1)
    SELECT game_name, location_code, n * copies AS total_plays, {Q.dbl('bet * copies')} AS total_bets, {Q.dbl('won * copies')} AS total_wins FROM p JOIN copies USING (game_name)""",
)
def fact_gaming_fanout(t):
    """Totals of the fact that repeats a play per table and shift, without making the repeats."""
    return facts.fanout_totals(t.line_plays(), t.dim_game(), t.table_game(), t.shifts())


@query(
    "fact_gaming_one_place",
    f"""WITH {PLACES} SELECT player_email AS player_key, game_name, CAST(play_time AS VARCHAR) AS play_time, place_code AS location_code, {Q.dbl('amount_bet')} AS bet_amount,
    {Q.dbl('amount_won')} AS win_amount, {Q.dbl('amount_won - amount_bet')} AS net_result, {MINUTES} AS session_duration_minutes FROM plays JOIN place USING (game_name)""",
)
def fact_gaming_one_place(t):
    return facts.gaming_fact_one_place(t.plays(), t.dim_player(), t.dim_game(), t.table_game(), t.dim_location()).drop("full_date")


@query(
    "fact_gaming_incremental",
    f"""WITH {Q.EVENT_PLAYS} SELECT player_email AS player_key, game_name, CAST(play_time AS VARCHAR) AS play_time, {Q.dbl('amount_won - amount_bet')} AS net_result
    FROM eplays WHERE play_time >= TIMESTAMP '2024-01-20'""",
)
def fact_gaming_incremental(t):
    """All plays offered again to a fact that has those before a date: only the later ones are new."""
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    loaded = t.event_fact(session=False).where(F.col("play_time") < cut)
    games = dimensions.game_dim(t.event_game())
    fact = facts.gaming_fact(t.event_plays(), t.dim_player(), games, t.event_tables(), t.event_shifts(), t.dim_staff(), existing=loaded, session=None)
    return fact.select("player_key", "game_name", "play_time", "net_result")


@query(
    "fact_txn_points",
    f"""WITH {Q.TXN}, one AS (SELECT l_partkey AS game_name, min({Q.TABLE_CODE}) AS table_code FROM lineitem GROUP BY 1)
    SELECT transaction_code, CAST(CAST(transaction_time AS DATE) AS VARCHAR) AS full_date, player_email AS player_key, s_nationkey AS location_code, s_suppkey AS staff_key, transaction_type, {Q.dbl('amount')} AS amount,
      CASE WHEN transaction_type = 'Bet' THEN CAST(floor(amount) AS BIGINT) ELSE 0 END AS loyalty_points_earned, CASE WHEN transaction_type = 'Withdraw' THEN CAST(floor(amount) AS BIGINT) ELSE 0 END AS loyalty_points_redeemed
    FROM txn JOIN customer ON c_custkey = player_email LEFT JOIN one USING (game_name) LEFT JOIN supplier ON s_suppkey = table_code % 2147483648""",
)
def fact_txn_points(t):
    fact = facts.txn_fact(t.transaction(), t.dim_player(), t.table_game(), t.shifts(), t.dim_staff())
    return fact.drop("time_id", "player_id", "transaction_time")


@query(
    "latest_per_player",
    f"WITH {DEVICE} SELECT user_id AS player_email, device_type, device AS device_model FROM devices QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_per_player(t):
    return facts.latest_device(t.login_history()).drop("device_id")


@query(
    "machine_of_play",
    """SELECT o_custkey AS player_email, CAST(l_shipdate AS VARCHAR) AS play_time, min(l_suppkey) AS machine_code, arg_min(s_nationkey, l_suppkey) AS machine_location
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, l_shipdate""",
)
def machine_of_play(t):
    return facts.machine_of_play(t.slot_play(), t.slot_machine())


@query(
    "staff_on_shift",
    """WITH e AS (SELECT event_id, user_id % (SELECT count(*) FROM supplier) AS s, ts FROM events),
    shift AS (SELECT DISTINCT l_suppkey, TIMESTAMP '2024-01-01' + to_hours(CAST((epoch(l_shipdate) // 86400) % 744 AS INTEGER)) AS a, to_hours(CAST(l_quantity % 5 AS INTEGER)) AS d FROM lineitem)
    SELECT event_id AS play_id, CASE WHEN count(a) > 0 THEN min(s) END AS staff_email FROM e LEFT JOIN shift ON l_suppkey = s AND ts >= a AND ts < a + d GROUP BY 1""",
)
def staff_on_shift(t):
    """Events during a shift of their table's staff. Every line is a shift of up to four hours; its ship date, counted in days, gives the hour of the month at which it starts."""
    suppliers = t.raw("supplier").agg(F.count(F.lit(1))).scalar()
    plays = t.raw("events").select(F.col("event_id").alias("play_id"), F.pmod(F.col("user_id"), suppliers).alias("table_code"), F.col("ts").alias("play_time"))
    hour = F.pmod(F.datediff("l_shipdate", F.lit("1970-01-01").cast("date")), F.lit(744))
    start = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)
    end = start + F.make_dt_interval(F.lit(0), (F.col("l_quantity") % 5).cast("int"))
    shifts = t.raw("lineitem").select(F.col("l_suppkey").alias("table_code"), F.col("l_suppkey").alias("staff_email"), start.alias("shift_start"), end.alias("shift_end")).distinct()
    return facts.staff_on_shift(plays, shifts).select("play_id", "staff_email")


# -- bridge and summaries


BRIDGE = f"""SELECT player_email AS player_key, game_name, CAST(min(play_time) AS VARCHAR) AS first_play_date, CAST(max(play_time) AS VARCHAR) AS last_play_date, count(*) AS total_plays,
    {Q.dbl('sum(amount_bet)')} AS total_bet_amount, {Q.dbl('sum(amount_won)')} AS total_win_amount"""


@query("bridge_full", f"WITH {Q.PLAYS} {BRIDGE} FROM plays GROUP BY 1, 2")
def bridge_full(t):
    return summaries.bridge(t.line_fact())


@query("bridge_accumulate", f"WITH {Q.EVENT_PLAYS} {BRIDGE} FROM eplays GROUP BY 1, 2")
def bridge_accumulate(t):
    """Totals of the plays after a date added to those before it."""
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    fact = t.event_fact(session=False)
    return summaries.bridge_add(summaries.bridge(fact.where(F.col("play_time") < cut)), fact.where(F.col("play_time") >= cut))


DAILY = f"""count(DISTINCT player_email) AS total_players, {Q.dbl('sum(amount_bet)')} AS total_bets, {Q.dbl('sum(amount_won)')} AS total_wins, {Q.dbl('sum(amount_won - amount_bet)')} AS net_revenue,
    {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS average_bet_amount, count(*) AS total_plays"""


@query("daily_summary", f"WITH {Q.PLAYS} SELECT CAST(CAST(play_time AS DATE) AS VARCHAR) AS full_date, location_code, game_name, {DAILY} FROM plays GROUP BY 1, 2, 3")
def daily_summary(t):
    return summaries.daily_summary(t.line_fact())


@query(
    "daily_player_winrate",
    f"""WITH {Q.EVENT_PLAYS} SELECT CAST(CAST(play_time AS DATE) AS VARCHAR) AS full_date, player_email AS player_key, game_name, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bet_amount,
    {Q.dbl('sum(amount_won)')} AS total_win_amount, {Q.dbl('sum(amount_won - amount_bet)')} AS net_result, {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS average_bet,
    CASE WHEN sum(amount_bet) > 0 THEN CAST(sum(amount_won) AS DOUBLE) / CAST(sum(amount_bet) AS DOUBLE) ELSE 0.0 END AS win_rate FROM eplays GROUP BY 1, 2, 3""",
)
def daily_player_winrate(t):
    return summaries.player_day_summary(t.event_fact(session=False))


@query("daily_refresh", f"WITH {Q.EVENT_PLAYS} SELECT CAST(CAST(play_time AS DATE) AS VARCHAR) AS full_date, game_name, {DAILY} FROM eplays GROUP BY 1, 2")
def daily_refresh(t):
    """A summary of the plays up to the middle of a day, refreshed with the rest: only touched groups are computed again."""
    keys = ("full_date", "game_name")
    cut = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    fact = t.event_fact(session=False)
    old = settle(summaries.daily_summary(fact.where(F.col("play_time") < cut), keys), "summary")
    return summaries.refresh(old, fact, fact.where(F.col("play_time") >= cut), keys)


# -- joins


@query(
    "star_join",
    f"""WITH {Q.PLAYS} SELECT c_mktsegment, p_type, r_name, count(*) AS plays, {Q.dbl('sum(amount_bet)')} AS total_bets FROM plays JOIN customer ON c_custkey = player_email JOIN part ON p_partkey = game_name
    JOIN nation ON n_nationkey = location_code JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3""",
)
def star_join(t):
    """Fact with three dimensions; the player join is salted."""
    people = t.raw("customer").select(F.col("c_custkey").alias("player_key"), "c_mktsegment")
    games = t.raw("part").select(F.col("p_partkey").alias("game_name"), "p_type")
    places = t.dim_location().select("location_code", F.col("country").alias("r_name"))
    rows = joins.lookup(t.line_fact(), people, "player_key", salts=4)
    rows = joins.lookup(joins.lookup(rows, games, "game_name"), places, "location_code")
    return rows.groupBy("c_mktsegment", "p_type", "r_name").agg(F.count(F.lit(1)).alias("plays"), F.sum("bet_amount").alias("total_bets"))


@query(
    "interval_left_join",
    """WITH reg AS (SELECT o_custkey, min(o_orderdate) AS r FROM orders GROUP BY 1)
    SELECT reg.o_custkey AS player_email, count(o.o_orderkey) AS late_orders FROM reg LEFT JOIN orders o ON o.o_custkey = reg.o_custkey AND o.o_orderdate >= reg.r + INTERVAL 30 DAY GROUP BY 1""",
)
def interval_left_join(t):
    """Left join on a key plus a time distance in the join condition."""
    orders = t.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    first = orders.groupBy(F.col("o_custkey").alias("player_email")).agg(F.min("o_orderdate").alias("r"))
    late = (F.col("player_email") == F.col("o_custkey")) & (F.col("o_orderdate") >= F.col("r") + F.expr("interval 30 days"))
    return first.join(orders, late, "left").groupBy("player_email").agg(F.count("o_orderkey").alias("late_orders"))


@query(
    "left_anti",
    "SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity >= 50)",
)
def left_anti(t):
    large = t.raw("lineitem").where(F.col("l_quantity") >= 50).select(F.col("l_partkey").alias("p_partkey"))
    return t.raw("part").select("p_partkey", "p_name").join(large, "p_partkey", "left_anti")


@query(
    "null_order",
    """WITH g AS (SELECT c_custkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
    SELECT c_custkey, segment, c_acctbal FROM g ORDER BY segment DESC NULLS FIRST, c_acctbal NULLS LAST, c_custkey LIMIT 50""",
)
def null_order(t):
    """Top rows with NULL first from above, last from below."""
    rows = t.raw("customer").select("c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"), "c_acctbal")
    return rows.orderBy(F.desc_nulls_first("segment"), F.asc_nulls_last("c_acctbal"), "c_custkey").limit(50)


@query(
    "distinct_concat",
    "SELECT r_name, string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nations, count(*) AS suppliers FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1",
)
def distinct_concat(t):
    """Distinct names per region as one text; names are made distinct before they are collected."""
    per_name = t.raw("supplier").groupBy(F.col("s_nationkey").alias("location_code")).agg(F.count(F.lit(1)).alias("n")).join(t.location(), "location_code")
    per_name = per_name.groupBy(F.col("country").alias("r_name"), "city").agg(F.sum("n").alias("n"))
    return per_name.groupBy("r_name").agg(F.array_join(F.array_sort(F.collect_list("city")), ", ").alias("nations"), F.sum("n").alias("suppliers"))




def placed_events(t):
    """The events as plays at the nation of their user."""
    homes = t.raw("customer").select(F.col("c_custkey").alias("player_key"), F.col("c_nationkey").alias("location_code"))
    return t.event_fact(session=False).join(homes, "player_key")


@query(
    "players_folded",
    """WITH e AS (SELECT user_id, event_type AS game_name, strftime(ts, '%Y-%m') AS month, CAST(ts AS DATE) AS day, r_name AS region FROM events JOIN customer ON c_custkey = user_id JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
    SELECT 'month and game' AS level, month AS a, game_name AS b, count(DISTINCT user_id) AS total_players FROM e GROUP BY 2, 3
    UNION ALL SELECT 'month and region', month, region, count(DISTINCT user_id) FROM e GROUP BY 2, 3
    UNION ALL SELECT 'day', CAST(day AS VARCHAR), NULL, count(DISTINCT user_id) FROM e GROUP BY 2
    UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT user_id) FROM e""",
)
def players_folded(t):
    """Distinct players of months, regions and days from the stored players of each day, place and game; the numbers of the second
    half of the month's new players come after those of the first."""
    fact = settle(placed_events(t), "placed")
    middle = F.lit("2024-01-03").cast("date")
    numbers = settle(summaries.number_players(fact.where(F.col("full_date") < middle)), "numbers")
    numbers = settle(numbers.unionByName(summaries.number_players(fact, numbers)), "all-numbers")
    stored = settle(summaries.daily_players(fact, numbers), "daily-players")
    nation, region = t.raw("nation").select(F.col("n_nationkey").alias("location_code"), "n_regionkey"), t.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    months = stored.join(nation, "location_code").join(region, "n_regionkey").withColumn("month", F.date_format("full_date", "yyyy-MM"))

    def level(name, a, b, *groups):
        none = F.lit(None).cast("string")
        named = [(F.col(c).cast("string") if c else none).alias(x) for c, x in ((a, "a"), (b, "b"))]
        return summaries.fold_players(months, *groups).select(F.lit(name).alias("level"), *named, "total_players")

    parts = [level("month and game", "month", "game_name", "month", "game_name"), level("month and region", "month", "r_name", "month", "r_name"), level("day", "full_date", None, "full_date"), level("all", None, None)]
    return reduce(DataFrame.unionByName, parts)


@query("bucketed_join", f"WITH {Q.EVENT_PLAYS}, {Q.PLAYERS} SELECT loyalty_tier, game_name, count(*) AS plays, {Q.dbl('sum(amount_bet)')} AS bets FROM eplays JOIN segments USING (player_email) GROUP BY 1, 2")
def bucketed_join(t):
    """Plays and players stored in buckets of the player: their join moves no play."""
    plays, people = bucketed_tables(t)
    return plays.join(people, "player_email").groupBy("loyalty_tier", "game_name").agg(F.count(F.lit(1)).alias("plays"), F.sum("amount_bet").alias("bets"))


def bucketed_tables(t, buckets: int = 8):
    def stored(df, label, order=()):
        path = scratch(t.spark, label)
        return tables.write_bucketed(df, "tallyhouse_" + path.rsplit("-", 1)[-1], path, "player_email", buckets, order)

    people = t.dim_player().select(F.col("player_key").alias("player_email"), "loyalty_tier")
    return stored(t.event_plays(), "bucketed-plays", ["play_time"]), stored(people, "bucketed-people")
