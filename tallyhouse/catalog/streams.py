"""Streams over the events, run until everything available is done, and whole warehouse cycles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.bindings import AS_OF
from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.history import DAMAGED, DEVICE, FEED_ROWS, damaged, priority_feed
from tallyhouse.catalog.registry import query
from tallyhouse.catalog.star import BRIDGE
from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, scd2
from tallyhouse.plans.warehouse import History, Warehouse, run_cycle
from tallyhouse.session import scratch, settle
from tallyhouse.sources.tables import all_batches, read_table
from tallyhouse.streaming import jobs

CUTS = ("2024-01-11", "2024-01-21")


def sources(t):
    """The operational tables of the events; those that take a pass over the events are stored first, as they are in use."""
    return {
        "game": settle(t.event_game(), "game"),
        "casino_location": t.location(),
        "player": t.player_basic().withColumn("registration_date", F.lit(None).cast("timestamp_ntz")),
        "staff": t.staff(),
        "login_history": t.login_history(),
        "table_game": settle(t.event_tables(), "table-game"),
        "staff_assigned_tables": settle(t.event_shifts(), "shifts"),
    }


def house_with_dimensions(t, label: str, src) -> Warehouse:
    house = Warehouse(t.spark, scratch(t.spark, label))
    house.load_dimensions(src, F.lit(AS_OF).cast("timestamp_ntz"), 0)
    return house


EVENT_PLACE = """place AS (SELECT game_name, min(code) AS table_code, arg_min(nation, code) AS location_code FROM (
  SELECT DISTINCT event_type AS game_name, c_nationkey AS nation, event_type || '-' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS code FROM events JOIN customer ON c_custkey = user_id) GROUP BY 1)"""
DAILY_SQL = f"""WITH {Q.EVENT_PLAYS}, {EVENT_PLACE}
    SELECT CAST(CAST(play_time AS DATE) AS VARCHAR) AS full_date, location_code, game_name, count(DISTINCT player_email) AS total_players, {Q.dbl('sum(amount_bet)')} AS total_bets,
    {Q.dbl('sum(amount_won)')} AS total_wins, {Q.dbl('sum(amount_won - amount_bet)')} AS net_revenue, {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS average_bet_amount, count(*) AS total_plays
    FROM eplays JOIN place USING (game_name) GROUP BY 1, 2, 3"""


@query("stream_daily_summary", DAILY_SQL)
def stream_daily_summary(t):
    """Plays arrive in three steps; after each, only the touched dates of the summary are computed again."""
    src = sources(t)
    house = house_with_dimensions(t, "stream-daily", src)
    jobs.in_steps(t.event_plays(), "play_time", CUTS, lambda plays: jobs.gaming_stream(plays, house, src, f"{house.root}/checkpoint"))
    return house.daily_summary()


@query(
    "stored_players",
    f"""WITH {Q.EVENT_PLAYS}, {EVENT_PLACE}, p AS (SELECT CAST(play_time AS DATE) AS d, location_code, game_name, player_email FROM eplays JOIN place USING (game_name))
    SELECT 'week and game' AS level, CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS a, game_name AS b, count(DISTINCT player_email) AS total_players FROM p GROUP BY 1, 2, 3
    UNION ALL SELECT 'place', CAST(location_code AS VARCHAR), NULL, count(DISTINCT player_email) FROM p GROUP BY 2
    UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT player_email) FROM p""",
)
def stored_players(t):
    """Distinct players of weeks, places and the whole time, from the bitmaps that the warehouse stores with each day of its stream."""
    src = sources(t)
    house = house_with_dimensions(t, "stored-players", src)
    jobs.in_steps(t.event_plays(), "play_time", CUTS, lambda plays: jobs.gaming_stream(plays, house, src, f"{house.root}/checkpoint"))
    none = F.lit(None).cast("string")

    def level(name, a, b, *groups):
        return house.players_by(*groups).select(F.lit(name).alias("level"), a.alias("a"), b.alias("b"), "total_players")

    week = F.trunc("full_date", "week").alias("week")
    parts = [
        level("week and game", F.col("week").cast("string"), F.col("game_name"), week, "game_name"),
        level("place", F.col("location_code").cast("string"), none, "location_code"),
        level("all", none, none),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("stream_bridge", f"WITH {Q.EVENT_PLAYS} {BRIDGE} FROM eplays GROUP BY 1, 2")
def stream_bridge(t):
    src = sources(t)
    house = house_with_dimensions(t, "stream-bridge", src)
    jobs.in_steps(t.event_plays(), "play_time", CUTS, lambda plays: jobs.gaming_stream(plays, house, src, f"{house.root}/checkpoint"))
    return house.bridge()


@query("stream_late_dimension", f"WITH {Q.EVENT_PLAYS} SELECT game_name, count(*) AS plays, {Q.dbl('sum(amount_bet)')} AS bets FROM eplays GROUP BY 1")
def stream_late_dimension(t):
    """Plays of players in debt come before these are known; they wait and are booked with the next batch."""
    src = sources(t)
    house = Warehouse(t.spark, scratch(t.spark, "stream-late"))
    early = src["player"].where(F.col("loyalty_points") >= 1000)
    at = F.lit(AS_OF).cast("timestamp_ntz")
    house.load_dimensions({**src, "player": early}, at, 0)
    jobs.in_steps(t.event_plays(), "play_time", (), lambda plays: jobs.gaming_stream(plays, house, src, f"{house.root}/checkpoint"))
    house.load_dimensions({"player": src["player"]}, at, 1)
    house.add_plays(t.event_plays().where(F.lit(False)), src, 1)
    return house.gaming().groupBy("game_name").agg(F.count(F.lit(1)).alias("plays"), F.sum("bet_amount").alias("bets"))


@query(
    "stream_txn_fact",
    f"""WITH {Q.TXN} SELECT transaction_type, CAST(CAST(transaction_time AS DATE) AS VARCHAR) AS full_date, count(*) AS n, {Q.dbl('sum(amount)')} AS amount,
    CAST(sum(CASE WHEN transaction_type = 'Bet' THEN floor(amount) ELSE 0 END) AS BIGINT) AS earned, CAST(sum(CASE WHEN transaction_type = 'Withdraw' THEN floor(amount) ELSE 0 END) AS BIGINT) AS redeemed
    FROM txn GROUP BY 1, 2""",
)
def stream_txn_fact(t):
    src = sources(t)
    house = house_with_dimensions(t, "stream-txn", src)
    rows = t.transaction().withColumn("game_name", F.lit(None).cast("string"))
    jobs.in_steps(rows, "transaction_time", CUTS, lambda stream: jobs.transaction_stream(stream, house, src, f"{house.root}/checkpoint"))
    fact = house.table("transactions")
    return fact.groupBy("transaction_type", "full_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.sum("loyalty_points_earned").alias("earned"), F.sum("loyalty_points_redeemed").alias("redeemed")
    )


@query("stream_scd2", FEED_ROWS)
def stream_scd2(t):
    """The customers' priorities as a stream in three steps, many states of a customer in each."""
    table, checkpoint = jobs.new_paths(t.spark, "stream-scd2")
    history = History(t.spark, table, "player_key")
    cuts = ("1997-01-01", "1999-01-01")
    jobs.in_steps(priority_feed(t), "at", cuts, lambda changes: jobs.scd2_stream(changes, history, ["priority"], "at", checkpoint, ["seq"], width="year"))
    return history.rows()


@query("stream_scd2_check", DAMAGED)
def stream_scd2_check(t):
    """The stored history of the stream, damaged."""
    return scd2.check(damaged(stream_scd2(t)), "player_key")


@query("stream_scd2_any_order", FEED_ROWS)
def stream_scd2_any_order(t):
    """The same states in three steps that have nothing to do with their times: most come late, into closed versions."""
    table, checkpoint = jobs.new_paths(t.spark, "stream-any-order")
    history = History(t.spark, table, "player_key")
    arrival = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("seq") * 7919 % 3).cast("int"))

    def run(changes):
        jobs.scd2_stream(changes.drop("arrival"), history, ["priority"], "at", checkpoint, ["seq"], width="year")

    jobs.in_steps(priority_feed(t).withColumn("arrival", arrival), "arrival", ("2024-01-02", "2024-01-03"), run)
    return history.rows()


WAITS = """first_seen AS (SELECT user_id, min(ts) + CASE WHEN user_id % 7 = 0 THEN INTERVAL 8 DAY ELSE INTERVAL 3 DAY END AS known_at FROM events GROUP BY 1),
people_seen AS (SELECT user_id, CASE WHEN user_id % 3 = 0 OR user_id % 10 = 1 THEN NULL ELSE known_at END AS known_at FROM first_seen),
passed AS (SELECT least((SELECT max(ts) FROM events), max(known_at)) - INTERVAL 1 HOUR AS w FROM (SELECT known_at FROM people_seen
  UNION ALL SELECT TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 31 AS INTEGER)) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)))"""


@query(
    "stream_waiting_plays",
    f"""WITH {Q.PLAYERS}, {WAITS}, e AS (SELECT event_id, user_id, event_type, ts, loyalty_tier, CASE WHEN user_id % 3 = 0 THEN 'known' WHEN known_at <= ts + INTERVAL 5 DAY THEN 'waited' ELSE 'unmatched' END AS booked
      FROM events JOIN people_seen USING (user_id) JOIN segments ON player_email = user_id)
    SELECT event_id, user_id AS player_email, event_type AS game_name, CAST(ts AS VARCHAR) AS play_time, booked, CASE WHEN booked <> 'unmatched' THEN loyalty_tier END AS loyalty_tier
    FROM e, passed WHERE booked <> 'unmatched' OR ts + INTERVAL 5 DAY <= w""",
)
def stream_waiting_plays(t):
    """A third of the players is known; the others come as a stream some days after their first play, or never, among players who
    don't play. The plays wait in the stream itself and come out with the player, or without when it is too late for that."""
    table, checkpoint = jobs.new_paths(t.spark, "stream-waiting")
    plays = t.raw("events").select("event_id", F.col("user_id").alias("player_email"), F.col("event_type").alias("game_name"), F.col("ts").alias("play_time"))
    people = settle(t.dim_player().select(F.col("player_key").alias("player_email"), "loyalty_tier"), "people")
    k = F.col("player_email")
    later = F.when(k % 7 == 0, F.expr("interval 8 days")).otherwise(F.expr("interval 3 days"))
    first = plays.groupBy("player_email").agg(F.min("play_time").alias("first_play")).where((k % 3 != 0) & (k % 10 != 1))
    idle = people.join(plays, "player_email", "left_anti").select("player_email", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval((k % 31).cast("int"))).alias("known_at"))
    new = first.select("player_email", (F.col("first_play") + later).alias("known_at")).unionByName(idle).join(people, "player_email").select("player_email", "known_at", "loyalty_tier")
    games = settle(t.event_game().select("game_name"), "games")

    def run(some_plays, some_players):
        rows = jobs.waiting_plays(some_plays, some_players, people.where(k % 3 == 0), games, ["loyalty_tier"], "5 days", "40 days", "1 hour")
        jobs.run_append(rows, table, checkpoint)

    jobs.in_steps_together([(plays, "play_time"), (new, "known_at")], CUTS, run, "waiting")
    return read_table(t.spark, table).withColumn("play_time", F.col("play_time").cast("timestamp_ntz"))


@query("stream_devices", f"WITH {DEVICE} SELECT DISTINCT device_type, device AS device_model FROM devices")
def stream_devices(t):
    table, checkpoint = jobs.new_paths(t.spark, "stream-device")
    jobs.in_steps(t.login_history(), "login_time", CUTS, lambda logins: jobs.device_stream(logins, table, checkpoint))
    return all_batches(t.spark, table).select("device_type", "device_model")


SHIFT = "CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 1 WHEN ts < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END"


@query(
    "stream_dedup",
    f"""WITH a AS (SELECT event_id, user_id, event_type, ts, {SHIFT} AS step FROM events),
    again AS (SELECT event_id, user_id, event_type, ts + INTERVAL 10 DAY AS ts, step + 1 AS step, ts AS first_ts FROM a WHERE event_id % 3 = 1 AND step < 3),
    seen AS (SELECT step, ts FROM a UNION ALL SELECT step, ts FROM again),
    mark AS (SELECT step + 1 AS step, max(max(ts)) OVER (ORDER BY step) - INTERVAL 1 HOUR AS w FROM seen GROUP BY step)
    SELECT event_id, user_id, event_type, CAST(ts AS VARCHAR) AS ts FROM a
    UNION ALL SELECT event_id, user_id, event_type, CAST(ts AS VARCHAR) FROM again JOIN mark USING (step) WHERE first_ts + INTERVAL 1 HOUR <= w""",
)
def stream_dedup(t):
    """A third of the events comes again in the next step and is left out; of another third the id is used again ten days later,
    which counts as new unless the watermark still keeps the first one."""
    table, checkpoint = jobs.new_paths(t.spark, "stream-dedup")
    first = t.raw("events").select("event_id", "user_id", "event_type", "ts", F.col("ts").alias("arrival"))
    ten, early = F.expr("interval 10 days"), F.col("ts") < F.lit(CUTS[1]).cast("timestamp_ntz")
    again = first.where((F.col("event_id") % 3 == 0) & early).withColumn("arrival", F.col("ts") + ten)
    reused = first.where((F.col("event_id") % 3 == 1) & early).withColumn("ts", F.col("ts") + ten).withColumn("arrival", F.col("ts"))
    feed = first.unionByName(again).unionByName(reused)
    jobs.in_steps(feed, "arrival", CUTS, lambda stream: jobs.run_append(jobs.deduplicated(stream.drop("arrival"), ["event_id"], "ts", "1 hour"), table, checkpoint))
    return read_table(t.spark, table).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# A window is given out when the watermark, one hour behind the last event, has passed its end.
CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def event_plays_with_arrival(t):
    """Every fiftieth play arrives ten days late."""
    plays = t.event_plays()
    slow = F.unix_micros(F.col("play_time").cast("timestamp")) % 50 == 0
    return plays.withColumn("arrival", F.when(slow, F.col("play_time") + F.expr("interval 10 days")).otherwise(F.col("play_time")))


@query(
    "stream_tumbling",
    f"""WITH a AS (SELECT *, {Q.EVENT_BET} AS bet, date_trunc('hour', ts) + INTERVAL 1 HOUR AS e, CASE WHEN epoch_us(ts) % 50 = 0 THEN ts + INTERVAL 10 DAY ELSE ts END AS arrival FROM events),
    s AS (SELECT *, CASE WHEN arrival < TIMESTAMP '2024-01-11' THEN 1 WHEN arrival < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS step FROM a),
    mark AS (SELECT step + 1 AS step, max(max(ts)) OVER (ORDER BY step) - INTERVAL 1 HOUR AS w FROM s GROUP BY step),
    r AS (SELECT s.*, coalesce(e <= w, false) AS late FROM s LEFT JOIN mark USING (step))
    SELECT CAST(e - INTERVAL 1 HOUR AS VARCHAR) AS window_start, CAST(e AS VARCHAR) AS window_end, event_type AS game_name, count(*) FILTER (WHERE NOT late) AS n, {Q.dbl('sum(bet) FILTER (WHERE NOT late)')} AS total, count(*) FILTER (WHERE late) AS late
    FROM r WHERE e <= {CLOSED} GROUP BY e, event_type""",
)
def stream_tumbling(t):
    """Hours with totals, and for each how many plays came too late for it."""
    table, checkpoint = jobs.new_paths(t.spark, "stream-tumbling")
    plays = event_plays_with_arrival(t)
    jobs.in_steps(plays, "arrival", CUTS, lambda stream: jobs.run_append(jobs.tumbling(stream.drop("arrival"), "play_time", "1 hour", "1 hour", ["game_name"], "amount_bet"), table, checkpoint))
    closed = plays.agg(F.max("play_time") - F.expr("interval 1 hour")).scalar()
    return jobs.with_late(read_table(t.spark, table).drop("players"), plays, "play_time", "1 hour", ["game_name"], closed)


@query(
    "stream_players",
    f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS game_name, count(DISTINCT user_id) AS players, true AS near FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED} GROUP BY 1, 2""",
)
def stream_players(t):
    """Players by day and game, folded from the sketches of the stream's hours, and if the estimate is within the stated error."""
    table, checkpoint = jobs.new_paths(t.spark, "stream-players")
    jobs.in_steps(t.event_plays(), "play_time", CUTS, lambda plays: jobs.run_append(jobs.tumbling(plays, "play_time", "1 hour", "1 hour", ["game_name"], "amount_bet"), table, checkpoint))
    hours = read_table(t.spark, table)
    estimate = jobs.players_by(hours, F.to_date("window_start").alias("day"), "game_name").withColumnRenamed("players", "estimate")
    last = hours.agg(F.max("window_end")).scalar()
    exact = t.event_plays().where(F.date_trunc("hour", F.col("play_time").cast("timestamp")).cast("timestamp_ntz") < last).groupBy(F.to_date("play_time").alias("day"), "game_name").agg(F.count_distinct("player_email").alias("players"))
    near = F.abs(F.col("estimate") - F.col("players")) <= F.greatest(F.lit(1), F.col("players") * jobs.SKETCH_ERROR)
    return exact.join(estimate, ["day", "game_name"]).select("day", "game_name", "players", near.alias("near"))


@query(
    "stream_sliding",
    f"""WITH w AS (SELECT unnest([0, 1, 2, 3, 4, 5]) AS i, ts, event_type, {Q.EVENT_BET} AS bet FROM events),
    s AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - i * INTERVAL 10 MINUTE AS a, event_type, bet FROM w)
    SELECT CAST(a AS VARCHAR) AS window_start, CAST(a + INTERVAL 1 HOUR AS VARCHAR) AS window_end, event_type AS game_name, count(*) AS n, {Q.dbl('sum(bet)')} AS total
    FROM s GROUP BY a, event_type HAVING a + INTERVAL 1 HOUR <= {CLOSED}""",
)
def stream_sliding(t):
    table, checkpoint = jobs.new_paths(t.spark, "stream-sliding")
    jobs.in_steps(t.event_plays(), "play_time", CUTS, lambda plays: jobs.run_append(jobs.sliding(plays, "play_time", "1 hour", "10 minutes", "1 hour", ["game_name"], "amount_bet"), table, checkpoint))
    return read_table(t.spark, table).drop("players")


@query(
    "stream_sessions",
    f"""WITH s AS (SELECT user_id, ts, {Q.EVENT_BET} AS bet, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS no FROM s)
    SELECT user_id AS player_email, CAST(min(ts) AS VARCHAR) AS session_start, CAST(max(ts) + INTERVAL 30 MINUTE AS VARCHAR) AS session_end, count(*) AS events, {Q.dbl('sum(bet)')} AS total,
    epoch_us(max(ts)) - epoch_us(min(ts)) AS duration_us FROM n GROUP BY user_id, no HAVING max(ts) + INTERVAL 30 MINUTE <= {CLOSED}""",
)
def stream_sessions(t):
    table, checkpoint = jobs.new_paths(t.spark, "stream-sessions")
    jobs.in_steps(t.event_plays(), "play_time", CUTS, lambda plays: jobs.run_append(jobs.sessions(plays, "play_time", "30 minutes", "1 hour", "player_email", "amount_bet"), table, checkpoint))
    return read_table(t.spark, table)


@query(
    "stream_staff",
    """WITH c AS (SELECT s_suppkey, unnest([0, 1, 2]) AS step, s_name, s_nationkey FROM supplier),
    p AS (SELECT *, CASE WHEN s_suppkey % 3 = 0 AND step > 0 THEN 'Floor Manager' WHEN s_suppkey % 3 = 1 AND step = 2 THEN 'Security' ELSE 'Dealer' END AS position FROM c WHERE NOT (s_suppkey % 7 = 0 AND step = 0)),
    f AS (SELECT *, lag(position) OVER w AS before FROM p WINDOW w AS (PARTITION BY s_suppkey ORDER BY step)),
    v AS (SELECT s_suppkey, s_name, s_nationkey, position, step, lead(step) OVER w AS until, row_number() OVER w AS version_number FROM f WHERE before IS NULL OR before <> position WINDOW w AS (PARTITION BY s_suppkey ORDER BY step))
    SELECT s_suppkey AS staff_key, s_name AS first_name, CAST(s_nationkey AS VARCHAR) AS last_name, position, CASE position WHEN 'Floor Manager' THEN 'Management' WHEN 'Security' THEN 'Security' ELSE 'Gaming' END AS department,
      true AS is_active, CAST(TIMESTAMP '2024-01-01' + to_days(CAST(step AS INTEGER)) AS VARCHAR) AS start_date, CAST(TIMESTAMP '2024-01-01' + to_days(CAST(until AS INTEGER)) AS VARCHAR) AS end_date, until IS NULL AS is_current, version_number FROM v""",
)
def stream_staff(t):
    """States of the staff on three days as a stream: some are promoted, some come late; each step is a batch of its own."""
    k, step = F.col("staff_email"), F.col("step")
    states = t.staff().withColumn("step", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).where(~((k % 7 == 0) & (step == 0)))
    position = F.when((k % 3 == 0) & (step > 0), "Floor Manager").when((k % 3 == 1) & (step == 2), "Security").otherwise("Dealer")
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(step)
    feed = states.withColumn("position", position).select(F.col("staff_email").alias("staff_key"), "first_name", "last_name", "position", S.department("position").alias("department"), F.lit(True).alias("is_active"), at.alias("at"))
    table, checkpoint = jobs.new_paths(t.spark, "stream-staff")
    history = History(t.spark, table, "staff_key")
    jobs.in_steps(feed, "at", ("2024-01-02", "2024-01-03"), lambda changes: jobs.scd2_stream(changes, history, dimensions.STAFF_TRACKED, "at", checkpoint))
    return history.rows()


# -- cycles


LOADED = {
    "dim_time": ("count(DISTINCT CAST(ts AS DATE))", "(SELECT sum(day(d)) FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events))", "events", lambda: F.sum("day_of_month")),
    "dim_game": ("count(DISTINCT event_type)", "(SELECT sum(m) FROM (SELECT max(CAST(value AS DECIMAL(10,2))) AS m FROM events GROUP BY event_type))", "events", lambda: F.sum("max_bet")),
    "dim_location": ("count(*)", "sum(length(n_name) + 6)", "nation", lambda: F.sum(F.length("location_name"))),
    "dim_slot_machine": ("count(*)", "count(*) FILTER (WHERE s_suppkey % 3 = 0)", "supplier", lambda: F.count_if("is_active")),
    "dim_player": ("count(*)", f"sum(length({Q.TIER_WAREHOUSE.format(p='CAST(floor(c_acctbal) AS BIGINT)')}))", "customer", lambda: F.sum(F.length("loyalty_tier"))),
    "dim_staff": ("count(*)", "sum(CASE s_suppkey % 5 WHEN 0 THEN 10 WHEN 1 THEN 6 WHEN 2 THEN 8 ELSE 10 END)", "supplier", lambda: F.sum(F.length("department"))),
    "dim_device": ("count(DISTINCT device)", "count(DISTINCT device) FILTER (WHERE device_type = 'Mobile')", "devices", lambda: F.count_if("is_mobile")),
    "gaming": ("count(*)", "sum(amount_won - amount_bet)", "eplays", lambda: F.sum("net_result")),
    "transactions": ("count(*)", "sum(amount)", "txn", lambda: F.sum("amount")),
    "bridge_changes": ("count(DISTINCT (player_email, game_name))", "sum(amount_won)", "eplays", lambda: F.sum("total_win_amount")),
    "daily_summary": ("count(DISTINCT (CAST(play_time AS DATE), game_name))", "count(DISTINCT (CAST(play_time AS DATE), game_name, player_email))", "eplays", lambda: F.sum("total_players")),
}


@query(
    "initial_load",
    f"WITH {DEVICE}, {Q.EVENT_PLAYS}, {Q.TXN} " + " UNION ALL ".join(f"SELECT '{n}' AS table_name, {rows} AS row_count, {Q.dbl(total)} AS total FROM {source}" for n, (rows, total, source, _) in LOADED.items()),
)
def initial_load(t):
    """Everything from the sources to the summaries in one cycle: rows and a total of values for each table."""
    src = sources(t) | {"player_game": t.event_plays(), "slot_machine": t.slot_machine(), "transaction": t.transaction().withColumn("game_name", F.lit(None).cast("string"))}
    house = Warehouse(t.spark, scratch(t.spark, "initial"))
    run_cycle(house, src, F.lit(AS_OF).cast("timestamp_ntz"), 0)
    whole = {"daily_summary": house.daily_summary, "dim_player": house.players.rows, "dim_staff": house.staff.rows}
    tables = {n: whole[n]() if n in whole else house.table(n) for n in LOADED}
    counted = [tables[n].agg(F.count(F.lit(1)).alias("row_count"), total().cast("double").alias("total")).select(F.lit(n).alias("table_name"), "row_count", "total") for n, (*_, total) in LOADED.items()]
    return reduce(DataFrame.unionByName, counted)


HALF = "2024-01-15 12:00:00"
NET = Q.dbl("amount_won - amount_bet")
KEYS = "CAST({a} AS VARCHAR) AS key_a, CAST({b} AS VARCHAR) AS key_b, CAST({c} AS VARCHAR) AS key_c"


@query(
    "load_then_stream",
    f"""WITH {Q.EVENT_FACT}, {EVENT_PLACE}, {Q.TXN}
    SELECT 'gaming' AS table_name, {KEYS.format(a='player_email', b='game_name', c='play_time')}, 1 AS n, {NET} AS total, minutes FROM efact
    UNION ALL SELECT 'bridge', {KEYS.format(a='player_email', b='game_name', c='max(play_time)')}, count(*), {Q.dbl('sum(amount_bet)')}, NULL FROM efact GROUP BY player_email, game_name
    UNION ALL SELECT 'daily', {KEYS.format(a='full_date', b='location_code', c='game_name')}, count(DISTINCT player_email), {Q.dbl('sum(amount_won - amount_bet)')}, NULL FROM efact JOIN place USING (game_name) GROUP BY full_date, location_code, game_name
    UNION ALL SELECT 'transactions', {KEYS.format(a='transaction_code', b='transaction_type', c='transaction_time')}, 1, {Q.dbl('amount')}, NULL FROM txn""",
)
def load_then_stream(t):
    """A first load of the events up to the middle, numbered 0, then the rest as streams in two steps, numbered from 0 too, into one warehouse."""
    src = sources(t)
    house = Warehouse(t.spark, scratch(t.spark, "load-stream"))
    plays, money = t.event_plays(), t.transaction().withColumn("game_name", F.lit(None).cast("string"))
    middle = F.lit(HALF).cast("timestamp_ntz")
    first = {"player_game": plays.where(F.col("play_time") < middle), "transaction": money.where(F.col("transaction_time") < middle)}
    run_cycle(house, src | first, F.lit(AS_OF).cast("timestamp_ntz"), 0, session="hour")
    later = plays.where(F.col("play_time") >= middle)
    jobs.in_steps(later, "play_time", CUTS[1:], lambda stream: jobs.gaming_stream(stream, house, src, f"{house.root}/checkpoint-plays", session="hour"))
    later = money.where(F.col("transaction_time") >= middle)
    jobs.in_steps(later, "transaction_time", CUTS[1:], lambda stream: jobs.transaction_stream(stream, house, src, f"{house.root}/checkpoint-money"))

    def shaped(df, name, a, b, c, n, total, minutes=None):
        keys = [F.col(x).cast("string").alias(k) for x, k in ((a, "key_a"), (b, "key_b"), (c, "key_c"))]
        extra = F.col(minutes) if minutes else F.lit(None)
        return df.select(F.lit(name).alias("table_name"), *keys, n.cast("long").alias("n"), F.col(total).cast("double").alias("total"), extra.cast("long").alias("minutes"))

    one = F.lit(1)
    parts = [
        shaped(house.gaming(), "gaming", "player_key", "game_name", "play_time", one, "net_result", "session_duration_minutes"),
        shaped(house.bridge(), "bridge", "player_key", "game_name", "last_play_date", F.col("total_plays"), "total_bet_amount"),
        shaped(house.daily_summary(), "daily", "full_date", "location_code", "game_name", F.col("total_players"), "net_revenue"),
        shaped(house.table("transactions"), "transactions", "transaction_code", "transaction_type", "transaction_time", one, "amount"),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("incremental_cycle", DAILY_SQL)
def incremental_cycle(t):
    """A first load up to a date and a cycle with all plays from a little before it: the summary is that of all plays."""
    src = sources(t)
    house = Warehouse(t.spark, scratch(t.spark, "cycle"))
    plays = t.event_plays()
    run_cycle(house, src | {"player_game": plays.where(F.col("play_time") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))}, F.lit(AS_OF).cast("timestamp_ntz"), 0)
    later = plays.where(F.col("play_time") >= F.lit("2024-01-19").cast("timestamp_ntz"))
    run_cycle(house, src | {"player_game": later}, F.lit("2024-02-02").cast("timestamp_ntz"), 1)
    return house.daily_summary()


MENDED = "(play_time < TIMESTAMP '2024-01-15 12:00:00' OR play_time >= TIMESTAMP '2024-01-28' OR (play_time < TIMESTAMP '2024-01-24' AND player_email % 5 <> 0))"


@query(
    "cycle_mended",
    f"""WITH {Q.EVENT_PLAYS}, {EVENT_PLACE}, kept AS (SELECT * FROM eplays WHERE {MENDED}),
    k AS (SELECT *, (epoch_us(play_time) - epoch_us(LAG(play_time) OVER (PARTITION BY player_email ORDER BY play_time, game_name, amount_bet)) + 30000000) // 60000000 AS minutes FROM kept)
    SELECT 'gaming' AS table_name, CAST(player_email AS VARCHAR) AS key_a, game_name AS key_b, CAST(play_time AS VARCHAR) AS key_c, 1 AS n, {NET} AS total, minutes FROM k
    UNION ALL SELECT 'bridge', CAST(player_email AS VARCHAR), game_name, CAST(max(play_time) AS VARCHAR), count(*), {Q.dbl('sum(amount_bet)')}, NULL FROM k GROUP BY player_email, game_name
    UNION ALL SELECT 'daily', CAST(CAST(play_time AS DATE) AS VARCHAR), CAST(location_code AS VARCHAR), game_name, count(DISTINCT player_email), {Q.dbl('sum(amount_won - amount_bet)')}, NULL
      FROM k JOIN place USING (game_name) GROUP BY CAST(play_time AS DATE), location_code, game_name
    UNION ALL SELECT 'players', CAST(CAST(play_time AS DATE) AS VARCHAR), NULL, NULL, count(DISTINCT player_email), NULL, NULL FROM k GROUP BY CAST(play_time AS DATE)""",
)
def cycle_mended(t):
    """Three batches, of which the second had players and days too many: it runs again with the right rows after the third. Nothing of
    the wrong run is left in the plays' minutes, the totals, the daily summary or the stored players."""
    src = sources(t)
    house = house_with_dimensions(t, "mended", src)
    all_plays, at, k = t.event_plays(), F.col("play_time"), F.col("player_email")
    middle, day24, day28 = (F.lit(x).cast("timestamp_ntz") for x in (HALF, "2024-01-24", "2024-01-28"))
    wrong = all_plays.where((at >= middle) & (at < day28))
    right = wrong.where((at < day24) & (k % 5 != 0))
    for n, plays in ((0, all_plays.where(at < middle)), (1, wrong), (2, all_plays.where(at >= day28)), (1, right)):
        house.add_plays(plays, src, n, "hour")

    def shaped(df, name, keys, n, total=None, minutes=None):
        keys = [(F.col(c).cast("string") if c else F.lit(None).cast("string")).alias(f"key_{x}") for c, x in zip(keys, "abc", strict=True)]
        value = (F.col(total) if total else F.lit(None)).cast("double").alias("total")
        return df.select(F.lit(name).alias("table_name"), *keys, n.cast("long").alias("n"), value, (F.col(minutes) if minutes else F.lit(None)).cast("long").alias("minutes"))

    parts = [
        shaped(house.gaming(), "gaming", ("player_key", "game_name", "play_time"), F.lit(1), "net_result", "session_duration_minutes"),
        shaped(house.bridge(), "bridge", ("player_key", "game_name", "last_play_date"), F.col("total_plays"), "total_bet_amount"),
        shaped(house.daily_summary(), "daily", ("full_date", "location_code", "game_name"), F.col("total_players"), "net_revenue"),
        shaped(house.players_by("full_date"), "players", ("full_date", None, None), F.col("total_players")),
    ]
    return reduce(DataFrame.unionByName, parts)
