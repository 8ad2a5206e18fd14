"""Dimensions and their history."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.bindings import AS_OF
from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.registry import query
from tallyhouse.functions import presets as P
from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, scd2
from tallyhouse.session import settle

DATE_COLUMNS = """CAST(strftime({d}, '%Y%m%d') AS BIGINT) AS time_id, CAST({d} AS VARCHAR) AS full_date, dayname({d}) AS day_of_week, day({d}) AS day_of_month, monthname({d}) AS month_name,
    month({d}) AS month_number, quarter({d}) AS quarter, year({d}) AS year, dayofweek({d}) IN (0, 6) AS is_weekend, false AS is_holiday"""


@query("date_dim", f"SELECT {DATE_COLUMNS.format(d='d')} FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)")
def date_dim(t):
    return dimensions.date_dim(t.raw("events"), "ts")


@query(
    "date_dim_range",
    f"SELECT {DATE_COLUMNS.format(d='d')} FROM (SELECT CAST(unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders), INTERVAL 1 DAY)) AS DATE) AS d)",
)
def date_dim_range(t):
    return dimensions.date_dim_span(t.raw("orders"), "o_orderdate")


@query("ensure_dates", f"SELECT {DATE_COLUMNS.format(d='d')} FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)")
def ensure_dates(t):
    return dimensions.ensure_dates(dimensions.date_dim(t.raw("orders"), "o_orderdate"), t.raw("lineitem"), "l_shipdate")


@query("dim_type0", "SELECT p_partkey AS game_name, p_type AS game_type, CAST(p_size AS DOUBLE) AS min_bet, p_retailprice AS max_bet, true AS is_active FROM part")
def dim_type0(t):
    """Games of a first load, then all of them: the first rows stay."""
    first = dimensions.game_dim(t.game().where(F.col("type") != "PROMO"))
    return dimensions.game_dim(t.game(), first).drop("game_id")


@query("dim_location", "SELECT n_nationkey AS location_code, 'House ' || n_name AS location_name, n_name AS city, r_name AS state, r_name AS country, true AS is_active FROM nation JOIN region ON r_regionkey = n_regionkey")
def dim_location(t):
    return t.dim_location().drop("location_id")


@query("dim_flagged", "SELECT s_suppkey AS machine_code, 'M' || (s_suppkey % 7) AS model, s_suppkey % 3 = 0 AS is_active FROM supplier")
def dim_flagged(t):
    return dimensions.slot_machine_dim(t.slot_machine()).drop("slot_machine_id")


DEVICE = """dev AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'view' THEN 'Android Mobile' WHEN 'click' THEN 'iPad tablet' WHEN 'error' THEN 'Mobile Tablet' ELSE 'Laptop' END
  || ' ' || regexp_extract(props, '([0-9]+)', 1) AS device FROM events),
devices AS (SELECT *, CASE WHEN device ILIKE '%Mobile%' THEN 'Mobile' WHEN device ILIKE '%Tablet%' THEN 'Tablet' ELSE 'Desktop' END AS device_type FROM dev)"""


@query(
    "device_dim",
    f"""WITH {DEVICE} SELECT DISTINCT device_type, device AS device_model, CAST(NULL AS VARCHAR) AS operating_system, CAST(NULL AS VARCHAR) AS browser,
    device_type = 'Mobile' AS is_mobile, device_type = 'Tablet' AS is_tablet, device_type = 'Desktop' AS is_desktop FROM devices""",
)
def device_dim(t):
    """Devices of the logins up to a date, then of all."""
    logins = t.login_history()
    first = dimensions.device_dim(logins.where(F.col("login_time") < F.lit("2024-01-15").cast("timestamp_ntz")))
    return dimensions.device_dim(logins, first).drop("device_id")


@query("device_class", f"WITH {DEVICE} SELECT device_type, count(*) AS logins FROM devices GROUP BY 1")
def device_class(t):
    return t.login_history().groupBy(S.device_class("device").alias("device_type")).agg(F.count(F.lit(1)).alias("logins"))


@query(
    "department_map",
    """SELECT s_suppkey AS staff_key, CASE s_suppkey % 5 WHEN 0 THEN 'Floor Manager' WHEN 1 THEN 'Dealer' WHEN 2 THEN 'Security' WHEN 3 THEN 'Cashier' ELSE 'Technician' END AS position,
    CASE s_suppkey % 5 WHEN 0 THEN 'Management' WHEN 1 THEN 'Gaming' WHEN 2 THEN 'Security' ELSE 'Operations' END AS department FROM supplier""",
)
def department_map(t):
    return dimensions.staff_rows(t.staff()).select("staff_key", "position", "department")


BAND_REPORT = "CASE WHEN {y} < 25 THEN '18-24' WHEN {y} < 35 THEN '25-34' WHEN {y} < 50 THEN '35-49' ELSE '50+' END"


@query(
    "player_attributes",
    f"""WITH {Q.PLAYERS} SELECT player_email, {Q.age('dob')} AS age, {Q.band(Q.age('dob'))} AS age_group, {BAND_REPORT.format(y=Q.age('dob'))} AS age_group_report,
    {Q.TIER_WAREHOUSE.format(p='loyalty_points')} AS tier, {Q.TIER_REPORT.format(p='loyalty_points')} AS tier_report FROM people""",
)
def player_attributes(t):
    at = F.lit(AS_OF).cast("date")
    return t.player_basic().select(
        F.col("email").alias("player_email"),
        S.years_between(at, "dob").alias("age"),
        S.age_band("dob", at).alias("age_group"),
        S.age_band("dob", at, P.BANDS_REPORT, P.BANDS_REPORT_DEFAULT).alias("age_group_report"),
        S.tier("loyalty_points").alias("tier"),
        S.tier("loyalty_points", P.TIERS_REPORT).alias("tier_report"),
    )


@query(
    "scd2_init",
    f"""WITH {Q.PLAYERS}, reg AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1)
    SELECT player_email AS player_key, first_name, last_name, age_group, CAST(d AS VARCHAR) AS registration_date, loyalty_tier, '2024-02-01 00:00:00' AS start_date, CAST(NULL AS VARCHAR) AS end_date,
    true AS is_current, 1 AS version_number FROM segments LEFT JOIN reg ON o_custkey = player_email""",
)
def scd2_init(t):
    rows = dimensions.player_rows(t.player(), F.lit(AS_OF).cast("date"))
    return scd2.init(rows, F.lit(AS_OF).cast("timestamp_ntz"))


def changed_players(t):
    """The players a month later: some with more points, some gone, some new."""
    k = F.col("email")
    rows = t.player_basic().withColumn("copy", F.explode(F.when(k % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    kept = rows.where((F.col("copy") == 1) | (k % 11 != 0))
    return kept.select(
        F.when(F.col("copy") == 1, -k - 1).otherwise(k).alias("email"),
        "first_name",
        "last_name",
        "dob",
        F.lit(None).cast("timestamp_ntz").alias("registration_date"),
        (F.col("loyalty_points") + F.when(k % 7 == 0, 3000).otherwise(0)).alias("loyalty_points"),
    )


def merged_players(t):
    later = F.lit("2024-03-01")
    dim = t.dim_player().drop("player_id")
    rows = dimensions.player_rows(changed_players(t), later.cast("date"))
    return scd2.merge(dim, rows, "player_key", dimensions.PLAYER_TRACKED, later.cast("timestamp_ntz"))


@query(
    "scd2_merge",
    f"""WITH {Q.PLAYERS}, inc AS (
      SELECT player_email AS k, player_email AS src, first_name, last_name, dob, loyalty_points + CASE WHEN player_email % 7 = 0 THEN 3000 ELSE 0 END AS p FROM people WHERE player_email % 11 <> 0
      UNION ALL SELECT -player_email - 1, player_email, first_name, last_name, dob, loyalty_points + CASE WHEN player_email % 7 = 0 THEN 3000 ELSE 0 END FROM people WHERE player_email % 13 = 0),
    i AS (SELECT k, first_name, last_name, {Q.TIER_WAREHOUSE.format(p='p')} AS tier, {Q.band(Q.age('dob', "DATE '2024-03-01'"))} AS age_group FROM inc),
    d AS (SELECT s.*, i.k IS NOT NULL AND i.tier <> s.loyalty_tier AS changed FROM segments s LEFT JOIN i ON i.k = s.player_email)
    SELECT player_email AS player_key, first_name, last_name, age_group, loyalty_tier, '2024-02-01 00:00:00' AS start_date, CASE WHEN changed THEN '2024-03-01 00:00:00' END AS end_date,
      NOT changed AS is_current, 1 AS version_number FROM d
    UNION ALL SELECT i.k, i.first_name, i.last_name, i.age_group, i.tier, '2024-03-01 00:00:00', NULL, true, CASE WHEN d.player_email IS NULL THEN 1 ELSE 2 END
      FROM i LEFT JOIN d ON d.player_email = i.k WHERE d.player_email IS NULL OR d.changed""",
)
def scd2_merge(t):
    return merged_players(t).drop("registration_date")


# Keys with more states are cut, so that both ways run on the test tables.
BUSY = 12


# The orders of a customer as a change feed: each order states the priority the customer has from then on.
def priority_feed(t):
    return t.raw("orders").select(F.col("o_custkey").alias("player_key"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("seq"))


def feed_history(t):
    return scd2.build(priority_feed(t), "player_key", ["priority"], "at", ["seq"], width="year", hot_rows=BUSY)


FEED = """s AS (SELECT o_custkey AS player_key, o_orderpriority AS priority, o_orderdate AS since, o_orderkey AS seq,
    lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders),
v AS (SELECT player_key, priority, since, lead(since) OVER (PARTITION BY player_key ORDER BY since, seq) AS until, row_number() OVER (PARTITION BY player_key ORDER BY since, seq) AS version_number
    FROM s WHERE before IS NULL OR before <> priority)"""
FEED_ROWS = f"""WITH {FEED} SELECT player_key, priority, CAST(since AS VARCHAR) AS start_date, CAST(until AS VARCHAR) AS end_date, until IS NULL AS is_current, version_number FROM v"""


@query("scd2_feed", FEED_ROWS)
def scd2_feed(t):
    """Many versions per key from one batch, the history of a busy key cut by year."""
    return feed_history(t)


@query("scd2_feed_in_two_batches", FEED_ROWS)
def scd2_feed_in_two_batches(t):
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    feed = priority_feed(t)
    first = settle(scd2.build(feed.where(F.col("at") < cut), "player_key", ["priority"], "at", ["seq"], width="year", hot_rows=BUSY), "history")
    return scd2.merge(first, feed.where(F.col("at") >= cut), "player_key", ["priority"], "at", ["seq"], width="year", hot_rows=BUSY)


@query(
    "scd2_asof",
    f"""WITH {FEED}, p AS (SELECT o_custkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT priority, count(*) AS plays FROM p LEFT JOIN v ON player_key = o_custkey AND l_shipdate >= since AND (until IS NULL OR l_shipdate < until) GROUP BY 1""",
)
def scd2_asof(t):
    """Plays by the priority the customer had when the line shipped."""
    plays = t.plays().select(F.col("player_email").alias("player_key"), "play_time")
    found = scd2.as_of(plays, feed_history(t), "player_key", "play_time", ["priority"])
    return found.groupBy("priority").agg(F.count(F.lit(1)).alias("plays"))


@query("scd2_current", f"WITH {FEED} SELECT priority, count(*) AS players FROM v WHERE until IS NULL GROUP BY 1")
def scd2_current(t):
    return scd2.current(feed_history(t)).groupBy("priority").agg(F.count(F.lit(1)).alias("players"))


DAMAGED = f"""WITH {FEED}, r AS (SELECT player_key, since, CASE WHEN player_key % 7 = 0 AND version_number = 1 THEN until + INTERVAL 400 DAY ELSE until END AS until, until IS NULL AND player_key % 11 <> 0 AS is_current, version_number
      FROM v WHERE NOT (player_key % 5 = 0 AND version_number = 2)),
    seen AS (SELECT *, lead(since) OVER w AS follow, coalesce(lag(version_number) OVER w, 0) AS before FROM r WINDOW w AS (PARTITION BY player_key ORDER BY since, version_number)),
    k AS (SELECT player_key, count(*) FILTER (WHERE is_current) AS n FROM r GROUP BY 1)
    SELECT unnest(['overlap', 'gap', 'version_jump', 'open_flag', 'one_current']) AS rule, unnest([count(*) FILTER (WHERE until > follow), count(*) FILTER (WHERE follow IS NOT NULL AND (until IS NULL OR until < follow)),
      count(*) FILTER (WHERE version_number <> before + 1), count(*) FILTER (WHERE is_current <> (until IS NULL)), (SELECT count(*) FROM k WHERE n <> 1)]) AS breaches FROM seen"""


def damaged(history):
    """Second versions lost, first ends moved, open flags unset."""
    key, first = F.col("player_key"), F.col("version_number") == 1
    moved = F.when((key % 7 == 0) & first, F.col("end_date") + F.expr("interval 400 days")).otherwise(F.col("end_date"))
    rows = history.where(~((key % 5 == 0) & (F.col("version_number") == 2)))
    return settle(rows.withColumns({"end_date": moved, "is_current": F.col("is_current") & (key % 11 != 0)}), "history")


@query("scd2_check", DAMAGED)
def scd2_check(t):
    """A history built in two batches and then damaged."""
    return scd2.check(damaged(scd2_feed_in_two_batches(t)), "player_key", width="year")
