"""Dashboard measures and window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.registry import query
from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, windows
from tallyhouse.plans import bi

# Months of the lines with their bets, every month from first to last.
MONTHS = f"""{Q.LINES},
  m AS (SELECT date_trunc('month', play_time) AS mo, sum(amount_bet) AS bet FROM lines GROUP BY 1),
  spine AS (SELECT unnest(generate_series((SELECT min(mo) FROM m), (SELECT max(mo) FROM m), INTERVAL 1 MONTH)) AS mo),
  months AS (SELECT CAST(CAST(spine.mo AS DATE) AS VARCHAR) AS month, coalesce(bet, 0) AS revenue FROM spine LEFT JOIN m ON m.mo = spine.mo)"""


@query(
    "running_revenue",
    f"WITH {MONTHS} SELECT month, {Q.dbl('revenue')} AS revenue, {Q.dbl('sum(revenue) OVER (ORDER BY month)')} AS running_revenue FROM months",
)
def running_revenue(t):
    return bi.revenue_trend(t.line_fact_short()).select("month", "revenue", "running_revenue")


def _growth(n: int) -> str:
    lag = f"lag(revenue, {n}) OVER (ORDER BY month)"
    return f"CASE WHEN {lag} = 0 THEN NULL ELSE CAST(revenue - {lag} AS DOUBLE) / CAST({lag} AS DOUBLE) END"


@query(
    "period_growth",
    f"""WITH {MONTHS} SELECT month, {Q.dbl('revenue')} AS revenue, {Q.dbl('lag(revenue, 1) OVER (ORDER BY month)')} AS mom_previous, {_growth(1)} AS mom_growth,
    {Q.dbl('lag(revenue, 12) OVER (ORDER BY month)')} AS yoy_previous, {_growth(12)} AS yoy_growth FROM months""",
)
def period_growth(t):
    return bi.revenue_trend(t.line_fact_short()).drop("running_revenue")


@query(
    "cumulative_players",
    """WITH f AS (SELECT o_custkey, min(date_trunc('month', o_orderdate)) AS mo FROM orders GROUP BY 1),
    n AS (SELECT mo, count(*) AS c FROM f GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(date_trunc('month', o_orderdate)) FROM orders), (SELECT max(date_trunc('month', o_orderdate)) FROM orders), INTERVAL 1 MONTH)) AS mo)
    SELECT CAST(CAST(spine.mo AS DATE) AS VARCHAR) AS month, coalesce(c, 0) AS new_players, CAST(sum(coalesce(c, 0)) OVER (ORDER BY spine.mo) AS BIGINT) AS cumulative_players
    FROM spine LEFT JOIN n ON n.mo = spine.mo""",
)
def cumulative_players(t):
    return bi.cumulative_players(t.order_fact())


@query(
    "rank_games",
    f"""WITH {Q.LINES}, g AS (SELECT game_name, count(*) AS total_plays FROM lines GROUP BY 1)
    SELECT game_name, total_plays, rank() OVER (ORDER BY total_plays DESC) AS rank, dense_rank() OVER (ORDER BY total_plays DESC) AS dense_rank FROM g""",
)
def rank_games(t):
    return bi.game_utilisation(t.line_fact_short())


@query(
    "top3_games",
    f"WITH {Q.LINES} SELECT game_name, {Q.dbl('sum(amount_bet)')} AS revenue, count(*) AS total_plays FROM lines GROUP BY 1 ORDER BY sum(amount_bet) DESC, 1 LIMIT 3",
)
def top3_games(t):
    return bi.top_games(t.line_fact_short())


@query(
    "top3_per_group",
    f"""WITH {Q.LINES}, g AS (SELECT p_type AS game_type, game_name, sum(amount_bet) AS bet FROM lines JOIN part ON p_partkey = game_name GROUP BY 1, 2)
    SELECT game_type, game_name, {Q.dbl('bet')} AS revenue, row_number() OVER (PARTITION BY game_type ORDER BY bet DESC, game_name) AS place
    FROM g QUALIFY row_number() OVER (PARTITION BY game_type ORDER BY bet DESC, game_name) <= 3""",
)
def top3_per_group(t):
    totals = t.line_fact_short().groupBy("game_name").agg(F.sum("bet_amount").cast(bi.TOTAL).alias("revenue"))
    typed = totals.join(t.dim_game().select("game_name", "game_type"), "game_name")
    return windows.top_per_group(typed, ["game_type"], [F.desc("revenue"), F.asc("game_name")], 3)


@query(
    "revenue_share",
    f"""WITH {Q.LINES}, g AS (SELECT game_name, sum(amount_bet) AS revenue FROM lines GROUP BY 1)
    SELECT game_name, {Q.dbl('revenue')} AS revenue, CAST(revenue AS DOUBLE) / CAST((SELECT sum(revenue) FROM g) AS DOUBLE) AS share FROM g""",
)
def revenue_share(t):
    totals = t.line_fact_short().groupBy("game_name").agg(F.sum("bet_amount").cast(bi.TOTAL).alias("revenue"))
    return windows.share_of_total(totals, {"revenue": "share"})


@query(
    "pareto_players",
    f"""WITH g AS (SELECT o_custkey AS player_key, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue FROM orders GROUP BY 1)
    SELECT player_key, {Q.dbl('revenue')} AS revenue, CAST(count(*) OVER (ORDER BY revenue DESC) AS DOUBLE) / CAST((SELECT count(*) FROM g) AS DOUBLE) AS row_share,
           CAST(sum(revenue) OVER (ORDER BY revenue DESC) AS DOUBLE) / CAST((SELECT sum(revenue) FROM g) AS DOUBLE) AS value_share FROM g""",
)
def pareto_players(t):
    return bi.revenue_concentration(t.order_fact())


@query(
    "session_gap_minutes",
    f"""WITH {Q.EVENT_PLAYS}, holes AS (SELECT CASE WHEN player_email % 29 <> 0 THEN player_email END AS player_email, game_name, amount_bet,
      CASE WHEN minute(play_time) % 7 <> 0 THEN play_time END AS play_time FROM eplays)
    SELECT player_email, game_name, CAST(play_time AS VARCHAR) AS play_time,
      (epoch_us(play_time) - epoch_us(lag(play_time) OVER (PARTITION BY player_email ORDER BY play_time NULLS FIRST, game_name, amount_bet)) + 30000000) // 60000000 AS session_duration_minutes FROM holes""",
)
def session_gap_minutes(t):
    """Minutes since the previous event, where some players and some times are unknown."""
    holes = {
        "player_email": F.when(F.col("player_email") % 29 != 0, F.col("player_email")),
        "play_time": F.when(F.minute("play_time") % 7 != 0, F.col("play_time")),
    }
    # Users with more events are cut by the hour, so that both ways run on the test tables.
    stepped = windows.minutes_since_previous(t.event_plays().withColumns(holes), ["player_email"], "play_time", ["game_name", "amount_bet"], hot_rows=66)
    return stepped.select("player_email", "game_name", "play_time", "session_duration_minutes")


@query(
    "active_vs_registered",
    """SELECT count(DISTINCT c_custkey) AS registered_players, count(DISTINCT user_id) AS active_players,
    CAST(count(DISTINCT user_id) AS DOUBLE) / CAST(count(DISTINCT c_custkey) AS DOUBLE) AS active_share FROM customer LEFT JOIN events ON user_id = c_custkey""",
)
def active_vs_registered(t):
    return bi.active_versus_registered(t.player_basic(), t.event_plays())


@query(
    "revenue_per_player",
    """WITH m AS (SELECT date_trunc('month', o_orderdate) AS mo, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue, count(DISTINCT o_custkey) AS players FROM orders GROUP BY 1),
    spine AS (SELECT unnest(generate_series((SELECT min(mo) FROM m), (SELECT max(mo) FROM m), INTERVAL 1 MONTH)) AS mo),
    f AS (SELECT spine.mo, coalesce(revenue, 0) AS revenue, coalesce(players, 0) AS players FROM spine LEFT JOIN m ON m.mo = spine.mo)
    SELECT CAST(CAST(mo AS DATE) AS VARCHAR) AS month, CAST(revenue AS DOUBLE) AS revenue, players,
      CASE WHEN players = 0 THEN NULL ELSE CAST(revenue AS DOUBLE) / CAST(players AS DOUBLE) END AS revenue_per_player,
      CAST(lag(revenue) OVER (ORDER BY mo) AS DOUBLE) AS mom_previous,
      CASE WHEN lag(revenue) OVER (ORDER BY mo) = 0 THEN NULL ELSE CAST(revenue - lag(revenue) OVER (ORDER BY mo) AS DOUBLE) / CAST(lag(revenue) OVER (ORDER BY mo) AS DOUBLE) END AS mom_growth
    FROM f""",
)
def revenue_per_player(t):
    return bi.revenue_per_player(t.order_fact())


@query(
    "heatmap_hour_dow",
    "SELECT hour(ts) AS hour_of_day, " + ", ".join(f"count(*) FILTER (WHERE dayofweek(ts) = {d}) AS d{d}" for d in range(7)) + " FROM events GROUP BY 1",
)
def heatmap_hour_dow(t):
    return bi.heatmap(t.event_plays())


@query(
    "peak_hours",
    "SELECT hour(ts) AS hour_of_day, count(*) AS total_plays, rank() OVER (ORDER BY count(*) DESC) AS place FROM events GROUP BY 1",
)
def peak_hours(t):
    return bi.peak_hours(t.event_plays())


@query(
    "staff_utilisation",
    f"""WITH {Q.LINES}, s AS (SELECT l_suppkey AS staff_key, count(*) AS shifts, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS scheduled_hours FROM lineitem GROUP BY 1),
    p AS (SELECT l_suppkey AS staff_key, count(*) AS plays, sum(amount_bet) AS revenue FROM lines GROUP BY 1)
    SELECT staff_key, shifts, scheduled_hours, plays, {Q.dbl('revenue')} AS revenue, CAST(plays AS DOUBLE) / scheduled_hours AS plays_per_hour FROM s JOIN p USING (staff_key)""",
)
def staff_utilisation(t):
    return bi.staff_utilisation(t.shifts(), t.line_fact_short())


@query(
    "equipment_availability",
    """WITH u AS (
      SELECT s_nationkey AS location_code, 'table' AS kind, l_partkey % 3 <> 2 AS up FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN supplier ON s_suppkey = l_suppkey
      UNION ALL SELECT s_nationkey, 'machine', s_suppkey % 3 = 0 FROM supplier)
    SELECT location_code, kind, count(*) AS units, count(*) FILTER (WHERE up) AS units_up, CAST(count(*) FILTER (WHERE up) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS uptime_share
    FROM u GROUP BY 1, 2""",
)
def equipment_availability(t):
    return bi.equipment_availability(t.table_game(), t.slot_machine())


@query(
    "segment_spending",
    f"""WITH {Q.EVENT_PLAYS}, {Q.PLAYERS}, t AS (
      SELECT loyalty_tier, count(DISTINCT s.player_email) AS players, coalesce(sum(amount_bet), 0) AS bet, count(play_time) AS total_plays
      FROM segments s LEFT JOIN eplays USING (player_email) GROUP BY 1)
    SELECT loyalty_tier, players, {Q.dbl('bet')} AS total_bets, total_plays, CAST(bet AS DOUBLE) / CAST((SELECT sum(bet) FROM t) AS DOUBLE) AS bet_share FROM t""",
)
def segment_spending(t):
    return bi.segment_spending(t.event_fact(session=False), t.dim_player())


@query(
    "funnel",
    """WITH reg AS (SELECT o_custkey, min(o_orderdate) AS r, max(o_orderdate) AS l FROM orders GROUP BY 1)
    SELECT count(*) AS registered, count(l) AS played, count(*) FILTER (WHERE l >= r + INTERVAL 30 DAY) AS retained FROM customer LEFT JOIN reg ON o_custkey = c_custkey""",
)
def funnel(t):
    return bi.funnel(t.player(), t.order_fact().withColumnRenamed("player_key", "player_email"))


@query(
    "lifetime_value",
    """WITH m AS (SELECT o_custkey AS player_key, date_trunc('month', o_orderdate) AS mo, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS revenue FROM orders GROUP BY 1, 2)
    SELECT player_key, CAST(CAST(mo AS DATE) AS VARCHAR) AS month, CAST(revenue AS DOUBLE) AS revenue,
    CAST(sum(revenue) OVER (PARTITION BY player_key ORDER BY mo) AS DOUBLE) AS lifetime_value FROM m""",
)
def lifetime_value(t):
    return bi.lifetime_value(t.order_fact())


@query(
    "cash_flow",
    f"""WITH {Q.TXN}, d AS (SELECT CAST(transaction_time AS DATE) AS day, sum(CASE WHEN transaction_type = 'Deposit' THEN amount ELSE 0 END) AS i,
      sum(CASE WHEN transaction_type = 'Withdraw' THEN amount ELSE 0 END) AS o FROM txn GROUP BY 1)
    SELECT CAST(day AS VARCHAR) AS day, {Q.dbl('i')} AS deposits, {Q.dbl('o')} AS withdrawals, {Q.dbl('i - o')} AS net_flow, {Q.dbl('sum(i - o) OVER (ORDER BY day)')} AS running_net_flow FROM d""",
)
def cash_flow(t):
    return bi.cash_flow(t.transaction())


@query(
    "type_margin",
    f"""WITH {Q.LINES} SELECT p_type AS game_type, {Q.dbl('sum(amount_bet)')} AS total_bets, {Q.dbl('sum(amount_won)')} AS total_wins,
    {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_revenue, CAST(sum(amount_won) - sum(amount_bet) AS DOUBLE) / CAST(sum(amount_bet) AS DOUBLE) AS margin
    FROM lines JOIN part ON p_partkey = game_name GROUP BY 1""",
)
def type_margin(t):
    return bi.margin_by_type(t.line_fact_short(), t.dim_game())


@query(
    "type_mix",
    f"""WITH {Q.TXN} SELECT transaction_type, count(*) AS transactions, {Q.dbl('sum(amount)')} AS amount,
    CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM txn) AS DOUBLE) AS count_share, CAST(sum(amount) AS DOUBLE) / CAST((SELECT sum(amount) FROM txn) AS DOUBLE) AS amount_share
    FROM txn GROUP BY 1""",
)
def type_mix(t):
    return bi.type_mix(t.transaction())


@query(
    "trend_forecast",
    f"""WITH {MONTHS}, p AS (SELECT row_number() OVER (ORDER BY month) - 1 AS x, revenue AS y, CAST(month AS DATE) AS mo FROM months),
    s AS (SELECT count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(y * CAST(x AS DECIMAL(10,0))) AS sxy, max(mo) AS last FROM p),
    l AS (SELECT *, (CAST(n AS DOUBLE) * CAST(sxy AS DOUBLE) - CAST(sx AS DOUBLE) * CAST(sy AS DOUBLE)) / CAST(n * sxx - sx * sx AS DOUBLE) AS slope FROM s),
    i AS (SELECT *, (CAST(sy AS DOUBLE) - slope * CAST(sx AS DOUBLE)) / CAST(n AS DOUBLE) AS intercept FROM l),
    e AS (SELECT *, unnest([1, 2, 3]) AS step FROM i)
    SELECT CAST(CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS VARCHAR) AS month, slope, intercept, intercept + slope * CAST(n - 1 + step AS DOUBLE) AS forecast FROM e""",
)
def trend_forecast(t):
    return bi.trend_forecast(t.line_fact_short())


# -- drill-down


@query(
    "drilldown_time",
    f"""WITH {Q.LINES} SELECT year(play_time) AS year, quarter(play_time) AS quarter, month(play_time) AS month_number, day(play_time) AS day_of_month,
    CAST(grouping_id(year(play_time), quarter(play_time), month(play_time), day(play_time)) AS BIGINT) AS level, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets
    FROM lines GROUP BY ROLLUP (year(play_time), quarter(play_time), month(play_time), day(play_time))""",
)
def drilldown_time(t):
    return bi.time_drilldown(t.line_fact_short(), dimensions.date_dim_span(t.line_plays(), "play_time"))


@query(
    "drilldown_location",
    f"""WITH {Q.LINES} SELECT r_name AS country, r_name AS state, n_name AS city, 'House ' || n_name AS location_name,
    CAST(grouping_id(c, s, n_name, v) AS BIGINT) AS level, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets
    FROM (SELECT *, r_name AS c, r_name AS s, 'House ' || n_name AS v FROM lines JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey)
    GROUP BY ROLLUP (c, s, n_name, v)""".replace(
        "r_name AS country, r_name AS state, n_name AS city, 'House ' || n_name AS location_name", "c AS country, s AS state, n_name AS city, v AS location_name"
    ),
)
def drilldown_location(t):
    return bi.location_drilldown(t.line_fact_short(), t.dim_location())


@query(
    "drilldown_game",
    f"""WITH {Q.LINES} SELECT p_type AS game_type, p_partkey AS game_name, CAST(grouping_id(p_type, p_partkey) AS BIGINT) AS level, count(*) AS total_plays,
    {Q.dbl('sum(amount_bet)')} AS total_bets FROM lines JOIN part ON p_partkey = game_name GROUP BY ROLLUP (p_type, p_partkey)""",
)
def drilldown_game(t):
    return bi.game_drilldown(t.line_fact_short(), t.dim_game())


@query(
    "drilldown_customer",
    f"""WITH {Q.EVENT_PLAYS}, {Q.PLAYERS} SELECT loyalty_tier, player_email AS player_key, game_name, CAST(grouping_id(loyalty_tier, player_email, game_name) AS BIGINT) AS level,
    count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets FROM eplays JOIN segments USING (player_email) GROUP BY ROLLUP (loyalty_tier, player_email, game_name)""",
)
def drilldown_customer(t):
    return bi.customer_drilldown(t.event_fact(session=False), t.dim_player())


@query(
    "cube_filters",
    f"""WITH {Q.EVENT_PLAYS}, {Q.PLAYERS} SELECT loyalty_tier, age_group, game_name, CAST(grouping_id(loyalty_tier, age_group, game_name) AS BIGINT) AS level,
    count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets FROM eplays JOIN segments USING (player_email) GROUP BY CUBE (loyalty_tier, age_group, game_name)""",
)
def cube_filters(t):
    return bi.filter_cube(t.event_fact(session=False), t.dim_player())


@query(
    "filtered_star",
    f"""WITH {Q.LINES} SELECT game_name, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets
    FROM lines JOIN part ON p_partkey = game_name JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE play_time >= TIMESTAMP '1997-01-01' AND play_time < TIMESTAMP '1999-01-01' AND p_type IN ('PROMO', 'LARGE') AND r_name IN ('ASIA', 'EUROPE') GROUP BY 1""",
)
def filtered_star(t):
    dims = {"game_name": (t.dim_game(), {"game_type": ["PROMO", "LARGE"]}), "location_code": (t.dim_location(), {"country": ["ASIA", "EUROPE"]})}
    kept = bi.filtered(t.line_fact_short(), ("1997-01-01", "1998-12-31"), dims)
    return kept.groupBy("game_name").agg(F.count(F.lit(1)).alias("total_plays"), F.sum("bet_amount").alias("total_bets"))


# -- rewards, logins, audit, machines, results


@query(
    "reward_use",
    """SELECT p_partkey AS reward_code, p_name AS name, p_size AS points_required, count(*) AS redemptions, count(DISTINCT o_custkey) AS players, CAST(p_size * count(*) AS BIGINT) AS points_spent
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
)
def reward_use(t):
    return bi.reward_use(t.player_reward(), t.reward())


@query(
    "player_rewards",
    """SELECT o_custkey AS player_email, count(*) AS redemptions, CAST(sum(p_size) AS BIGINT) AS points_spent
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1""",
)
def player_rewards(t):
    return bi.player_rewards(t.player_reward(), t.reward())


@query(
    "login_activity",
    """SELECT user_id AS player_email, CASE WHEN event_type IN ('view', 'error') THEN 'Mobile' WHEN event_type = 'click' THEN 'Tablet' ELSE 'Desktop' END AS device_type,
    count(*) AS logins, CAST(min(ts) AS VARCHAR) AS first_login, CAST(max(ts) AS VARCHAR) AS last_login FROM events GROUP BY 1, 2""",
)
def login_activity(t):
    return bi.login_activity(t.login_history())


@query("audit_activity", "SELECT user_id AS performed_by, event_type, count(*) AS events, CAST(max(ts) AS VARCHAR) AS last_event FROM events GROUP BY 1, 2")
def audit_activity(t):
    return bi.audit_activity(t.audit_log())


@query(
    "slot_performance",
    f"""WITH {Q.LINES}, g AS (SELECT l_suppkey, count(*) AS n, sum(amount_bet) AS bet, sum(amount_won) AS won FROM lines GROUP BY 1)
    SELECT 'M' || (s_suppkey % 7) AS model, s_nationkey AS location_code, count(*) AS machines, CAST(sum(n) AS BIGINT) AS plays, {Q.dbl('sum(bet)')} AS total_bets, {Q.dbl('sum(won)')} AS total_wins,
    CAST(sum(won) AS DOUBLE) / CAST(sum(bet) AS DOUBLE) AS win_share FROM g JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2""",
)
def slot_performance(t):
    return bi.slot_performance(t.slot_play(), t.slot_machine())


@query(
    "results_by_table",
    f"""SELECT {Q.TABLE_CODE} AS table_code, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(*) AS results, count(DISTINCT l_returnflag) AS outcomes FROM lineitem GROUP BY 1, 2""",
)
def results_by_table(t):
    return bi.results_by_table(t.game_result())


@query(
    "date_functions",
    """SELECT event_id, year(ts) AS year, quarter(ts) AS quarter, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, dayofweek(ts) AS dow, dayofweek(ts) IN (0, 6) AS weekend,
    dayname(ts) AS day_name, monthname(ts) AS month_name, rpad(dayname(ts), 9, ' ') AS padded_day, CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text,
    CAST(ts + INTERVAL 30 DAY AS VARCHAR) AS in_30_days FROM events""",
)
def date_functions(t):
    ts = F.col("ts")
    return t.raw("events").select(
        "event_id",
        F.year(ts).alias("year"),
        F.quarter(ts).alias("quarter"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        S.day_of_week(ts).alias("dow"),
        S.is_weekend(ts).alias("weekend"),
        S.day_name(ts).alias("day_name"),
        S.month_name(ts).alias("month_name"),
        S.day_name(ts, pad=True).alias("padded_day"),
        F.to_date(ts).alias("day_text"),
        (ts + F.expr("interval 30 days")).alias("in_30_days"),
    )
