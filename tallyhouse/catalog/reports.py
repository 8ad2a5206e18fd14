"""The analytic reports."""

from __future__ import annotations

from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.registry import query
from tallyhouse.functions import presets as P
from tallyhouse.plans import insights

# The lines start in 1995; a start date is a parameter of every report.
LINES_SINCE = "1996-01-01"


@query(
    "game_popularity_monthly",
    f"""WITH {Q.LINES}
    SELECT p_partkey AS game_name, p_type AS game_type, year(play_time) AS year, month(play_time) AS month, count(*) AS total_plays,
           {Q.dbl('sum(amount_bet)')} AS total_bets, {Q.dbl('sum(amount_won)')} AS total_wins,
           {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount, {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_revenue
    FROM lines JOIN part ON p_partkey = game_name WHERE play_time >= TIMESTAMP '{LINES_SINCE}' GROUP BY ALL""",
)
def game_popularity_monthly(t):
    return insights.game_popularity_monthly(t.line_plays(), t.game(), LINES_SINCE)


@query(
    "player_loyalty_top20",
    f"""WITH {Q.PLAYS}, {Q.PLAYERS}, reg AS (SELECT o_custkey, min(o_orderdate) AS registration_date FROM orders GROUP BY 1)
    SELECT p.player_email AS email, first_name, last_name, loyalty_points, CAST(registration_date AS VARCHAR) AS registration_date,
           count(play_time) AS total_games_played, {Q.dbl('sum(amount_bet)')} AS total_amount_bet, {Q.dbl('sum(amount_won)')} AS total_amount_won,
           {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_result, {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount,
           count(DISTINCT game_name) AS games_played_count, {Q.TIER_REPORT.format(p='loyalty_points')} AS loyalty_tier
    FROM people p LEFT JOIN plays g ON g.player_email = p.player_email LEFT JOIN reg ON o_custkey = p.player_email
    GROUP BY p.player_email, first_name, last_name, loyalty_points, registration_date HAVING count(play_time) > 0
    ORDER BY loyalty_points DESC, sum(amount_bet) DESC, p.player_email LIMIT 20""",
)
def player_loyalty_top20(t):
    return insights.player_loyalty(t.player(), t.plays())


@query(
    "txn_by_type_time",
    f"""WITH {Q.TXN}
    SELECT transaction_type, year(transaction_time) AS year, month(transaction_time) AS month, dayofweek(transaction_time) AS day_of_week,
           count(*) AS transaction_count, {Q.dbl('sum(amount)')} AS total_amount, {Q.mean('sum(amount)', 'count(amount)')} AS avg_amount,
           {Q.dbl('min(amount)')} AS min_amount, {Q.dbl('max(amount)')} AS max_amount, p_partkey AS game_name, p_type AS game_type
    FROM txn LEFT JOIN part ON p_partkey = game_name WHERE transaction_time >= TIMESTAMP '2023-01-01'
    GROUP BY transaction_type, year(transaction_time), month(transaction_time), dayofweek(transaction_time), p_partkey, p_type""",
)
def txn_by_type_time(t):
    return insights.transactions_by_type_time(t.transaction(), t.game())


@query(
    "activity_trend_star",
    f"""WITH {Q.EVENT_FACT}
    SELECT year(full_date) AS year, quarter(full_date) AS quarter, monthname(full_date) AS month_name, dayname(full_date) AS day_of_week,
           count(DISTINCT player_email) AS unique_players, count(*) AS total_activities, {Q.dbl('sum(amount_bet)')} AS total_bets,
           {Q.dbl('sum(amount_won)')} AS total_wins, {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_revenue,
           {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount, CAST(sum(minutes) AS BIGINT) AS total_session_time,
           {Q.r2('sum(minutes)', 'count(minutes)')} AS avg_session_duration
    FROM efact GROUP BY 1, 2, 3, 4""",
)
def activity_trend_star(t):
    from tallyhouse.operators.dimensions import date_dim

    return insights.activity_trend(t.event_fact(), date_dim(t.event_plays(), "play_time"))


@query(
    "segmentation_tier_band",
    f"""WITH {Q.EVENT_FACT}, {Q.PLAYERS}
    SELECT loyalty_tier, age_group, count(DISTINCT s.player_email) AS player_count, {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount,
           {Q.dbl('sum(amount_bet)')} AS total_bets, {Q.dbl('sum(amount_won)')} AS total_wins, {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_revenue,
           count(*) AS total_activities, {Q.r2('sum(minutes)', 'count(minutes)')} AS avg_session_duration,
           count(DISTINCT game_name) AS games_played_count, {Q.r2('sum(amount_bet)', 'count(DISTINCT s.player_email)')} AS avg_player_bet
    FROM efact JOIN segments s USING (player_email) GROUP BY loyalty_tier, age_group""",
)
def segmentation_tier_band(t):
    return insights.segmentation(t.event_fact(), t.dim_player())


@query(
    "game_performance_location",
    f"""WITH {Q.PLAYS}
    SELECT p_partkey AS game_name, p_type AS game_type, 'House ' || n_name AS location_name, n_name AS city, r_name AS state,
           count(DISTINCT player_email) AS unique_players, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets,
           {Q.dbl('sum(amount_won)')} AS total_wins, {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_revenue,
           {Q.r2('sum(amount_won)', 'sum(amount_bet)', 100)} AS win_percentage, {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount,
           {Q.r2('sum(amount_bet)', 'count(*)')} AS avg_bet_per_play
    FROM plays JOIN part ON p_partkey = game_name JOIN nation ON n_nationkey = location_code JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3, 4, 5""",
)
def game_performance_location(t):
    return insights.game_performance(t.line_fact(), t.dim_game(), t.dim_location())


MONTHLY = f"""WITH {Q.LINES}
    SELECT year(play_time) AS year, month(play_time) AS month{{key}}, {Q.dbl('sum(amount_bet)')} AS total_bets, {Q.dbl('sum(amount_won)')} AS total_wins,
           {Q.dbl('sum(amount_won) - sum(amount_bet)')} AS net_revenue, count(*) AS total_plays
    FROM lines WHERE play_time >= TIMESTAMP '{LINES_SINCE}' GROUP BY ALL"""


@query("monthly_revenue_oltp", MONTHLY.format(key=""))
def monthly_revenue_oltp(t):
    return insights.monthly_revenue(t.line_plays(), LINES_SINCE)


def _line_star(t):
    """Fact without people and its dates."""
    from tallyhouse.operators.dimensions import date_dim_span

    return t.line_fact_short(), date_dim_span(t.line_plays(), "play_time")


@query("monthly_revenue_star", MONTHLY.format(key="_number, monthname(play_time) AS month_name"))
def monthly_revenue_star(t):
    return insights.monthly_revenue_star(*_line_star(t), LINES_SINCE)


@query(
    "reconcile_monthly",
    f"""WITH {Q.LINES}
    SELECT year(play_time) AS year, month(play_time) AS month, count(*) AS total_plays_left, count(*) AS total_plays_right, 0 AS total_plays_difference,
           {Q.dbl('sum(amount_bet)')} AS total_bets_left, {Q.dbl('sum(amount_bet)')} AS total_bets_right, CAST(0 AS DOUBLE) AS total_bets_difference
    FROM lines WHERE play_time >= TIMESTAMP '{LINES_SINCE}' GROUP BY ALL""",
)
def reconcile_monthly(t):
    star = insights.monthly_revenue_star(*_line_star(t), LINES_SINCE).withColumnRenamed("month_number", "month")
    return insights.reconcile(insights.monthly_revenue(t.line_plays(), LINES_SINCE), star, ["year", "month"], ["total_plays", "total_bets"])


@query(
    "top_players_oltp",
    f"""WITH {Q.PLAYS}, {Q.PLAYERS}
    SELECT player_email AS email, first_name, last_name, {Q.dbl('sum(amount_bet)')} AS total_bet, {Q.dbl('sum(amount_won)')} AS total_won, count(*) AS total_plays
    FROM plays JOIN people USING (player_email) GROUP BY 1, 2, 3 ORDER BY sum(amount_bet) DESC, 1 LIMIT 10""",
)
def top_players_oltp(t):
    return insights.top_bettors(t.player_basic(), t.plays())


@query(
    "top_players_star",
    f"""WITH {Q.EVENT_FACT}, {Q.PLAYERS}
    SELECT first_name, last_name, loyalty_tier, age_group, {Q.dbl('sum(amount_bet)')} AS total_bet, {Q.dbl('sum(amount_won)')} AS total_won,
           count(*) AS total_plays, {Q.r2('sum(minutes)', 'count(minutes)')} AS avg_session_duration
    FROM efact JOIN segments USING (player_email) GROUP BY 1, 2, 3, 4 ORDER BY sum(amount_bet) DESC, 1, 2, 3, 4 LIMIT 10""",
)
def top_players_star(t):
    return insights.top_bettors_star(t.event_fact(), t.dim_player())


@query(
    "game_popularity",
    f"""WITH {Q.LINES}
    SELECT p_partkey AS game_name, p_type AS type, count(play_time) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets,
           {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet
    FROM lines JOIN part ON p_partkey = game_name GROUP BY 1, 2""",
)
def game_popularity(t):
    return insights.game_popularity(t.line_plays(), t.game())


@query(
    "game_popularity_location",
    f"""WITH {Q.PLAYS}
    SELECT p_partkey AS game_name, p_type AS game_type, 'House ' || n_name AS location_name, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets,
           {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet, count(DISTINCT player_email) AS unique_players
    FROM plays JOIN part ON p_partkey = game_name JOIN nation ON n_nationkey = location_code GROUP BY 1, 2, 3""",
)
def game_popularity_location(t):
    return insights.game_popularity_by_location(t.line_fact(), t.dim_game(), t.dim_location())


@query(
    "hourly_activity_oltp",
    f"""WITH {Q.EVENT_PLAYS}
    SELECT hour(play_time) AS hour_of_day, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets,
           {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount, count(DISTINCT player_email) AS unique_players
    FROM eplays WHERE play_time >= TIMESTAMP '2023-01-01' GROUP BY 1""",
)
def hourly_activity_oltp(t):
    return insights.hourly_activity(t.event_plays())


@query(
    "hourly_activity_star",
    f"""WITH {Q.EVENT_FACT}
    SELECT hour(play_time) AS hour_of_day, count(*) AS total_activities, {Q.dbl('sum(amount_bet)')} AS total_bets,
           {Q.mean('sum(amount_bet)', 'count(amount_bet)')} AS avg_bet_amount, count(DISTINCT player_email) AS unique_players,
           {Q.r2('sum(minutes)', 'count(minutes)')} AS avg_session_duration
    FROM efact GROUP BY 1""",
)
def hourly_activity_star(t):
    from tallyhouse.operators.dimensions import date_dim

    return insights.hourly_activity_star(t.event_fact(), date_dim(t.event_plays(), "play_time"))


# Orders are the plays here: the first one registers the player.
@query(
    "retention_by_cohort",
    f"""WITH reg AS (SELECT o_custkey, min(o_orderdate) AS registration_date FROM orders GROUP BY 1),
    p AS (SELECT c_custkey, registration_date FROM customer LEFT JOIN reg ON o_custkey = c_custkey)
    SELECT year(registration_date) AS reg_year, month(registration_date) AS reg_month, count(DISTINCT p.c_custkey) AS registered_players,
           count(DISTINCT o.o_custkey) AS active_players, {Q.r2('count(DISTINCT o.o_custkey)', 'count(DISTINCT p.c_custkey)', 100)} AS retention_rate
    FROM p LEFT JOIN orders o ON o.o_custkey = p.c_custkey AND o.o_orderdate >= p.registration_date + INTERVAL 30 DAY GROUP BY 1, 2""",
)
def retention_by_cohort(t):
    return insights.retention(t.player(), t.order_fact().withColumnRenamed("player_key", "player_email"))


def _pivot(keys: str, source: str) -> str:
    def of(kind: str) -> str:
        return f"sum(CASE WHEN transaction_type = '{kind}' THEN amount ELSE 0 END)"

    return f"""{source} SELECT {keys}, {Q.dbl(of('Deposit'))} AS total_deposits, {Q.dbl(of('Withdraw'))} AS total_withdrawals,
           {Q.dbl(of('Bet'))} AS total_bets, {Q.dbl(of('Win'))} AS total_wins, {Q.dbl(of('Win') + ' - ' + of('Bet'))} AS gaming_revenue,
           count(CASE WHEN transaction_type = 'Deposit' THEN 1 END) AS deposit_count, count(CASE WHEN transaction_type = 'Withdraw' THEN 1 END) AS withdrawal_count
    FROM txn WHERE transaction_time >= TIMESTAMP '{P.SINCE}' GROUP BY ALL"""


@query("financial_monthly_pivot", _pivot("year(transaction_time) AS year, month(transaction_time) AS month", f"WITH {Q.TXN}"))
def financial_monthly_pivot(t):
    return insights.financial_summary(t.transaction())


@query("financial_daily_pivot", _pivot("year(transaction_time) AS year, month(transaction_time) AS month, day(transaction_time) AS day", f"WITH {Q.TXN}"))
def financial_daily_pivot(t):
    return insights.financial_summary(t.transaction(), by="day")
