"""SQL fragments shared by the oracle statements. They know nothing of the Spark plans."""

BET = "CAST(l_extendedprice AS DECIMAL(12,2))"
WON = f"CAST({BET} * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(12,2))"
TABLE_CODE = "l_partkey * 2147483648 + l_suppkey"

# Order lines as plays; `lines` lacks the player.
PLAYS = f"""plays AS (
  SELECT o_custkey AS player_email, l_partkey AS game_name, l_shipdate AS play_time, {BET} AS amount_bet, {WON} AS amount_won,
         l_suppkey, l_orderkey, s_nationkey AS location_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey)"""
LINES = f"""lines AS (
  SELECT l_partkey AS game_name, l_shipdate AS play_time, {BET} AS amount_bet, {WON} AS amount_won, l_suppkey FROM lineitem)"""

EVENT_BET = "CAST(value AS DECIMAL(12,2))"
EVENT_PLAYS = f"""eplays AS (
  SELECT event_id, user_id AS player_email, event_type AS game_name, ts AS play_time, {EVENT_BET} AS amount_bet,
         CAST(CASE event_type WHEN 'purchase' THEN {EVENT_BET} * 2 WHEN 'view' THEN {EVENT_BET} ELSE 0 END AS DECIMAL(12,2)) AS amount_won
  FROM events)"""
# Half a minute rounds up.
EVENT_FACT = f"""{EVENT_PLAYS}, efact AS (
  SELECT *, CAST(play_time AS DATE) AS full_date,
         (epoch_us(play_time) - epoch_us(LAG(play_time) OVER (PARTITION BY player_email ORDER BY play_time, game_name, amount_bet)) + 30000000) // 60000000 AS minutes
  FROM eplays)"""

TIER_REPORT = "CASE WHEN {p} >= 8000 THEN 'Platinum' WHEN {p} >= 5000 THEN 'Gold' WHEN {p} >= 2000 THEN 'Silver' ELSE 'Bronze' END"
TIER_WAREHOUSE = "CASE WHEN {p} >= 10000 THEN 'Platinum' WHEN {p} >= 5000 THEN 'Gold' WHEN {p} >= 1000 THEN 'Silver' ELSE 'Bronze' END"
DOB = "CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS DATE)"


def age(born: str, on: str = "DATE '2024-02-01'") -> str:
    """Full years: one less before the birthday's month and day."""
    return f"(year({on}) - year({born}) - CASE WHEN month({on}) * 100 + day({on}) < month({born}) * 100 + day({born}) THEN 1 ELSE 0 END)"


def band(years: str) -> str:
    return f"CASE WHEN {years} < 25 THEN '18-24' WHEN {years} < 35 THEN '25-34' WHEN {years} < 45 THEN '35-44' ELSE '45+' END"


PLAYERS = f"""people AS (
  SELECT c_custkey AS player_email, c_mktsegment AS first_name, c_name AS last_name, CAST(floor(c_acctbal) AS BIGINT) AS loyalty_points,
         {DOB} AS dob FROM customer),
segments AS (
  SELECT player_email, first_name, last_name, {TIER_WAREHOUSE.format(p='loyalty_points')} AS loyalty_tier, {band(age('dob'))} AS age_group FROM people)"""

TXN = """txn AS (
  SELECT event_id AS transaction_code, user_id AS player_email, CAST(value AS DECIMAL(12,2)) AS amount, ts AS transaction_time,
         CASE event_type WHEN 'purchase' THEN 'Bet' WHEN 'view' THEN 'Win' WHEN 'click' THEN 'Deposit' WHEN 'signup' THEN 'Withdraw' ELSE 'Other' END AS transaction_type,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS game_name
  FROM events)"""


def mean(total: str, n: str) -> str:
    return f"CASE WHEN {n} = 0 THEN NULL ELSE CAST({total} AS DOUBLE) / CAST({n} AS DOUBLE) END"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def r2(top: str, bottom: str, factor: int = 1) -> str:
    """top / bottom * factor rounded half away from zero to cents, in whole numbers."""
    n, d = f"CAST(({top}) * 100 AS HUGEINT)", f"CAST(({bottom}) * 100 AS HUGEINT)"
    return f"CASE WHEN {bottom} = 0 THEN NULL ELSE CAST(sign({top}) * ((2 * abs({n}) * {100 * factor} + {d}) // (2 * {d})) AS DOUBLE) / 100 END"
