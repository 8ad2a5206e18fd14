"""The loads of the text files, written from whole tables with faults here and there, and read back by the loaders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.bindings import AS_OF
from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.registry import query
from tallyhouse.catalog.star import PLACES
from tallyhouse.functions import presets as P
from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, facts, referential, rules, scd2, summaries
from tallyhouse.plans import bi, ingest
from tallyhouse.schemas import TABLES
from tallyhouse.session import scratch
from tallyhouse.sources import csv


def text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def stamp(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def load(t, name: str, staged: DataFrame, **parents: DataFrame) -> ingest.Load:
    """Write the rows as a file of the table and load it."""
    path = scratch(t.spark, f"file-{name}")
    csv.write_csv(staged.select(*TABLES[name].columns), path)
    return ingest.load_file(t.spark, name, path, parents=parents)


def refused(t, run, named: tuple[str, ...]) -> DataFrame:
    """The counts with which a load stops, 0 if it doesn't."""
    counts = dict.fromkeys(named, 0)
    try:
        run()
    except rules.GateError as err:
        counts |= err.counts
    one = [t.spark.range(1).select(F.lit(k).alias("rule"), F.lit(v).cast("long").alias("broken")) for k, v in counts.items()]
    return reduce(DataFrame.unionByName, one)


# -- people and places


def staff_file(t) -> DataFrame:
    """Suppliers as staff; some stand twice in their file, the later line with a raise."""
    k = F.col("staff_email")
    twice = t.staff().withColumn("copy", F.explode(F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = twice.select(
        F.concat(F.lit("s"), text(k)).alias("staff_email"),
        "first_name",
        F.when(k % 13 != 0, F.col("last_name")).alias("last_name"),
        "position",
        F.when(k % 17 == 0, F.lit("2010-13-40")).when(k % 19 != 0, text("hire_date")).alias("hire_date"),
        text(F.lit(1000).cast(S.MONEY) + k + F.col("copy") * 100).alias("salary"),
        "copy",
    )
    # Lines of one key are in one file, in order.
    return rows.repartition("staff_email").sortWithinPartitions("staff_email", "copy")


@query(
    "load_staff",
    """SELECT 's' || s_suppkey AS staff_email, s_name AS first_name, CAST(s_nationkey AS VARCHAR) AS last_name,
      CASE s_suppkey % 5 WHEN 0 THEN 'Floor Manager' WHEN 1 THEN 'Dealer' WHEN 2 THEN 'Security' WHEN 3 THEN 'Cashier' ELSE 'Technician' END AS position,
      CASE WHEN s_suppkey % 19 <> 0 THEN CAST(DATE '2010-01-01' + CAST(s_suppkey % 3650 AS INTEGER) AS VARCHAR) END AS hire_date, CAST(1000 + s_suppkey + CASE WHEN s_suppkey % 10 = 0 THEN 100 ELSE 0 END AS DOUBLE) AS salary
    FROM supplier WHERE s_suppkey % 13 <> 0 AND s_suppkey % 17 <> 0""",
)
def load_staff(t):
    """The last line of a key in file order wins."""
    return load(t, "staff", staff_file(t)).rows.withColumn("hire_date", F.substring(text("hire_date"), 1, 10))


@query(
    "load_locations",
    """SELECT 'L' || n_nationkey AS location_code, 'House ' || n_name AS name, CAST(NULL AS VARCHAR) AS address, n_name AS city, r_name AS state, r_name AS country
    FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 7 <> 0""",
)
def load_locations(t):
    """Every place stands twice; some have an empty name."""
    rows = t.location().withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    k = F.col("location_code")
    rows = rows.withColumns({"name": F.when(k % 7 == 0, F.lit("")).otherwise(F.col("name")), "location_code": F.concat(F.lit("L"), text(k))})
    return load(t, "casino_location", rows).rows


# -- plays, tables, shifts


def known_players(t) -> DataFrame:
    return t.raw("customer").where(F.col("c_acctbal") >= 0).select(text("c_custkey").alias("email"))


@query(
    "load_plays",
    f"""SELECT CAST(user_id AS VARCHAR) AS player_email, event_type AS game_name, strftime(ts, '%Y-%m-%d %H:%M:%S') AS play_time, CAST({Q.EVENT_BET} AS DOUBLE) AS amount_bet, CAST(event_id % 50 AS DOUBLE) AS amount_won
    FROM events WHERE event_id % 50 <> 0 AND event_id % 41 <> 0 AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AND event_type <> 'error'
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') ORDER BY {Q.EVENT_BET}, event_id % 50) = 1""",
)
def load_plays(t):
    """Empty lines, quoted empty fields that count as missing, unknown players and games; one row per player, game and second."""
    e = F.col("event_id")
    empty = e % 50 == 0
    fields = {
        "player_email": text("user_id"),
        "game_name": F.col("event_type"),
        "play_time": stamp("ts"),
        "amount_bet": F.when(e % 41 == 0, F.lit("")).otherwise(text(S.money("value"))),
        "amount_won": text(e % 50),
    }
    staged = t.raw("events").select(*[F.when(~empty, c).otherwise(F.lit("") if name == "game_name" else F.lit(None)).alias(name) for name, c in fields.items()])
    games = t.event_game().where(F.col("game_name") != "error")
    return load(t, "player_game", staged, player=known_players(t), game=games).rows


def table_file(t, bad: Column) -> DataFrame:
    """Pairs of part and supplier as tables; `bad` ones lie at a place that nobody knows."""
    rows = t.table_game()
    status = F.when(F.col("game_name") % 5 != 0, F.col("status"))
    place = F.when(bad, F.lit("nowhere")).otherwise(text("location_code"))
    return rows.select(text("table_code").alias("table_code"), text("game_name").alias("game_name"), place.alias("location_code"), status.alias("status"))


def table_parents(t) -> dict[str, DataFrame]:
    games = t.game().where(F.col("type") != "PROMO").select(text("game_name").alias("game_name"))
    return {"game": games, "casino_location": t.location().select(text("location_code").alias("location_code"))}


TABLE_ROWS = f"""pairs AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem),
tabs AS (SELECT CAST({Q.TABLE_CODE} AS VARCHAR) AS table_code, l_partkey, l_suppkey, s_nationkey FROM pairs JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE p_type <> 'PROMO')"""


@query(
    "load_tables",
    f"""WITH {TABLE_ROWS} SELECT table_code, CAST(l_partkey AS VARCHAR) AS game_name, CAST(s_nationkey AS VARCHAR) AS location_code,
    CASE WHEN l_partkey % 5 = 0 THEN 'Available' ELSE ['Available', 'In Use', 'Maintenance'][l_partkey % 3 + 1] END AS status FROM tabs""",
)
def load_tables(t):
    """Tables of unknown games fall out, a missing status is filled in."""
    return load(t, "table_game", table_file(t, F.lit(False)), **table_parents(t)).rows


@query("load_tables_refused", f"WITH {TABLE_ROWS} SELECT 'location_code' AS rule, count(*) FILTER (WHERE l_partkey % 23 = 0) AS broken FROM tabs")
def load_tables_refused(t):
    """A table at an unknown place stops the batch; those of unknown games are out before that."""
    return refused(t, lambda: load(t, "table_game", table_file(t, F.col("game_name") % 23 == 0), **table_parents(t)), ("location_code",))


SHIFT_ROWS = """w AS (SELECT DISTINCT l_suppkey, l_partkey, l_shipdate FROM lineitem)"""


@query(
    "load_shifts",
    f"""WITH {SHIFT_ROWS} SELECT 's' || l_suppkey AS staff_email, CAST({Q.TABLE_CODE} AS VARCHAR) AS table_code, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shift_start, CAST(NULL AS VARCHAR) AS shift_end
    FROM w JOIN part ON p_partkey = l_partkey WHERE p_type <> 'PROMO' AND l_suppkey % 3 <> 0""",
)
def load_shifts(t):
    """Shifts of unknown tables and staff fall out."""
    rows = t.shifts().select(F.concat(F.lit("s"), text("staff_email")).alias("staff_email"), text("table_code").alias("table_code"), stamp("shift_start").alias("shift_start"), F.lit(None).cast("string").alias("shift_end")).distinct()
    games = table_parents(t)["game"]
    tables = table_file(t, F.lit(False)).join(games, "game_name", "left_semi").select("table_code")
    staff = t.staff().where(F.col("staff_email") % 3 != 0).select(F.concat(F.lit("s"), text("staff_email")).alias("staff_email"))
    return load(t, "staff_assigned_tables", rows, table_game=tables, staff=staff).rows


@query(
    "load_machines",
    """SELECT 'M' || s_suppkey AS machine_code, CAST(s_nationkey AS VARCHAR) AS location_code, ['Online', 'Offline', 'Maintenance'][s_suppkey % 3 + 1] AS status, 'M' || (s_suppkey % 7) AS model
    FROM supplier WHERE s_suppkey % 11 <> 0""",
)
def load_machines(t):
    rows = machine_file(t)
    return load(t, "slot_machine", rows, casino_location=table_parents(t)["casino_location"]).rows


def machine_file(t) -> DataFrame:
    """Machines, some with a status that isn't one."""
    k = F.col("machine_code")
    status = F.when(k % 11 == 0, F.lit("Broken")).otherwise(F.col("status"))
    return t.slot_machine().select(F.concat(F.lit("M"), text(k)).alias("machine_code"), text("location_code").alias("location_code"), status.alias("status"), "model")


@query("load_machines_quarantine", "SELECT 'M' || s_suppkey AS machine_code, 'status not in domain' AS reasons FROM supplier WHERE s_suppkey % 11 = 0")
def load_machines_quarantine(t):
    bad = load(t, "slot_machine", machine_file(t), casino_location=table_parents(t)["casino_location"]).rejected
    return bad.select("machine_code", F.array_join("reasons", "; ").alias("reasons"))


@query(
    "load_slot_plays",
    f"""SELECT CAST(l_suppkey AS VARCHAR) AS machine_code, CAST(o_custkey AS VARCHAR) AS player_email, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS play_time, CAST(sum({Q.BET}) AS DOUBLE) AS bet_amount, 0.0::DOUBLE AS win_amount
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, l_shipdate""",
)
def load_slot_plays(t):
    """Plays at machines, summed to one a player, machine and second."""
    rows = t.slot_play().groupBy("machine_code", "player_email", "play_time").agg(F.sum("bet_amount").alias("bet"))
    staged = rows.select(text("machine_code").alias("machine_code"), text("player_email").alias("player_email"), stamp("play_time").alias("play_time"), text("bet").alias("bet_amount"), F.lit("0").alias("win_amount"))
    return load(t, "slot_play", staged).rows


# -- rewards, results, logins, audit


@query(
    "load_rewards",
    "SELECT 'R' || p_partkey AS reward_code, p_name AS name, CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS BIGINT) END AS points_required, 'type, ' || p_type AS description FROM part",
)
def load_rewards(t):
    points = F.when(F.col("p_partkey") % 9 != 0, text("p_size"))
    rows = t.raw("part").select(F.concat(F.lit("R"), text("p_partkey")).alias("reward_code"), F.col("p_name").alias("name"), points.alias("points_required"), F.concat(F.lit("type, "), "p_type").alias("description"))
    return load(t, "reward", rows).rows


@query(
    "load_player_rewards",
    """SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS player_email, 'R' || l_partkey AS reward_code, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS redeem_date FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def load_player_rewards(t):
    rows = t.player_reward().select(text("player_email").alias("player_email"), F.concat(F.lit("R"), text("reward_code")).alias("reward_code"), stamp("redeem_date").alias("redeem_date"))
    return load(t, "player_reward", rows.distinct()).rows


RESULT_ROWS = """SELECT l_orderkey || '-' || l_linenumber AS result_code, min(l_partkey) AS k, min(l_suppkey) AS l_suppkey, min(l_shipdate) AS tm, min(l_returnflag) AS flag FROM lineitem GROUP BY 1"""


@query(
    "load_results",
    f"""WITH r AS ({RESULT_ROWS}) SELECT result_code, CAST(k AS VARCHAR) AS game_name, 'T' || l_suppkey AS table_code, strftime(tm, '%Y-%m-%d %H:%M:%S') AS result_time, flag AS outcome_description
    FROM r JOIN part ON p_partkey = k WHERE k % 31 <> 0 AND k % 37 <> 0 AND p_type <> 'PROMO'""",
)
def load_results(t):
    """Results with an empty table code or a time that is none go to quarantine; those of unknown games fall out."""
    rows = t.raw("lineitem").groupBy(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("result_code")).agg(
        F.min("l_partkey").alias("k"), F.min("l_suppkey").alias("s"), F.min("l_shipdate").alias("at"), F.min("l_returnflag").alias("outcome_description")
    )
    k = F.col("k")
    staged = rows.select(
        "result_code",
        text(k).alias("game_name"),
        F.when(k % 31 == 0, F.lit("")).otherwise(F.concat(F.lit("T"), text("s"))).alias("table_code"),
        F.when(k % 37 == 0, F.lit("then")).otherwise(stamp("at")).alias("result_time"),
        "outcome_description",
    )
    tables = t.raw("supplier").select(F.concat(F.lit("T"), text("s_suppkey")).alias("table_code"))
    return load(t, "game_result", staged, game=table_parents(t)["game"], table_game=tables).rows


@query(
    "load_logins",
    """SELECT lower(h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32]) AS login_id, CAST(user_id AS VARCHAR) AS player_email, strftime(ts, '%Y-%m-%d %H:%M:%S') AS login_time, '10.0.0.1' AS ip_address,
      left(repeat(event_type || ' ', 30), 100) AS device
    FROM (SELECT *, md5('{"c0":' || event_id || '}') AS h FROM events) WHERE event_id % 43 <> 0 AND event_id % 47 <> 0 AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def load_logins(t):
    """Keys made from the row, some malformed; addresses missing here and there; long device texts cut."""
    e = F.col("event_id")
    staged = t.raw("events").select(
        F.when(e % 43 == 0, F.lit("no-key")).otherwise(S.row_uuid("event_id")).alias("login_id"),
        text("user_id").alias("player_email"),
        stamp("ts").alias("login_time"),
        F.when(e % 47 != 0, F.lit("10.0.0.1")).alias("ip_address"),
        F.repeat(F.concat("event_type", F.lit(" ")), 30).alias("device"),
    )
    return load(t, "login_history", staged, player=known_players(t)).rows


def audit_file(t, signed: Column) -> DataFrame:
    """Details hold quotes, commas and, in a quarter of the entries, line breaks."""
    gap = F.when(F.col("event_id") % 4 == 0, F.lit("\n\n")).otherwise(F.lit(" "))
    details = F.concat(F.lit('kind "'), "event_type", F.lit('",'), gap, "props")
    return t.raw("events").select(
        F.concat(F.lit("A"), text("event_id")).alias("log_code"),
        "event_type",
        stamp("ts").alias("event_time"),
        F.when(signed, F.concat(F.lit("s"), text(F.col("user_id") % 150))).alias("performed_by"),
        F.when(F.col("event_id") % 53 != 0, details).alias("details"),
    )


@query(
    "load_audit",
    """SELECT 'A' || event_id AS log_code, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, 's' || (user_id % 150) AS performed_by,
      'kind "' || event_type || '",' || CASE WHEN event_id % 4 = 0 THEN chr(10) || chr(10) ELSE ' ' END || props AS details
    FROM events WHERE event_id % 53 <> 0 AND user_id % 150 IN (SELECT s_suppkey FROM supplier)""",
)
def load_audit(t):
    """Entries without details go to quarantine, those of unknown staff fall out; details hold line breaks, which is found out."""
    staff = t.staff().select(F.concat(F.lit("s"), text("staff_email")).alias("staff_email"))
    return load(t, "audit_log", audit_file(t, F.lit(True)), staff=staff).rows


@query("load_audit_refused", "SELECT 'performed_by required' AS rule, count(*) FILTER (WHERE event_id % 59 = 0) AS broken FROM events")
def load_audit_refused(t):
    """An entry that nobody signed stops the batch."""
    staff = t.staff().select(F.concat(F.lit("s"), text("staff_email")).alias("staff_email"))
    return refused(t, lambda: load(t, "audit_log", audit_file(t, F.col("event_id") % 59 != 0), staff=staff), ("performed_by required",))


# -- single rules


@query("drop_empty_rows", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 4 <> 0")
def drop_empty_rows(t):
    """Rows without any value go, rows with some stay."""
    gone = F.col("c_custkey") % 4 == 0
    rows = t.raw("customer").select(*[F.when(~gone, F.col(c)).alias(c) for c in ("c_custkey", "c_name", "c_acctbal")])
    return rules.drop_empty(rows)


@query("length_check", "SELECT 'text longer than 2000' AS rule, count(*) FILTER (WHERE length(text) > 2000) AS broken FROM documents UNION ALL SELECT 'source longer than 4', count(*) FILTER (WHERE length(source) > 4) FROM documents")
def length_check(t):
    return rules.count_broken(t.raw("documents"), [rules.max_length("text", 2000), rules.max_length("source", 4)])


@query("fk_gate", "SELECT 'o_custkey' AS rule, count(*) AS broken FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def fk_gate(t):
    """Rows whose parent is missing stop the batch; this is what it reports."""
    parents = t.raw("customer").where(F.col("c_acctbal") >= 0)
    return refused(t, lambda: referential.fk_gate(t.raw("orders"), parents, "o_custkey", "c_custkey"), ("o_custkey",))


@query(
    "word_capitals",
    """SELECT p_partkey, array_to_string(list_transform(string_split(lower(replace(p_name, '#', '-') || ' ' || p_type), '-'), lambda w: array_to_string(list_transform(string_split(w, ' '), lambda x: upper(x[1]) || x[2:]), ' ')), '-') AS name FROM part""",
)
def word_capitals(t):
    """Capitals after blanks and hyphens alike."""
    return t.raw("part").select("p_partkey", S.initcap(F.concat_ws(" ", F.replace(F.col("p_name"), F.lit("#"), F.lit("-")), "p_type")).alias("name"))


@query("login_key_default", """SELECT count(*) AS logins, count(DISTINCT event_id) AS keys, count(*) AS well_formed FROM events""")
def login_key_default(t):
    """Keys of logins that come without one: made from the row, so a retried task makes the same."""
    keys = t.login_history().withColumn("login_id", S.row_uuid("login_id", "player_email", "login_time"))
    return keys.agg(F.count(F.lit(1)).alias("logins"), F.count_distinct("login_id").alias("keys"), F.count_if(S.matches("login_id", "uuid")).alias("well_formed"))


# -- dimensions and facts


@query(
    "date_range",
    """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS time_id, CAST(d AS VARCHAR) AS full_date, year(d) AS year, n FROM
    (SELECT CAST(unnest(generate_series(DATE '1992-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS o, count(*) AS n FROM orders GROUP BY 1) ON o = d""",
)
def date_range(t):
    """Every day of a range of years with the orders of the day."""
    days = dimensions.date_dim_range(t.spark, "1992-01-01", "1998-12-31").select("time_id", "full_date", "year")
    orders = t.raw("orders").groupBy(F.to_date("o_orderdate").alias("full_date")).agg(F.count(F.lit(1)).alias("n"))
    return days.join(orders, "full_date", "left")


@query(
    "scd2_plain_compare",
    """WITH i AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS lost, c_custkey % 3 = 1 AS moved FROM customer)
    SELECT k AS player_key, CASE WHEN k % 2 = 0 THEN NULL ELSE 'a' END AS tier, NOT (moved AND k % 2 <> 0) AS is_current, 1 AS version_number FROM i
    UNION ALL SELECT k, 'b', true, 2 FROM i WHERE moved AND k % 2 <> 0""",
)
def scd2_plain_compare(t):
    """With plain `!=`, a value that becomes known or unknown is no change; only one that differs from a known one is."""
    k = F.col("c_custkey")
    rows = t.raw("customer").select(k.alias("player_key"), F.when(k % 2 != 0, F.lit("a")).alias("tier"))
    dim = scd2.init(rows, F.lit(AS_OF).cast("timestamp_ntz"))
    later = t.raw("customer").select(k.alias("player_key"), F.when(k % 3 == 1, F.lit("b")).when(k % 3 == 2, F.when(k % 2 != 0, F.lit("a"))).alias("tier"))
    merged = scd2.merge(dim, later, "player_key", ["tier"], F.lit("2024-03-01").cast("timestamp_ntz"), null_safe=False)
    return merged.select("player_key", "tier", "is_current", "version_number")


@query(
    "fact_gaming_all",
    f"""WITH {Q.PLAYS}, w AS (SELECT l_partkey AS game_name, l_suppkey, s_nationkey, count(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2, 3),
    p AS (SELECT game_name, player_email % 5 AS band, count(*) AS plays, sum(amount_bet) AS bet, sum(player_email) AS players FROM plays GROUP BY 1, 2)
    SELECT game_name, band AS player_band, s_nationkey AS location_code, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END AS staff_key, CAST(sum(plays * n) AS BIGINT) AS plays, {Q.dbl('sum(bet * n)')} AS bets, CAST(sum(p.players * n) AS BIGINT) AS player_sum
    FROM p JOIN w USING (game_name) GROUP BY 1, 2, 3, 4""",
)
def fact_gaming_all(t):
    """The fact that repeats a play for every table of its game and every shift there; half the staff are inactive."""
    staff = t.dim_staff().withColumn("is_active", F.col("staff_key") % 2 == 0)
    fact = facts.gaming_fact(t.plays(), t.dim_player(), t.dim_game(), t.table_game(), t.shifts(), staff, fanout="all", session=None)
    band = (F.col("player_key") % 5).alias("player_band")
    return fact.groupBy("game_name", band, "location_code", "staff_key").agg(F.count(F.lit(1)).alias("plays"), F.sum("bet_amount").alias("bets"), F.sum("player_key").alias("player_sum"))


@query(
    "fact_gaming_by_day",
    f"""WITH {Q.EVENT_PLAYS}, old AS (SELECT DISTINCT player_email, game_name, CAST(play_time AS DATE) AS d FROM eplays WHERE play_time < TIMESTAMP '2024-01-15 12:00:00')
    SELECT player_email AS player_key, game_name, CAST(play_time AS VARCHAR) AS play_time, {Q.dbl('amount_won - amount_bet')} AS net_result FROM eplays e
    WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.player_email = e.player_email AND old.game_name = e.game_name AND d = CAST(play_time AS DATE))""",
)
def fact_gaming_by_day(t):
    """With the day as grain, a play counts as known if its player played its game that day."""
    loaded = t.event_fact(session=False).where(F.col("play_time") < F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    games = dimensions.game_dim(t.event_game())
    fact = facts.gaming_fact(t.event_plays(), t.dim_player(), games, t.event_tables(), t.event_shifts(), t.dim_staff(), existing=loaded, grain="day", session=None)
    return fact.select("player_key", "game_name", "play_time", "net_result")


@query(
    "fact_machine_place",
    f"""WITH {PLACES}, seats AS (SELECT * FROM place WHERE game_name % 2 = 0),
    machine AS (SELECT player_email, play_time, min(l_suppkey) AS machine_code FROM plays GROUP BY 1, 2)
    SELECT coalesce(place_code, s.s_nationkey) AS location_code, place_code IS NULL AS by_machine, CASE WHEN staff_key % 2 = 0 THEN staff_key END AS staff_key, count(*) AS plays
    FROM plays LEFT JOIN seats USING (game_name) JOIN machine USING (player_email, play_time) JOIN supplier s ON s.s_suppkey = machine_code GROUP BY 1, 2, 3""",
)
def fact_machine_place(t):
    """Games without a table take the place of the machine; staff who are inactive are left out."""
    tables = t.table_game().where(F.col("game_name") % 2 == 0)
    staff = t.dim_staff().withColumn("is_active", F.col("staff_key") % 2 == 0)
    fact = facts.gaming_fact(t.plays(), t.dim_player(), t.dim_game(), tables, t.shifts(), staff, t.dim_location(), t.slot_play(), t.slot_machine(), session=None)
    return fact.groupBy("location_code", F.col("table_code").isNull().alias("by_machine"), "staff_key").agg(F.count(F.lit(1)).alias("plays"))


@query(
    "daily_summary_empty_groups",
    f"""WITH {Q.EVENT_PLAYS} SELECT CAST(CAST(play_time AS DATE) AS VARCHAR) AS full_date, game_name, count(DISTINCT player_email) AS total_players, count(*) AS total_plays FROM eplays
    WHERE game_name <> 'click' AND CAST(play_time AS DATE) <> DATE '2024-01-10' GROUP BY 1, 2""",
)
def daily_summary_empty_groups(t):
    """A day and a game without plays have no row."""
    fact = t.event_fact(session=False).where((F.col("game_name") != "click") & (F.col("full_date") != F.lit("2024-01-10").cast("date")))
    return summaries.daily_summary(fact, ("full_date", "game_name")).select("full_date", "game_name", "total_players", "total_plays")


@query(
    "filtered_players",
    f"""WITH {Q.PLAYS}, {Q.PLAYERS}, reg AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1)
    SELECT game_name, count(*) AS total_plays, {Q.dbl('sum(amount_bet)')} AS total_bets FROM plays JOIN segments USING (player_email) JOIN reg ON o_custkey = player_email
    WHERE loyalty_tier IN ('Gold', 'Silver') AND age_group = '45+' AND d < DATE '1996-01-01' AND play_time >= TIMESTAMP '1996-01-01' AND play_time < TIMESTAMP '1999-01-01' GROUP BY 1""",
)
def filtered_players(t):
    """Plays by tier, age and registration of the player."""
    people = scd2.init(dimensions.player_rows(t.player(), F.lit(AS_OF).cast("date")), F.lit(AS_OF).cast("timestamp_ntz"))
    early = people.where(F.col("registration_date") < F.lit("1996-01-01").cast("date"))
    kept = bi.filtered(t.line_fact(), ("1996-01-01", "1998-12-31"), {"player_key": (early, {"loyalty_tier": ["Gold", "Silver"], "age_group": [P.BANDS_WAREHOUSE_DEFAULT]})})
    return kept.groupBy("game_name").agg(F.count(F.lit(1)).alias("total_plays"), F.sum("bet_amount").alias("total_bets"))
