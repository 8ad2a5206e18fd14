"""Text staging, validation, references, one row per key, upserts, reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.catalog import sql as Q
from tallyhouse.catalog.registry import query
from tallyhouse.functions import scalars as S
from tallyhouse.operators import dedup, merge, quality, referential, rules
from tallyhouse.plans import ingest
from tallyhouse.schemas import TABLES
from tallyhouse.session import scratch
from tallyhouse.sources import csv, run_log, tables

# -- dirty text made of whole tables: every table row is there, some with a fault


def dirty_events(t) -> DataFrame:
    """Events as a text file would have them; some fields are blank, missing or malformed."""
    e = F.col("event_id")
    kind = F.when(e % 4 == 0, F.upper("event_type")).when(e % 4 == 1, F.concat(F.lit("  "), F.initcap("event_type"), F.lit(" "))).otherwise(F.col("event_type"))
    return t.raw("events").select(
        F.when(e % 97 == 0, F.lit("")).when(e % 101 == 0, F.lit(None).cast("string")).otherwise(e.cast("string")).alias("transaction_code"),
        F.col("user_id").cast("string").alias("player_email"),
        F.when(e % 83 == 0, F.lit("1,5")).otherwise(S.money("value").cast("string")).alias("amount"),
        kind.alias("transaction_type"),
        F.when(e % 89 == 0, F.lit("2024-13-01 00:00:00")).when(e % 79 == 0, F.lit("yesterday")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("transaction_time"),
    )


DIRTY = f"""dirty AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS transaction_code,
    CAST(user_id AS VARCHAR) AS player_email, CASE WHEN event_id % 83 = 0 THEN '1,5' ELSE CAST({Q.EVENT_BET} AS VARCHAR) END AS amount,
    CASE WHEN event_id % 4 = 0 THEN upper(event_type) WHEN event_id % 4 = 1 THEN '  ' || upper(event_type[1]) || event_type[2:] || ' ' ELSE event_type END AS transaction_type,
    CASE WHEN event_id % 89 = 0 THEN '2024-13-01 00:00:00' WHEN event_id % 79 = 0 THEN 'yesterday' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS transaction_time,
    (event_id % 97 = 0 OR event_id % 101 = 0) AS no_code, event_id % 83 = 0 AS no_amount, (event_id % 89 = 0 OR event_id % 79 = 0) AS no_time
  FROM events)"""


def event_rules() -> list[rules.Rule]:
    return [*rules.required("transaction_code"), rules.castable("amount", "cents"), rules.castable("transaction_time", "timestamp")]


@query(
    "staging_valid_rows",
    f"""WITH {DIRTY} SELECT CAST(transaction_code AS BIGINT) AS transaction_code, player_email, CAST(CAST(amount AS DECIMAL(12,2)) AS DOUBLE) AS amount, transaction_time
    FROM dirty WHERE NOT no_code AND NOT no_amount AND NOT no_time""",
)
def staging_valid_rows(t):
    good = rules.keep_valid(dirty_events(t), event_rules())
    typed = rules.cast_all(good, {"amount": "cents", "transaction_time": "timestamp"})
    return typed.select(F.col("transaction_code").cast("long").alias("transaction_code"), "player_email", "amount", "transaction_time")


@query(
    "staging_rejects_by_rule",
    f"""WITH {DIRTY} SELECT unnest(['transaction_code required', 'amount not cents', 'transaction_time not timestamp']) AS rule,
    unnest([count(*) FILTER (WHERE no_code), count(*) FILTER (WHERE no_amount), count(*) FILTER (WHERE no_time)]) AS broken FROM dirty""",
)
def staging_rejects_by_rule(t):
    return rules.count_broken(dirty_events(t), event_rules())


@query(
    "staging_quarantine",
    f"""WITH {DIRTY} SELECT transaction_code, amount, transaction_time, array_to_string(list_filter([CASE WHEN no_code THEN 'transaction_code required' END,
      CASE WHEN no_amount THEN 'amount not cents' END, CASE WHEN no_time THEN 'transaction_time not timestamp' END], lambda x: x IS NOT NULL), '; ') AS reasons
    FROM dirty WHERE no_code OR no_amount OR no_time""",
)
def staging_quarantine(t):
    _, bad = rules.split(dirty_events(t), event_rules())
    return bad.select("transaction_code", "amount", "transaction_time", F.array_join("reasons", "; ").alias("reasons"))


@query(
    "staging_guarded_cast",
    f"""WITH {DIRTY} SELECT player_email, CAST(CASE WHEN no_amount THEN NULL ELSE CAST(value AS DECIMAL(12,2)) END AS DOUBLE) AS amount,
    CASE WHEN no_time THEN NULL ELSE transaction_time END AS transaction_time FROM dirty JOIN events USING (event_id)""",
)
def staging_guarded_cast(t):
    return rules.cast_all(dirty_events(t), {"amount": "cents", "transaction_time": "timestamp"}, safe=True).select("player_email", "amount", "transaction_time")


@query(
    "category_normalise",
    f"""WITH {DIRTY} SELECT CASE lower(trim(transaction_type)) WHEN 'purchase' THEN 'Bet' WHEN 'view' THEN 'Win' WHEN 'click' THEN 'Deposit' END AS transaction_type, count(*) AS row_count
    FROM dirty WHERE lower(trim(transaction_type)) IN ('purchase', 'view', 'click') GROUP BY 1""",
)
def category_normalise(t):
    known = {"purchase": "Bet", "view": "Win", "click": "Deposit"}
    return rules.normalise(dirty_events(t), "transaction_type", known).groupBy("transaction_type").agg(F.count(F.lit(1)).alias("row_count"))


@query("category_profile", f"WITH {DIRTY} SELECT transaction_type AS value, count(*) AS row_count FROM dirty GROUP BY 1")
def category_profile(t):
    return rules.profile(dirty_events(t), "transaction_type")


@query(
    "text_cleansing",
    """SELECT doc_id, trim(lang) AS lang, coalesce(nullif(source, 'src0'), 'unknown') AS source, left(text, 100) AS head, length(text) > 5000 AS too_long FROM documents""",
)
def text_cleansing(t):
    docs = t.raw("documents").withColumn("too_long", F.length("text") > 5000).withColumn("source", F.nullif(F.col("source"), F.lit("src0")))
    cleaned = rules.truncate_cols(rules.fill_defaults(rules.trim_cols(docs, ["lang"]), {"source": "unknown"}), {"text": 100})
    return cleaned.select("doc_id", "lang", "source", F.col("text").alias("head"), "too_long")


@query(
    "money_rounding",
    """SELECT l_returnflag, CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))) AS DOUBLE) AS tax FROM lineitem GROUP BY 1""",
)
def money_rounding(t):
    tax = S.money(S.money("l_extendedprice") * F.col("l_tax").cast("decimal(4,2)"))
    return t.raw("lineitem").groupBy("l_returnflag").agg(F.sum(tax).alias("tax"))


# -- references


def in_credit(t) -> DataFrame:
    """Customers who owe nothing: the parents here, so the others' orders are orphans."""
    return t.raw("customer").where(F.col("c_acctbal") >= 0)


@query("fk_drop", "SELECT o_orderkey, o_custkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)")
def fk_drop(t):
    return referential.fk_keep(t.raw("orders").select("o_orderkey", "o_custkey"), in_credit(t), "o_custkey", "c_custkey")


ORPHANS = "lost AS (SELECT o_custkey, count(*) AS row_count FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0) GROUP BY 1)"


@query("fk_orphans", f"WITH {ORPHANS} SELECT * FROM lost")
def fk_orphans(t):
    return referential.orphans(t.raw("orders"), in_credit(t), "o_custkey", "c_custkey")


@query(
    "fk_orphan_report",
    f"""WITH {ORPHANS} SELECT count(*) AS orphan_keys, CAST(coalesce(sum(row_count), 0) AS BIGINT) AS orphan_rows FROM lost""",
)
def fk_orphan_report(t):
    """The numbers; `fk_orphans` names every key."""
    return referential.orphan_counts(t.raw("orders"), in_credit(t), "o_custkey", "c_custkey")


@query("membership_filter", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_type = 'PROMO')")
def membership_filter(t):
    promo = t.raw("part").where(F.col("p_type") == "PROMO")
    return referential.membership(t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), promo, "l_partkey", "p_partkey")


# -- checks


@query(
    "constraint_check",
    """SELECT 'l_orderkey required' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS broken FROM lineitem
    UNION ALL SELECT 'l_shipdate required', count(*) FILTER (WHERE l_shipdate IS NULL) FROM lineitem
    UNION ALL SELECT 'l_returnflag not in domain', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
    UNION ALL SELECT 'l_quantity below 10', count(*) FILTER (WHERE l_quantity < 10) FROM lineitem
    UNION ALL SELECT 'duplicate key l_orderkey, l_linenumber', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    UNION ALL SELECT 'orphan l_suppkey', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def constraint_check(t):
    spec = quality.Constraints(
        not_null=["l_orderkey", "l_shipdate"],
        key=["l_orderkey", "l_linenumber"],
        foreign={"l_suppkey": (t.raw("supplier"), "s_suppkey")},
        checks=[rules.in_domain("l_returnflag", ["A", "N"]), rules.at_least("l_quantity", 10)],
    )
    return quality.check_constraints(t.raw("lineitem"), spec)


@query(
    "dq_scorecard",
    """SELECT count(*) AS row_count, CAST(count(o_custkey) + count(o_orderdate) AS DOUBLE) / CAST(count(*) * 2 AS DOUBLE) AS completeness,
    CAST(count(*) FILTER (WHERE o_orderstatus IN ('O', 'F') AND o_totalprice >= 1000) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS accuracy,
    CAST(epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(o_orderdate)) AS DOUBLE) / 3600000000.0 AS hours_behind,
    CAST(1 AS DOUBLE) - CAST(count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS consistency FROM orders""",
)
def dq_scorecard(t):
    accurate = [rules.in_domain("o_orderstatus", ["O", "F"]), rules.at_least("o_totalprice", 1000)]
    as_of = F.lit("2024-02-01").cast("timestamp_ntz")
    return quality.scorecard(t.raw("orders"), ["o_custkey", "o_orderdate"], accurate, in_credit(t), "o_custkey", "c_custkey", "o_orderdate", as_of)


COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def row_counts(t):
    return quality.row_counts({n: t.raw(n) for n in COUNTED})


# -- one row per key


@query(
    "dedup_latest",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) = 1""",
)
def dedup_latest(t):
    rows = t.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return dedup.keep_latest(rows, "o_custkey", F.col("o_orderdate").desc_nulls_last())


@query(
    "dedup_normalised_key",
    """SELECT name, p_partkey, p_retailprice FROM (SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE ' ' || p_name END AS name, p_retailprice FROM part)
    QUALIFY row_number() OVER (PARTITION BY lower(trim(name)) ORDER BY p_retailprice DESC NULLS LAST, p_partkey) = 1""",
)
def dedup_normalised_key(t):
    name = F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.concat(F.lit(" "), "p_name"))
    rows = t.raw("part").select("p_partkey", name.alias("name"), "p_retailprice")
    return dedup.keep_latest(rows, F.lower(F.trim("name")), F.col("p_retailprice").desc_nulls_last())


@query("dedup_last_row", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def dedup_last_row(t):
    return dedup.keep_last(t.raw("events").select("user_id", "event_id", "event_type"), "user_id", ["event_id"])


LINE_COLUMNS = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    "dedup_one",
    f"""SELECT l_orderkey, l_linenumber, {LINE_COLUMNS} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_COLUMNS}) = 1""",
)
def dedup_one(t):
    rows = t.raw("lineitem").select("l_orderkey", "l_linenumber", *LINE_COLUMNS.split(", "))
    return dedup.keep_one(rows, ["l_orderkey", "l_linenumber"])


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t):
    return dedup.duplicate_keys(t.raw("lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_rows", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(t):
    return t.raw("lineitem").select("l_partkey", "l_suppkey").distinct()


# -- upserts: the second snapshot of the customers has changes, removals and new keys


def second_snapshot(t) -> DataFrame:
    k = F.col("c_custkey")
    raised = S.money("c_acctbal") + F.when(k % 7 == 0, F.lit(100)).otherwise(F.lit(0))
    rows = t.raw("customer").withColumn("copy", F.explode(F.when(k % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    kept = rows.where((F.col("copy") == 1) | (k % 11 != 0))
    key = F.when(F.col("copy") == 1, -k - 1).otherwise(k)
    return kept.select(key.alias("c_custkey"), "c_name", raised.cast(S.MONEY).alias("c_acctbal"))


def first_snapshot(t) -> DataFrame:
    return t.raw("customer").select("c_custkey", "c_name", S.money("c_acctbal").alias("c_acctbal"))


SNAPSHOTS = """cur AS (SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal FROM customer),
inc AS (SELECT c_custkey, c_name, CAST(c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 100 ELSE 0 END AS DECIMAL(12,2)) AS c_acctbal FROM cur WHERE c_custkey % 11 <> 0
  UNION ALL SELECT -c_custkey - 1, c_name, CAST(c_acctbal + CASE WHEN c_custkey % 7 = 0 THEN 100 ELSE 0 END AS DECIMAL(12,2)) FROM cur WHERE c_custkey % 13 = 0),
merged AS (SELECT coalesce(inc.c_custkey, cur.c_custkey) AS c_custkey, CASE WHEN inc.c_custkey IS NULL THEN cur.c_name ELSE inc.c_name END AS c_name,
  CASE WHEN inc.c_custkey IS NULL THEN cur.c_acctbal ELSE inc.c_acctbal END AS c_acctbal,
  CASE WHEN cur.c_custkey IS NULL THEN 'insert' WHEN inc.c_custkey IS NULL THEN 'keep'
       WHEN cur.c_name IS DISTINCT FROM inc.c_name OR cur.c_acctbal IS DISTINCT FROM inc.c_acctbal THEN 'update' ELSE 'same' END AS action
  FROM cur FULL JOIN inc ON cur.c_custkey = inc.c_custkey)"""


@query("upsert_result", f"WITH {SNAPSHOTS} SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, action FROM merged")
def upsert_result(t):
    return merge.upsert(first_snapshot(t), second_snapshot(t), "c_custkey")


@query("upsert_like_sized", f"WITH {SNAPSHOTS} SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, action FROM merged")
def upsert_like_sized(t):
    """The same by one full outer join, for a batch as large as the table."""
    return merge.upsert(first_snapshot(t), second_snapshot(t), "c_custkey", like_sized=True)


@query(
    "upsert_action_counts",
    f"""WITH {SNAPSHOTS} SELECT count(*) FILTER (WHERE action = 'insert') AS inserted, count(*) FILTER (WHERE action = 'update') AS updated,
    count(*) FILTER (WHERE action = 'same') AS unchanged, count(*) FILTER (WHERE action = 'keep') AS untouched FROM merged""",
)
def upsert_action_counts(t):
    return merge.action_counts(merge.upsert(first_snapshot(t), second_snapshot(t), "c_custkey"))


@query(
    "insert_absent",
    f"WITH {SNAPSHOTS} SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM cur UNION ALL SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) FROM inc WHERE c_custkey < 0",
)
def insert_absent(t):
    return merge.insert_absent(first_snapshot(t), second_snapshot(t), "c_custkey")


@query("append_idempotent", "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-20'")
def append_idempotent(t):
    """A batch that overlaps what is already loaded adds only the rest."""
    rows = t.raw("events").select("event_id", "user_id", "ts")
    loaded = rows.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    batch = rows.where(F.col("ts") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    return merge.append_new(loaded, batch, "event_id").drop("ts")


@query(
    "replace_groups",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2024-01-15' OR event_type <> 'error') AS n FROM events GROUP BY 1
    HAVING count(*) FILTER (WHERE CAST(ts AS DATE) < DATE '2024-01-15' OR event_type <> 'error') > 0""",
)
def replace_groups(t):
    """Daily counts of which the later days are counted again, now without errors."""
    events = t.raw("events").select(F.to_date("ts").alias("day"), "event_type")
    old = events.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    again = events.where((F.col("day") >= F.lit("2024-01-15").cast("date")) & (F.col("event_type") != "error")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    return merge.replace_groups(old, again, "day")


# -- whole loads of the declared tables


def dirty_players(t) -> DataFrame:
    """Customers as a player file: repeats, new keys and faulty fields."""
    k, copy = F.col("c_custkey"), F.col("copy")
    copies = F.flatten(F.array(F.array(F.lit(0)), F.when(k % 10 == 0, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")), F.when(k % 13 == 0, F.array(F.lit(2))).otherwise(F.array().cast("array<int>"))))
    points = F.abs(F.floor("c_acctbal")).cast("long") + F.when(k % 7 == 0, 1000).otherwise(0)
    born = F.date_add(F.lit("1950-01-01").cast("date"), (k * 37 % 20000).cast("int")).cast("string")
    return t.raw("customer").withColumn("copy", F.explode(copies)).select(
        F.when(copy == 2, F.concat(F.lit("n"), k.cast("string"))).when(k % 97 == 0, F.lit("")).otherwise(k.cast("string")).alias("email"),
        F.col("c_mktsegment").alias("first_name"),
        F.when(k % 53 != 0, F.col("c_name")).alias("last_name"),
        F.when(k % 89 == 0, F.lit("2001-02-30")).otherwise(born).alias("dob"),
        F.lit(None).cast("string").alias("phone"),
        F.concat(F.lit("2020-01-0"), (copy + 1).cast("string"), F.lit(" 00:00:00")).alias("registration_date"),
        F.when(k % 83 == 0, F.lit("many")).otherwise(points.cast("string")).alias("loyalty_points"),
    )


def loaded_players(t) -> DataFrame:
    """The player table before the load."""
    k = F.col("c_custkey")
    return t.raw("customer").select(
        k.cast("string").alias("email"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.date_add(F.lit("1950-01-01").cast("date"), (k * 37 % 20000).cast("int")).alias("dob"),
        F.lit(None).cast("string").alias("phone"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("registration_date"),
        F.abs(F.floor("c_acctbal")).cast("int").alias("loyalty_points"),
    )


PLAYER_LOAD = f"""src AS (SELECT c_custkey AS k, c_mktsegment, c_name, {Q.DOB} AS dob, abs(CAST(floor(c_acctbal) AS BIGINT)) AS pts FROM customer),
staged AS (SELECT *, unnest(list_concat([0], list_concat(CASE WHEN k % 10 = 0 THEN [1] ELSE [] END, CASE WHEN k % 13 = 0 THEN [2] ELSE [] END))) AS copy FROM src),
checked AS (SELECT *, CASE WHEN copy = 2 THEN 'n' || k WHEN k % 97 = 0 THEN '' ELSE CAST(k AS VARCHAR) END AS email, (copy <> 2 AND k % 97 = 0) AS e1, k % 53 = 0 AS e2, k % 89 = 0 AS e3, k % 83 = 0 AS e4 FROM staged),
inc AS (SELECT email, c_mktsegment AS first_name, c_name AS last_name, dob, TIMESTAMP '2020-01-01' + to_days(CAST(copy AS INTEGER)) AS reg, pts + CASE WHEN k % 7 = 0 THEN 1000 ELSE 0 END AS points
  FROM checked WHERE NOT (e1 OR e2 OR e3 OR e4) QUALIFY row_number() OVER (PARTITION BY email ORDER BY copy DESC) = 1),
cur AS (SELECT CAST(k AS VARCHAR) AS email, c_mktsegment AS first_name, c_name AS last_name, dob, TIMESTAMP '2020-01-01' AS reg, pts AS points FROM src)"""


@query(
    "load_player_rows",
    f"""WITH {PLAYER_LOAD} SELECT coalesce(inc.email, cur.email) AS email, coalesce(inc.first_name, cur.first_name) AS first_name, coalesce(inc.last_name, cur.last_name) AS last_name,
    CAST(coalesce(inc.dob, cur.dob) AS VARCHAR) AS dob, CAST(NULL AS VARCHAR) AS phone, CAST(coalesce(inc.reg, cur.reg) AS VARCHAR) AS registration_date, coalesce(inc.points, cur.points) AS loyalty_points
    FROM cur FULL JOIN inc ON inc.email = cur.email""",
)
def load_player_rows(t):
    return ingest.load(TABLES["player"], dirty_players(t), loaded_players(t), {}).rows


@query(
    "load_report",
    f"""WITH {PLAYER_LOAD} SELECT (SELECT count(*) FROM staged) AS total, count(*) FILTER (WHERE cur.email IS NULL) AS inserted,
    count(*) FILTER (WHERE cur.email IS NOT NULL AND (inc.reg <> cur.reg OR inc.points <> cur.points)) AS updated, (SELECT count(*) FROM checked WHERE e1 OR e2 OR e3 OR e4) AS skipped
    FROM inc LEFT JOIN cur ON inc.email = cur.email""",
)
def load_report(t):
    return ingest.load(TABLES["player"], dirty_players(t), loaded_players(t), {}).report


@query(
    "load_rejects",
    f"""WITH {PLAYER_LOAD} SELECT email, c_mktsegment AS first_name, array_to_string(list_filter([CASE WHEN e1 THEN 'email required' END, CASE WHEN e2 THEN 'last_name required' END,
    CASE WHEN e3 THEN 'dob not date' END, CASE WHEN e4 THEN 'loyalty_points not int' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM checked WHERE e1 OR e2 OR e3 OR e4""",
)
def load_rejects(t):
    bad = ingest.rejects(TABLES["player"], dirty_players(t))
    return bad.select("email", "first_name", F.array_join("reasons", "; ").alias("reasons"))


def game_file(t) -> DataFrame:
    """Parts as a game file; the types are game types in various spellings, one of them unknown."""
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("slots", " POKER ", "Roulette", "bingo", "Number", "blackJack")]), (k % 6 + 1).cast("int"))
    return t.raw("part").select(
        F.concat(F.lit(" "), F.when(k % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name"))).alias("game_name"),
        kind.alias("type"),
        F.when(k % 19 == 0, F.lit("free")).otherwise(F.col("p_size").cast("string")).alias("min_bet"),
        S.money("p_retailprice").cast("string").alias("max_bet"),
    )


@query(
    "load_games",
    """WITH f AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS game_name,
      CASE p_partkey % 6 WHEN 0 THEN 'Slot' WHEN 1 THEN 'Poker' WHEN 2 THEN 'Roulette' WHEN 3 THEN 'Bingo' WHEN 5 THEN 'Blackjack' END AS type,
      CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_size AS DECIMAL(10,2)) END AS min_bet, CAST(p_retailprice AS DECIMAL(10,2)) AS max_bet FROM part),
    one AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY lower(game_name) ORDER BY min_bet DESC NULLS FIRST, game_name, type NULLS LAST, max_bet) = 1)
    SELECT game_name, type, CAST(min_bet AS DOUBLE) AS min_bet, CAST(max_bet AS DOUBLE) AS max_bet FROM one WHERE type IS NOT NULL""",
)
def load_games(t):
    return ingest.load(TABLES["game"], game_file(t), None, {}).rows


@query(
    "load_transactions",
    """SELECT CAST(event_id AS VARCHAR) AS transaction_code, CAST(user_id AS VARCHAR) AS player_email, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount, event_type AS transaction_type,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_time, event_type AS game_name
    FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AND event_type <> 'error'""",
)
def load_transactions(t):
    """Events as a transaction file: errors have no game and fall out, like those of unknown players."""
    staged = t.raw("events").select(
        F.col("event_id").cast("string").alias("transaction_code"),
        F.col("user_id").cast("string").alias("player_email"),
        S.money("value").cast("string").alias("amount"),
        F.col("event_type").alias("transaction_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("transaction_time"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("game_name"),
    )
    games = t.event_game().select("game_name")
    players = in_credit(t).select(F.col("c_custkey").cast("string").alias("email"))
    return ingest.load(TABLES["transaction"], staged, None, {"game": games, "player": players}).rows


# -- files


@query("csv_round_trip", "SELECT doc_id, text, lang, source FROM documents")
def csv_round_trip(t):
    """Texts with quotes, commas and line breaks through a CSV file and back."""
    path = scratch(t.spark, "csv")
    csv.write_csv(t.raw("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "lang", "source"), path)
    back = csv.read_csv_staging(t.spark, path, ["doc_id", "text", "lang", "source"], multiline=True)
    return back.withColumn("doc_id", F.col("doc_id").cast("long"))


@query("append_partitioned", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1")
def append_partitioned(t):
    """Two appends to a table partitioned by date, read back by date."""
    path = scratch(t.spark, "appended")
    events = t.raw("events").withColumn("day", F.to_date("ts"))
    middle = F.lit("2024-01-15").cast("date")
    for part in (events.where(F.col("day") < middle), events.where(F.col("day") >= middle)):
        tables.append(part, path, ["day"])
    kept = tables.read_table(t.spark, path, events.schema)
    return kept.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


@query(
    "run_log_report",
    """SELECT 'load events' AS process_name, 'COMPLETED' AS status, (SELECT count(*) FROM events) AS records_processed, 1 AS runs, 0 AS errors
    UNION ALL SELECT 'load orders', 'COMPLETED', (SELECT count(*) FROM orders), 1, 0 UNION ALL SELECT 'check lines', 'ERROR', 0, 1, 1""",
)
def run_log_report(t):
    """Three logged steps over whole tables, one of which is refused by its gate."""
    path = scratch(t.spark, "log")

    def refuse():
        rules.gate(t.raw("lineitem"), [rules.at_least("l_quantity", 10)])

    run_log.run_step(t.spark, path, "load events", lambda: t.raw("events").count())
    run_log.run_step(t.spark, path, "load orders", lambda: t.raw("orders").count())
    try:
        run_log.run_step(t.spark, path, "check lines", refuse)
    except rules.GateError:
        pass
    return run_log.report(run_log.read_log(t.spark, path)).select("process_name", "status", "records_processed", "runs", "errors")


@query(
    "gate_counts",
    "SELECT unnest(['l_quantity below 10', 'l_returnflag not in domain']) AS rule, unnest([count(*) FILTER (WHERE l_quantity < 10), count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))]) AS broken FROM lineitem",
)
def gate_counts(t):
    """What a refused batch reports."""
    checks = [rules.at_least("l_quantity", 10), rules.in_domain("l_returnflag", ["A", "N"])]
    try:
        rules.gate(t.raw("lineitem"), checks)
        counts = {r.name: 0 for r in checks}
    except rules.GateError as err:
        counts = err.counts
    one = [t.spark.range(1).select(F.lit(k).alias("rule"), F.lit(v).cast("long").alias("broken")) for k, v in counts.items()]
    return reduce(DataFrame.unionByName, one)
