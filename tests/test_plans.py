"""Physical plans: no Python in them, no cross product, filters and columns at the scan."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tallyhouse.bindings import Roles
from tallyhouse.catalog import QUERIES, load_all, star
from tallyhouse.sources import tables

load_all()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
# A few plans of every family.
NAMES = """
game_popularity_monthly player_loyalty_top20 txn_by_type_time activity_trend_star segmentation_tier_band game_performance_location reconcile_monthly top_players_star
hourly_activity_star retention_by_cohort financial_monthly_pivot running_revenue cumulative_players top3_per_group session_gap_minutes lifetime_value heatmap_hour_dow
staff_utilisation equipment_availability drilldown_time cube_filters filtered_star reward_use staging_quarantine fk_orphans constraint_check dq_scorecard dedup_latest
upsert_result append_idempotent ensure_dates device_dim scd2_merge fact_gaming_one fact_gaming_fanout fact_gaming_incremental fact_txn_points staff_on_shift bridge_accumulate daily_summary star_join
""".split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_stays_in_the_engine(spark, name):
    text = plan(QUERIES[name](Roles(spark, SF_DIR)))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert word not in text, word


def columns_read(text, table):
    schemas = re.findall(rf"{table}\.parquet.*?ReadSchema: struct<([^>]*)>", text)
    return {c.split(":")[0] for s in schemas for c in s.split(",") if c}


def test_scan_is_narrow_and_filtered(spark):
    text = plan(QUERIES["monthly_revenue_oltp"](Roles(spark, SF_DIR)))
    assert columns_read(text, "lineitem") == {"l_shipdate", "l_extendedprice", "l_discount"}
    assert "GreaterThanOrEqual(l_shipdate" in text


def test_player_free_report_does_not_read_orders(spark):
    assert "orders.parquet" not in plan(QUERIES["game_popularity"](Roles(spark, SF_DIR)))


def test_retention_has_one_row_per_player_before_the_join(spark):
    text = plan(QUERIES["retention_by_cohort"](Roles(spark, SF_DIR)))
    assert "Expand" not in text


def test_bucketed_plays_are_not_moved(spark):
    roles = Roles(spark, SF_DIR)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plays, people = star.bucketed_tables(roles)
        joined = plan(plays.join(people, "player_email"))
        counted = plan(plays.groupBy("player_email").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in joined and "Exchange" not in joined and "Exchange" not in counted


def test_many_rows_in_small_files_are_not_broadcast(spark, tmp_path):
    """Compressed files of some megabytes hold millions of keys, which the driver would hold as a hash table."""
    few, many, facts = (str(tmp_path / name) for name in ("few", "many", "facts"))
    spark.range(2_000).write.parquet(few)
    spark.range(1_000_000).select("id", F.lit("x").alias("v")).write.parquet(many)
    spark.range(10).select("id", F.lit("y").alias("w")).write.parquet(facts)
    fact = spark.read.parquet(facts).union(spark.read.parquet(many))
    assert "SortMergeJoin" in plan(fact.join(spark.read.parquet(many), "id"))
    assert "BroadcastHashJoin" in plan(fact.join(spark.read.parquet(few), "id"))


def test_keys_that_a_cycle_joins_many_times_are_not_broadcast(spark, tmp_path):
    """Neither some hundred thousand keys in files below a megabyte, nor some megabytes of rows after a shuffle."""
    keys, facts = str(tmp_path / "keys"), str(tmp_path / "facts")
    spark.range(0, 150_000, 1, 1).write.parquet(keys)
    spark.range(1_000_000).select("id", F.lit("y").alias("w")).write.parquet(facts)
    fact = spark.read.parquet(facts)
    assert "SortMergeJoin" in plan(fact.join(spark.read.parquet(keys), "id"))
    shuffled = fact.join(spark.range(600_000).groupBy("id").count(), "id")
    assert shuffled.count() == 600_000
    counted = shuffled.groupBy().count()
    counted.collect()
    assert "SortMergeJoin" in plan(counted) and "BroadcastHashJoin" not in plan(counted)


def test_sorted_files_are_skipped(spark, tmp_path):
    path = str(tmp_path / "sorted")
    df = spark.range(0, 200_000, numPartitions=8).select((F.col("id") * 7919 % 200_000).alias("at"), F.col("id").alias("v"))
    tables.write_sorted(df, path, ["at"], 8)
    ranges = [(r.lo, r.hi) for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()]
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(sorted(ranges)[:-1], sorted(ranges)[1:], strict=True))
