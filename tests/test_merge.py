from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyhouse.operators import joins, merge, scd2

TABLE = "k int, a string, b int"


def frame(spark, data):
    return spark.createDataFrame(data, TABLE)


def test_upsert_actions(spark, rows):
    cur = frame(spark, [(1, "x", 1), (2, None, 2), (3, "z", None), (4, "w", 4)])
    inc = frame(spark, [(1, "x", 1), (2, None, 3), (3, "z", None), (5, "new", 5)])
    got = merge.upsert(cur, inc, "k")
    assert rows(got) == [(1, "x", 1, "same"), (2, None, 3, "update"), (3, "z", None, "same"), (4, "w", 4, "keep"), (5, "new", 5, "insert")]
    assert tuple(merge.action_counts(got).first()) == (1, 1, 2, 1)


def test_null_to_value_is_a_change(spark, rows):
    got = merge.upsert(frame(spark, [(1, None, 1)]), frame(spark, [(1, "x", 1)]), "k")
    assert rows(got) == [(1, "x", 1, "update")]


def test_upsert_of_nothing(spark, rows):
    cur = frame(spark, [(1, "x", 1)])
    assert rows(merge.upsert(cur, cur.limit(0), "k").drop("action")) == rows(cur)
    assert rows(merge.upsert(cur.limit(0), cur, "k").drop("action")) == rows(cur)


side = st.dictionaries(st.integers(0, 6), st.tuples(st.sampled_from(["p", "q", None]), st.sampled_from([1, 2, None])), max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(side, side)
def test_upsert_twice_is_once(spark, left, right):
    cur, inc = (frame(spark, [(k, *v) for k, v in d.items()]) for d in (left, right))
    once = {r[0]: tuple(r[1:]) for r in merge.upsert(cur, inc, "k").drop("action").collect()}
    assert once == {**left, **right}
    again = merge.upsert(frame(spark, [(k, *v) for k, v in once.items()]), inc, "k")
    assert not again.where(F.col("action").isin("insert", "update")).count()


def test_append_insert_replace_accumulate(spark, rows):
    cur = frame(spark, [(1, "x", 1), (2, "y", 2)])
    inc = frame(spark, [(2, "Y", 20), (3, "z", 30)])
    assert rows(merge.append_new(cur, inc, "k")) == [(3, "z", 30)]
    assert rows(merge.insert_absent(cur, inc, "k")) == [(1, "x", 1), (2, "y", 2), (3, "z", 30)]
    assert rows(merge.replace_groups(cur, inc, "k")) == [(1, "x", 1), (2, "Y", 20), (3, "z", 30)]
    nulls = frame(spark, [(None, "n", 1)])
    assert rows(merge.replace_groups(nulls, frame(spark, [(None, "m", 2)]), "k")) == [(None, "m", 2)]
    assert rows(merge.accumulate(cur, frame(spark, [(2, "a", None), (3, "z", None)]), "k", {"a": "min", "b": "sum"})) == [(1, "x", 1), (2, "a", 2), (3, "z", 0)]


def test_salted_lookup_equals_plain(spark, rows):
    fact = spark.range(300).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7).alias("k"), "id")
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "k long, name string")
    for how in ("inner", "left", "left_semi"):
        assert rows(joins.lookup(fact, dim, "k", how, salts=4)) == rows(joins.lookup(fact, dim, "k", how))


def ts(day):
    return datetime(2024, 1, day)


def state(spark, data):
    return spark.createDataFrame(data, "k string, tier string, note string, at timestamp_ntz")


def test_scd2_several_states_of_one_key(spark, rows):
    dim = scd2.init(state(spark, [("a", "S", "n1", ts(1)), ("b", "S", "n1", ts(1))]), "at")
    news = state(spark, [("a", "S", "n2", ts(2)), ("a", "G", "n3", ts(3)), ("a", "G", "n4", ts(4)), ("a", "S", "n5", ts(5)), ("c", "B", "n6", ts(2))])
    for width in (None, "day"):
        got = scd2.merge(dim, news, "k", ["tier"], "at", width=width, hot_rows=0)
        want = [
            ("a", "G", "n3", ts(3), ts(5), False, 2),
            ("a", "S", "n1", ts(1), ts(3), False, 1),
            ("a", "S", "n5", ts(5), None, True, 3),
            ("b", "S", "n1", ts(1), None, True, 1),
            ("c", "B", "n6", ts(2), None, True, 1),
        ]
        assert rows(got) == want
        assert not scd2.check(got, "k").where("breaches > 0").count()
        # The same news again changes nothing but what their order implies for an open row.
        last = state(spark, [("a", "S", "n5", ts(5)), ("c", "B", "x", ts(9))])
        assert rows(scd2.merge(got, last, "k", ["tier"], "at", width=width, hot_rows=1)) == want


def test_scd2_null_comparison(spark, rows):
    dim = scd2.init(state(spark, [("a", "S", "n", ts(1))]), "at")
    news = state(spark, [("a", None, "n", ts(2))])
    assert scd2.merge(dim, news, "k", ["tier"], "at").count() == 2
    assert scd2.merge(dim, news, "k", ["tier"], "at", null_safe=False).count() == 1


def test_scd2_late_state(spark, rows):
    dim = scd2.init(state(spark, [("a", "S", "n", ts(5))]), "at")
    got = scd2.merge(dim, state(spark, [("a", "G", "n", ts(2))]), "k", ["tier"], "at")
    assert rows(got, "tier", "start_date", "end_date") == [("G", ts(5), None), ("S", ts(5), ts(5))]


def test_scd2_asof_and_check(spark, rows):
    dim = scd2.build(state(spark, [("a", "S", "n", ts(1)), ("a", "G", "n", ts(3))]), "k", ["tier"], "at")
    fact = spark.createDataFrame([("a", ts(1)), ("a", ts(2)), ("a", ts(3)), ("z", ts(3)), ("a", datetime(2023, 1, 1))], "k string, t timestamp_ntz")
    got = scd2.as_of(fact, dim, "k", "t", ["tier"])
    assert rows(got, "k", "t", "tier") == [("a", datetime(2023, 1, 1), None), ("a", ts(1), "S"), ("a", ts(2), "S"), ("a", ts(3), "G"), ("z", ts(3), None)]
    broken = dim.withColumn("is_current", F.lit(True))
    assert dict(rows(scd2.check(broken, "k")))["one_current"] == 1
