import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyhouse.operators import joins, summaries, windows
from tallyhouse.session import settle


def events(spark):
    """One key with a third of all rows, gaps of several hours, equal times."""
    start = datetime(2024, 1, 1)
    data = []
    for i in range(120):
        key = "hot" if i % 3 == 0 else f"k{i % 5}"
        data.append((key, start + timedelta(minutes=(i * 37) % 900, hours=(i // 40) * 30), i, i % 4))
    data.append((None, start, 500, 1))
    data.append((None, start + timedelta(hours=5), 501, 2))
    return spark.createDataFrame(data, "k string, at timestamp_ntz, id int, v int")


def test_cut_windows_equal_whole_ones(spark, rows):
    df = events(spark)
    args = {"lag": ["at", "v"], "lead": ["id"], "running": ["v"]}
    whole = windows.neighbours(df, ["k"], ["at", "id"], **args)
    for width in ("hour", "day"):
        bucket = F.date_trunc(width, F.col("at").cast("timestamp"))
        # All keys cut, only the hot one cut, none cut.
        for hot_rows in (0, 20, 1000):
            cut = windows.neighbours(df, ["k"], ["at", "id"], bucket=bucket, hot_rows=hot_rows, **args)
            assert rows(cut.select(*whole.columns)) == rows(whole)


def test_cut_windows_equal_whole_ones_with_nulls(spark, rows):
    """Keys, times and values that are NULL here and there, in every combination."""
    rng = random.Random(5)
    for _ in range(4):
        data = []
        for i in range(150):
            key = rng.choice([None, "hot", "hot", f"k{rng.randint(0, 2)}"])
            time = None if rng.random() < 0.25 else datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 2000))
            data.append((key, time, i, None if rng.random() < 0.5 else rng.randint(-3, 3)))
        df = spark.createDataFrame(data, "k string, at timestamp_ntz, id int, v int")
        bucket = F.date_trunc("hour", F.col("at").cast("timestamp"))
        for args in ({"lag": ["at", "v"], "lead": ["v"], "running": ["v"]}, {"lag": ["at"], "lead": ["at"]}):
            whole = windows.neighbours(df, ["k"], ["at", "id"], **args)
            for hot_rows in (0, 40):
                cut = windows.neighbours(df, ["k"], ["at", "id"], bucket=bucket, hot_rows=hot_rows, **args)
                assert rows(cut.select(*whole.columns)) == rows(whole)


def test_minutes_round_half_up(spark, rows):
    at = [datetime(2024, 1, 1, 0, 0, 0), datetime(2024, 1, 1, 0, 1, 30), datetime(2024, 1, 1, 0, 2, 59)]
    df = spark.createDataFrame([("a", x) for x in at], "k string, at timestamp_ntz")
    assert rows(windows.minutes_since_previous(df, ["k"], "at"), "session_duration_minutes") == [(1,), (2,), (None,)]


def test_distributed_ranks_and_shares(spark):
    values = [i % 17 if i % 3 else 5 for i in range(400)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    known = [v for v in values if v is not None]
    for buckets in (1, 8, 64, None):
        got = {r["id"]: r for r in windows.rank_desc(df, "v", buckets).collect()}
        assert len(got) == 400
        for i, v in enumerate(values[:-1]):
            assert got[i]["rank"] == 1 + sum(x > v for x in known)
            assert got[i]["dense_rank"] == 1 + len({x for x in known if x > v})
    shares = {r["id"]: r for r in windows.cumulative_share(df, "v", 8).collect()}
    for i, v in enumerate(values[:-1]):
        assert shares[i]["row_share"] == sum(x >= v for x in known) / 400
        assert shares[i]["value_share"] == sum(x for x in known if x >= v) / sum(known)


def test_growth_over_gaps(spark, rows):
    df = spark.createDataFrame([("2024-01-01", 10), ("2024-03-01", 5)], "m string, v int").select(F.col("m").cast("date").alias("month"), "v")
    spine = windows.month_spine(df, "month").join(df, "month", "left").na.fill(0)
    got = windows.growth(spine, "v", "month", {"mom": 1}).select("v", "mom_previous", "mom_growth").collect()
    assert sorted(tuple(r) for r in got if r[1] is not None) == [(0, 10, -1.0), (5, 0, None)]


def test_top_per_group_and_share(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), ("b", 4)], "g string, v int")
    assert rows(windows.top_per_group(df, ["g"], [F.desc("v")], 2)) == [("a", 2, 2), ("a", 3, 1), ("b", 4, 1)]
    assert rows(windows.share_of_total(df, {"v": "share"}), "v", "share") == [(1, 0.1), (2, 0.2), (3, 0.3), (4, 0.4)]


def test_hot_keys_are_named_by_a_sketch(spark):
    data = [("hot",)] * 4000 + [(None,)] * 900 + [(f"k{i % 3000}",) for i in range(6000)]
    df = spark.createDataFrame(data, "k string").repartition(6)
    hot = windows.hot_keys(df, ["k"], 500)
    named = {r.k for r in df.where(windows.is_key(["k"], hot)).distinct().collect()}
    assert named == {"hot", None}
    assert windows.hot_keys(df.limit(0), ["k"], 1) == [] and windows.hot_keys(df, ["k"], 10_000) == []
    many = spark.range(windows.NAMED + 50).select(F.explode(F.array(*[F.col("id")] * 3)).alias("k"))
    assert windows.hot_keys(many, ["k"], 2) is None


def test_only_hot_keys_are_salted(spark, rows):
    fact = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i % 7}", i) for i in range(300)], "k string, i int")
    dim = spark.createDataFrame([("hot", 1), ("k1", 2), ("k5", 3)], "k string, v int")
    hot = windows.hot_keys(fact, ["k"], 60)
    for how in ("inner", "left", "left_semi"):
        salted = joins.lookup(fact, dim, "k", how, salts=4, hot=hot)
        assert rows(salted) == rows(fact.join(dim, "k", how)) == rows(joins.lookup(fact, dim, "k", how, salts=4)) == rows(joins.lookup(fact, dim, "k", how, salts=4, hot=[]))


def test_spans_are_carried_forward(spark, rows):
    """Against the interval join: hot keys, NULL keys and times, zero-length, closed and missing spans."""
    rng = random.Random(8)
    day = lambda d: datetime(2024, 1, 1) + timedelta(hours=6 * d)
    spans = []
    for key in ["hot", "a", "b", None]:
        at = sorted(rng.choices(range(800), k=60 if key == "hot" else 4))
        ends = [*at[1:], None if key != "b" else at[-1] + 3]
        spans += [(key, day(s), None if e is None else day(e - (1 if rng.random() < 0.3 and e > s else 0)), f"{key}{n}") for n, (s, e) in enumerate(zip(at, ends, strict=True))]
    spans.append(("a", None, day(3), "timeless"))
    fact = [(rng.choice(["hot", "hot", "a", "b", "c", None]), None if rng.random() < 0.1 else day(rng.randint(-5, 820)), i) for i in range(400)]
    fact = spark.createDataFrame(fact, "k string, at timestamp_ntz, i int")
    spans = spark.createDataFrame(spans, "k string, since timestamp_ntz, until timestamp_ntz, v string")
    want = joins.in_interval(fact, spans, "k", "at", "since", "until", many=10)
    for width in ("day", "month"):
        got = joins.carried_forward(fact, spans, "k", "at", "since", "until", width)
        assert rows(got.select(*want.columns)) == rows(want)


def test_players_are_counted_again_from_bitmaps(spark, rows):
    rng = random.Random(9)
    fact = spark.createDataFrame([(f"d{rng.randint(1, 9)}", "L", f"g{rng.randint(1, 3)}", None if i % 50 == 0 else rng.randint(0, 70_000)) for i in range(30_000)], "full_date string, location_code string, game_name string, player_key long")
    first = fact.where("full_date < 'd4'")
    numbers = summaries.number_players(first)
    numbers = settle(numbers.unionByName(summaries.number_players(fact, settle(numbers, "numbers"))), "numbers")
    n = fact.select("player_key").where("player_key IS NOT NULL").distinct().count()
    assert sorted(r.number for r in numbers.collect()) == list(range(1, n + 1))
    stored = summaries.daily_players(fact, numbers)
    assert stored.select("bucket").distinct().count() == 1
    for groups in (["game_name"], ["full_date"], []):
        assert rows(summaries.fold_players(stored, *groups)) == rows(fact.groupBy(*groups).agg(F.count_distinct("player_key").alias("total_players")))
    # Numbers far apart lie in several bitmaps.
    far = numbers.withColumn("number", F.col("number") * 1000)
    assert rows(summaries.fold_players(summaries.daily_players(fact, far))) == [(n,)]
