"""Micro-batches that run twice, dimension rows that come late, histories in steps."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import scd2, summaries
from tallyhouse.plans.warehouse import History, Warehouse, run_cycle
from tallyhouse.session import scratch
from tallyhouse.sources.tables import batch_of
from tallyhouse.streaming import jobs


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def sources(spark, players=("p1", "p2")):
    make = spark.createDataFrame
    return {
        "game": make([("g1", "Poker", 1, 5)], "game_name string, type string, min_bet int, max_bet int"),
        "casino_location": make([("L1", "One", "a", "c", "s", "x")], "location_code string, name string, address string, city string, state string, country string"),
        "player": make([(p, "F", "L", at(1).date(), at(1), 10) for p in players], "email string, first_name string, last_name string, dob date, registration_date timestamp_ntz, loyalty_points int"),
        "staff": make([("s1", "S", "T", "Dealer", at(1).date())], "staff_email string, first_name string, last_name string, position string, hire_date date"),
        "table_game": make([("t1", "g1", "L1")], "table_code string, game_name string, location_code string"),
        "staff_assigned_tables": make([("s1", "t1")], "staff_email string, table_code string"),
    }


def plays(spark, data):
    df = spark.createDataFrame(data, "player_email string, game_name string, play_time timestamp_ntz, amount_bet int, amount_won int")
    return df.withColumns({c: F.col(c).cast("decimal(12,2)") for c in ("amount_bet", "amount_won")})


def test_batches_that_run_again(spark, rows):
    house = Warehouse(spark, scratch(spark, "again"))
    src = sources(spark)
    house.load_dimensions(src, F.lit("2024-01-01").cast("timestamp_ntz"), 0)
    first = plays(spark, [("p1", "g1", at(1), 10, 5), ("p2", "g1", at(1), 1, 1)])
    second = plays(spark, [("p1", "g1", at(1, 5), 3, 0), ("p1", "g1", at(1), 10, 5), ("p1", "g1", at(2), 7, 7)])
    house.add_plays(first, src, 0)
    house.add_plays(first, src, 0)
    house.add_plays(second, src, 1)
    house.add_plays(second, src, 1)
    fact = house.gaming()
    assert rows(fact, "player_key", "play_time") == [("p1", at(1)), ("p1", at(1, 5)), ("p1", at(2)), ("p2", at(1))]
    kept = rows(fact)
    assert rows(house.bridge()) == rows(summaries.bridge(fact))
    # Long done batches, in any order.
    house.add_plays(first, src, 0)
    house.add_plays(second, src, 1)
    fact = Warehouse(spark, house.root).gaming()
    assert rows(fact) == kept and rows(house.bridge()) == rows(summaries.bridge(fact))
    whole = summaries.daily_summary(fact)
    assert rows(house.daily_summary().select(*whole.columns)) == rows(whole)
    # The stored players fold to the same counts; a player has one number, whichever batch ran last.
    per_day = fact.groupBy("full_date").agg(F.count_distinct("player_key").alias("total_players"))
    assert rows(house.players_by("full_date")) == rows(per_day) and rows(house.players_by()) == [(2,)]
    numbers = house.table("player_numbers")
    assert numbers.count() == numbers.select("player_key").distinct().count() == numbers.select("number").distinct().count() == 2


def test_failure_between_fact_and_summary(spark, rows, monkeypatch):
    house = Warehouse(spark, scratch(spark, "failed"))
    src = sources(spark)
    house.load_dimensions(src, F.lit("2024-01-01").cast("timestamp_ntz"), 0)
    batch = plays(spark, [("p1", "g1", at(1), 10, 5), ("zz", "g1", at(1), 1, 1)])
    real = house.refresh_days
    monkeypatch.setattr(house, "refresh_days", lambda *_: 1 / 0)
    try:
        house.add_plays(batch, src, 0)
    except ZeroDivisionError:
        pass
    monkeypatch.setattr(house, "refresh_days", real)
    house.add_plays(batch, src, 0)
    assert house.gaming().count() == 1
    assert rows(house.bridge(), "total_plays") == [(1,)]
    assert rows(house.pending(), "player_email") == [("zz",)]
    assert house.log().where("status = 'ERROR'").count() == 1


def test_late_player_and_cycles(spark, rows):
    house = Warehouse(spark, scratch(spark, "late"))
    src = sources(spark, ["p1"])
    run_cycle(house, src | {"player_game": plays(spark, [("p1", "g1", at(1), 10, 5), ("p2", "g1", at(1), 2, 2)])}, F.lit("2024-01-01").cast("timestamp_ntz"), 0)
    assert house.gaming().count() == 1
    run_cycle(house, sources(spark) | {"player_game": plays(spark, [("p1", "g1", at(3), 1, 1)])}, F.lit("2024-01-02").cast("timestamp_ntz"), 1)
    assert rows(house.gaming(), "player_key") == [("p1",), ("p1",), ("p2",)]
    assert house.pending().count() == 0
    assert rows(house.players.rows(), "player_key", "version_number") == [("p1", 1), ("p2", 1)]


def test_history_in_steps(spark, rows):
    schema = "k string, tier string, at timestamp_ntz"
    steps = [
        [("a", "S", at(1)), ("b", "S", at(1))],
        [("a", "G", at(2)), ("a", "P", at(3)), ("a", "P", at(4))],
        [("a", "S", at(5)), ("b", "S", at(5)), ("c", "G", at(5))],
    ]
    history = History(spark, scratch(spark, "history"), "k", parts=4)
    for n, data in enumerate(steps):
        for _ in range(2):
            history.merge(spark.createDataFrame(data, schema), n, ["tier"], "at")
    whole = scd2.build(spark.createDataFrame(sum(steps, []), schema), "k", ["tier"], "at")
    assert rows(history.rows().select(*whole.columns)) == rows(whole)
    assert history.open_rows().count() == 3
    history.merge(spark.createDataFrame([("b", "G", at(6))], schema), 3, ["tier"], "at")
    assert rows(history.open_rows(), "k", "tier", "version_number") == [("a", "S", 4), ("b", "G", 2), ("c", "G", 1)]
    assert batch_of(spark, f"{history.path}/states", "load", 3).count() == 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_history_of_states_in_random_order(spark, rows, seed):
    """Late states split closed versions, confirm them, or join equal neighbours; batches run again or twice; NULL times and values."""
    rng = random.Random(seed)
    schema = "k string, tier string, note string, at timestamp_ntz, seq int"
    states = [(rng.choice("abcd"), rng.choice(["S", "G", None]), f"n{i}", None if i % 17 == 0 else at(rng.randint(1, 9)), i) for i in range(60)]
    whole = scd2.build(spark.createDataFrame(states, schema), "k", ["tier"], "at", ["seq"])
    rng.shuffle(states)
    history = History(spark, scratch(spark, "random"), "k", parts=3)
    cuts = [0, 5, 6, 25, 60]
    for n, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        for again in {n, rng.randint(0, n)}:
            history.merge(spark.createDataFrame(states[cuts[again] : cuts[again + 1]], schema), again, ["tier"], "at", ["seq"])
    assert rows(history.rows().select(*whole.columns)) == rows(whole)
    assert {r.breaches for r in scd2.check(whole.where("start_date IS NOT NULL"), "k").where("rule IN ('overlap', 'gap', 'open_flag')").collect()} == {0}


@pytest.mark.parametrize("seed", [4])
def test_history_after_batches_run_again_with_other_states(spark, rows, seed):
    """Keys that only an earlier run of a batch had go, or are what the other batches say; later states find the right place."""
    rng = random.Random(seed)
    schema = "k string, tier string, at timestamp_ntz, seq int"
    history = History(spark, scratch(spark, "other-states"), "k", parts=3)
    now = {}
    for i, n in enumerate([0, 1, 0, 2, 1, 1, 3]):
        size = 0 if i == 5 else rng.randint(1, 4)
        now[n] = [(k, rng.choice(["S", "G", None]), at(rng.randint(1, 9)), 100 * i + j) for j, k in enumerate(rng.sample("abcde", size))]
        history.merge(spark.createDataFrame(now[n], schema), n, ["tier"], "at", ["seq"])
        whole = scd2.build(spark.createDataFrame(sum(now.values(), []), schema), "k", ["tier"], "at", ["seq"])
        assert rows(history.rows().select(*whole.columns)) == rows(whole)


def test_last_state_is_known_after_a_batch_runs_again(spark, rows):
    schema = "k string, tier string, at timestamp_ntz"
    history = History(spark, scratch(spark, "again-seen"), "k", parts=2)
    first, second = [("a", "S", at(1))], [("a", "G", at(5))]
    for n, data in ((0, first), (1, second), (0, first), (2, [("a", "P", at(3))])):
        history.merge(spark.createDataFrame(data, schema), n, ["tier"], "at")
    assert rows(history.rows(), "tier", "start_date") == [("G", at(5)), ("P", at(3)), ("S", at(1))]


def test_batch_that_runs_again_with_other_rows(spark, rows, monkeypatch):
    """Dates, players and games that a batch has no more leave summary, bitmaps, bridge and minutes, also when a run in between failed."""
    house, src = Warehouse(spark, scratch(spark, "other-rows")), sources(spark, ("p1", "p2", "p3"))
    house.load_dimensions(src, F.lit("2024-01-01").cast("timestamp_ntz"), 0)

    def check(kept):
        fact = house.gaming()
        assert rows(fact, "player_key", "play_time") == sorted((p, t) for p, _, t, _, _ in kept)
        last, minutes = {}, {}
        for p, _, t, _, _ in sorted(kept, key=lambda r: (r[0], r[2])):
            minutes[p, t] = None if p not in last else (t - last[p]).total_seconds() // 60
            last[p] = t
        assert {(r.player_key, r.play_time): r.session_duration_minutes for r in fact.collect()} == minutes
        assert rows(house.bridge()) == rows(summaries.bridge(fact))
        daily = summaries.daily_summary(fact)
        assert rows(house.daily_summary().select(*daily.columns)) == rows(daily)
        assert rows(house.players_by("full_date")) == rows(fact.groupBy("full_date").agg(F.count_distinct("player_key").alias("n")))

    base = [("p1", "g1", at(1), 1, 0), ("p2", "g1", at(1), 1, 0)]
    wrong = [("p1", "g1", at(2), 2, 0), ("p2", "g1", at(3), 2, 0), ("p3", "g1", at(3), 2, 0), ("p1", "g1", at(4), 2, 0)]
    later = [("p2", "g1", at(6), 1, 0), ("p3", "g1", at(6), 1, 0), ("p1", "g1", at(6), 1, 0)]
    right = [("p1", "g1", at(2), 2, 0), ("p1", "g1", at(5), 1, 0)]
    for n, data in ((0, base), (1, wrong), (2, later)):
        house.add_plays(plays(spark, data), src, n, "hour")
    check(base + wrong + later)
    real = house.refresh_days
    monkeypatch.setattr(house, "refresh_days", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        house.add_plays(plays(spark, right), src, 1, "hour")
    monkeypatch.setattr(house, "refresh_days", real)
    for _ in range(2):
        house.add_plays(plays(spark, right), src, 1, "hour")
        check(base + right + later)
    house.add_plays(plays(spark, []), src, 1, "hour")
    check(base + later)


def test_only_late_keys_are_built_again(spark, rows, monkeypatch):
    schema = "k string, tier string, at timestamp_ntz"
    history = History(spark, scratch(spark, "late-keys"), "k", parts=2)
    history.merge(spark.createDataFrame([("a", "S", at(1)), ("a", "G", at(5)), ("b", "S", at(1))], schema), 0, ["tier"], "at")
    built, real = [], scd2.build
    monkeypatch.setattr(scd2, "build", lambda states, *a, **b: (built.append(rows(states, "k")), real(states, *a, **b))[1])
    history.merge(spark.createDataFrame([("b", "G", at(2))], schema), 1, ["tier"], "at")
    assert built == []
    history.merge(spark.createDataFrame([("a", "P", at(3)), ("b", "P", at(3))], schema), 2, ["tier"], "at")
    assert built == [[("a",)] * 3]
    want = [("a", "S", at(1), at(3), 1), ("a", "P", at(3), at(5), 2), ("a", "G", at(5), None, 3), ("b", "S", at(1), at(2), 1), ("b", "G", at(2), at(3), 2), ("b", "P", at(3), None, 3)]
    assert sorted((tuple(r) for r in history.rows().select("k", "tier", "start_date", "end_date", "version_number").collect()), key=lambda r: (r[0], r[4])) == want


def test_late_rows_are_counted(spark, rows):
    start = at(1)
    first = [("a", start + timedelta(minutes=m), 1) for m in (0, 10, 200)]
    late = [("a", start + timedelta(minutes=5), 1), ("b", start + timedelta(minutes=190), 1), ("c", start + timedelta(minutes=500), 1)]
    table, checkpoint = jobs.new_paths(spark, "late-rows")
    folder = scratch(spark, "late-feed")
    schema = "player_email string, at timestamp_ntz, v int"
    dropped = 0
    for part in (first, late):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        dropped += jobs.run_append(jobs.tumbling(stream, "at", "1 hour", "10 minutes", [], "v"), table, checkpoint)
    assert dropped == 1
    assert rows(spark.read.parquet(table), "window_start", "n") == [(at(1), 2), (at(1, 3), 2)]


def test_feeds_share_a_warehouse(spark, rows):
    """A first load and a stream whose batches both count from 0, each batch run twice, lose and overwrite nothing."""
    house, src = Warehouse(spark, scratch(spark, "feeds")), sources(spark)
    house.load_dimensions(src, F.lit("2024-01-01").cast("timestamp_ntz"), 0)
    loads = [[("p1", "g1", at(1), 10, 5)], [("p2", "g1", at(2), 4, 0)]]
    streamed = [[("p1", "g1", at(1, 3), 1, 0), ("p2", "g1", at(1), 2, 2)], [("p1", "g1", at(1), 10, 5), ("p1", "g1", at(4), 3, 3)]]
    for feed, batches in (("load", loads[:1]), ("stream-x", streamed), ("load", loads)):
        for n, data in enumerate(batches):
            for _ in range(2):
                house.add_plays(plays(spark, data), src, n, "hour", feed)
    whole = {(p, t): (b, w) for data in loads + streamed for p, _, t, b, w in data}
    fact = house.gaming()
    assert rows(fact, "player_key", "play_time") == sorted(whole)
    minutes = {(r.player_key, r.play_time): r.session_duration_minutes for r in fact.collect()}
    assert minutes == {("p1", at(1)): None, ("p1", at(1, 3)): 180, ("p1", at(4)): 69 * 60, ("p2", at(1)): None, ("p2", at(2)): 24 * 60}
    assert rows(house.bridge()) == rows(summaries.bridge(fact))
    daily = summaries.daily_summary(fact)
    assert rows(house.daily_summary().select(*daily.columns)) == rows(daily)
    assert rows(Warehouse(spark, house.root).gaming()) == rows(fact)


def test_late_plays_set_the_minutes_right(spark, rows):
    house, src = Warehouse(spark, scratch(spark, "minutes")), sources(spark)
    house.load_dimensions(src, F.lit("2024-01-01").cast("timestamp_ntz"), 0)
    for n, data in enumerate([[("p1", "g1", at(1), 1, 1), ("p1", "g1", at(3), 1, 1), ("p2", "g1", at(1), 1, 1)], [("p1", "g1", at(2), 1, 1), ("p2", "g1", at(1, 1), 1, 1)]]):
        house.add_plays(plays(spark, data), src, n, "hour")
    want = [("p1", at(1), None), ("p1", at(2), 1440), ("p1", at(3), 1440), ("p2", at(1), None), ("p2", at(1, 1), 60)]
    got = house.gaming().select("player_key", "play_time", "session_duration_minutes").collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == want


def test_rows_without_time_are_played(spark, rows):
    df = spark.createDataFrame([(1, at(1)), (2, None), (3, at(9))], "id int, at timestamp_ntz")
    table, checkpoint = jobs.new_paths(spark, "timeless")
    jobs.in_steps(df, "at", ["2024-01-05"], lambda stream: jobs.run_append(stream, table, checkpoint))
    assert rows(spark.read.parquet(table), "id") == [(1,), (2,), (3,)]


def waiting(spark, root, steps):
    """Plays and players as two streams, in steps, a new query each time."""
    play, person = "event_id int, player_email string, game_name string, play_time timestamp_ntz", "player_email string, known_at timestamp_ntz, tier string"
    known = spark.createDataFrame([("old", "Gold")], "player_email string, tier string")
    games = spark.createDataFrame([("g1",)], "game_name string")
    for n, (some, people) in enumerate(steps):
        spark.createDataFrame(some, play).coalesce(1).write.mode("append").parquet(f"{root}/plays")
        spark.createDataFrame(people, person).coalesce(1).write.mode("append").parquet(f"{root}/people")
        streams = [spark.readStream.schema(x).parquet(f"{root}/{y}") for x, y in ((play, "plays"), (person, "people"))]
        jobs.run_append(jobs.waiting_plays(*streams, known, games, ["tier"], "2 days", "20 days", "1 hour"), f"{root}/table", f"{root}/checkpoint")
        yield n, sorted((r.event_id, r.booked, r.tier) for r in spark.read.parquet(f"{root}/table").collect())


def test_plays_wait_for_their_player_in_the_stream(spark):
    steps = [
        ([(1, "old", "g1", at(1)), (2, "new", "g1", at(1)), (3, "never", "g1", at(1)), (4, "slow", "g1", at(1)), (5, "old", "none", at(1)), (6, None, "g1", at(1))], [("else", at(1), "X")]),
        ([(7, "new", "g1", at(2))], [("new", at(2), "Silver")]),
        ([(8, "slow", "g1", at(9)), (9, "new", "g1", at(9))], [("slow", at(9), "Bronze")]),
        ([(10, "late", "g1", at(12))], [("else2", at(12), "X")]),
    ]
    seen = dict(waiting(spark, scratch(spark, "waiting"), steps))
    assert seen[0] == [(1, "known", "Gold")]
    assert seen[1] == [(1, "known", "Gold"), (2, "waited", "Silver"), (7, "waited", "Silver")]
    # The player "slow" came eight days after the play 4, and "never" not at all.
    done = [(1, "known", "Gold"), (2, "waited", "Silver"), (3, "unmatched", None), (4, "unmatched", None), (6, "unmatched", None), (7, "waited", "Silver"), (8, "waited", "Bronze"), (9, "waited", "Silver")]
    assert seen[3] == done


def test_state_lies_in_rocksdb_and_outlives_a_restart(spark, rows):
    root = scratch(spark, "rocks")
    schema = "event_id int, ts timestamp_ntz"
    # The same id in a later batch, within the delay, after it, and late.
    for part in ([(1, at(1)), (2, at(1, 1)), (3, at(1, 2))], [(3, at(1, 2)), (2, at(1, 3)), (4, at(2))], [(3, at(3)), (1, at(1)), (4, at(2))]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        stream = spark.readStream.schema(schema).parquet(f"{root}/feed")
        jobs.run_append(jobs.deduplicated(stream, ["event_id"], "ts", "4 hours"), f"{root}/table", f"{root}/checkpoint")
    got = spark.read.parquet(f"{root}/table").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
    assert rows(got) == [(1, at(1)), (2, at(1, 1)), (3, at(1, 2)), (3, at(3)), (4, at(2))]
    kept = [str(p) for p in Path(f"{root}/checkpoint/state").rglob("*")]
    assert any(p.endswith(".changelog") for p in kept) and not any(p.endswith(".delta") for p in kept)


def test_players_are_folded_from_sketches(spark):
    data = [(f"p{i % 700}", at(1 + i % 3, i % 24), 1) for i in range(6000)]
    df = spark.createDataFrame(data, "player_email string, at timestamp_ntz, v int")
    hours = jobs._window_totals(df.withColumn("at", F.col("at").cast("timestamp")), F.window("at", "1 hour"), [], "v")
    exact = df.select("player_email").distinct().count()
    assert abs(jobs.players_by(hours).first().players - exact) <= jobs.SKETCH_ERROR * exact
    days = {r.d: r.players for r in jobs.players_by(hours, F.to_date("window_start").alias("d")).collect()}
    for day in (1, 2, 3):
        own = len({p for p, t, _ in data if t.day == day})
        assert abs(days[at(day).date()] - own) <= jobs.SKETCH_ERROR * own
