import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import presets as P
from tallyhouse.functions import scalars as S
from tallyhouse.operators import dedup, quality, referential, rules


def test_three_valued_rules(spark, rows):
    df = spark.createDataFrame([("a", "Available"), ("b", None), ("c", "Broken")], "k string, status string")
    assert rows(rules.keep_valid(df, [rules.in_domain("status", P.TABLE_STATUSES)]), "k") == [("a",), ("b",)]
    assert rows(rules.keep_valid(df, [rules.in_domain("status", P.TABLE_STATUSES, null="fail")]), "k") == [("a",)]


def test_blank_modes(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "k string")
    count = lambda blank: rules.count_broken(df, rules.required("k", blank=blank)).first()["broken"]
    assert (count("allowed"), count("empty"), count("trimmed")) == (1, 2, 3)


def test_formats_and_guarded_casts(spark, rows):
    df = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("2024-2-1",), ("2024-02-01\n",), (None,)], "d string")
    cast = df.select("d", S.safe_cast("d", "date").cast("string").alias("v"))
    assert dict(rows(cast)) == {"2024-02-29": "2024-02-29", "2023-02-29": None, "2024-2-1": None, "2024-02-01\n": None, None: None}
    money = spark.createDataFrame([("123.456",), ("-1",), ("1e3",), ("7",), ("99999999999",)], "d string")
    assert [v for _, v in rows(money.select("d", S.safe_cast("d", "decimal").cast("string")))] == [None, "123.46", None, "7.00", None]


def test_gate_counts_every_rule(spark):
    df = spark.createDataFrame([("a", 1), (None, -1), (None, 5)], "k string, n int")
    with pytest.raises(rules.GateError) as err:
        rules.gate(df, [*rules.required("k"), rules.at_least("n", 0)])
    assert err.value.counts == {"k required": 2, "n below 0": 1}
    assert rules.gate(df, [rules.at_least("n", -1)]) is df


def test_split_is_a_partition(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, -1), ("c", None)], "k string, n int")
    good, bad = rules.split(df, [*rules.required("k"), rules.at_least("n", 0)])
    assert rows(good, "k") == [("a",), ("c",)]
    assert bad.first()["reasons"] == ["k required", "n below 0"]


def test_normalise_and_defaults(spark, rows):
    df = spark.createDataFrame([(" SLOTS ",), ("slot",), ("Number",), (None,)], "type string")
    assert rows(rules.normalise(df, "type", P.GAME_TYPES)) == [("Slot",), ("Slot",)]
    assert rows(rules.normalise(df, "type", P.GAME_TYPES, unknown="keep")) == [("Slot",), ("Slot",), (None,), (None,)]


def test_foreign_keys(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "x")], "id int, k string")
    parent = spark.createDataFrame([("a",), ("b",)], "code string")
    assert rows(referential.fk_keep(child, parent, "k", "code"), "id") == [(1,)]
    assert rows(referential.fk_keep(child, parent, "k", "code", null_fk="keep"), "id") == [(1,), (3,)]
    assert rows(referential.orphans(child, parent, "k", "code")) == [("x", 2)]
    assert tuple(referential.orphan_counts(child, parent, "k", "code").first()) == (1, 2)
    with pytest.raises(rules.GateError):
        referential.fk_gate(child, parent, "k", "code")
    assert tuple(referential.orphan_counts(child.where("id = 1"), parent, "k", "code").first()) == (0, 0)


def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame([("A ", 1, None), (" a", 2, 5), ("b", 3, 1)], "k string, id int, v int")
    key = F.lower(F.trim("k"))
    assert rows(dedup.keep_latest(df, key, F.col("v").desc_nulls_last()), "id") == [(2,), (3,)]
    assert rows(dedup.keep_latest(df, key, F.col("v").desc_nulls_first()), "id") == [(1,), (3,)]
    assert rows(dedup.duplicate_keys(df.select(key.alias("k")), "k")) == [("a", 2)]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = dedup.keep_latest(df, "k", F.desc("id"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_constraints(spark, rows):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", None), (None, "x", 9)], "id int, ref string, n int")
    parent = spark.createDataFrame([("x",)], "code string")
    spec = quality.Constraints(not_null=["id"], key=["id"], foreign={"ref": (parent, "code")}, checks=[rules.at_least("n", 5)])
    assert dict(rows(quality.check_constraints(df, spec))) == {"id required": 1, "duplicate key id": 1, "orphan ref": 1, "n below 5": 1}


def test_age_on_29_february(spark):
    df = spark.createDataFrame([("2000-02-29",)], "b string").select(F.col("b").cast("date").alias("b"))
    on = lambda d: df.select(S.years_between(F.lit(d).cast("date"), "b")).first()[0]
    assert (on("2027-02-28"), on("2027-03-01"), on("2028-02-28"), on("2028-02-29")) == (26, 27, 27, 28)


def test_tiers_bands_departments_devices(spark, rows):
    df = spark.createDataFrame([(999,), (1000,), (5000,), (8000,), (10000,), (None,)], "p int")
    got = {r[0]: (r[1], r[2]) for r in df.select("p", S.tier("p"), S.tier("p", P.TIERS_REPORT)).collect()}
    assert got == {999: ("Bronze", "Bronze"), 1000: ("Silver", "Bronze"), 5000: ("Gold", "Gold"), 8000: ("Gold", "Platinum"), 10000: ("Platinum", "Platinum"), None: ("Bronze", "Bronze")}
    jobs = spark.createDataFrame([("Floor Manager",), ("Dealer Manager",), ("dealer",), ("Security",), (None,)], "p string")
    assert [r[0] for r in jobs.select(S.department("p")).collect()] == ["Management", "Management", "Operations", "Security", "Operations"]
    devices = spark.createDataFrame([("mobile tablet",), ("My TABLET",), ("PC",), (None,)], "d string")
    assert [r[0] for r in devices.select(S.device_class("d")).collect()] == ["Mobile", "Tablet", "Desktop", "Desktop"]


def test_initcap(spark):
    df = spark.createDataFrame([("slot-MACHINE x2y o'neil",), ("",), (None,), (" élan",)], "t string")
    assert [r[0] for r in df.select(S.initcap("t")).collect()] == ["Slot-Machine X2y O'Neil", "", None, " Élan"]


def test_dates(spark):
    sunday = spark.range(1).select(F.lit("2024-01-07").cast("date").alias("d"))
    row = sunday.select(S.day_of_week("d"), S.is_weekend("d"), S.day_name("d"), S.day_name("d", pad=True), S.month_name("d", pad=True)).first()
    assert tuple(row) == (0, True, "Sunday", "Sunday   ", "January  ")


def test_ratios(spark):
    df = spark.createDataFrame([("10.00", "3.00"), ("1.00", "0.00"), ("-0.05", "10.00")], "a string, b string").select(*[F.col(c).cast("decimal(12,2)").alias(c) for c in "ab"])
    got = [(str(r[0]), r[1]) for r in df.select(S.round_ratio(F.col("a"), F.col("b")), S.win_rate(F.col("a"), F.col("b"))).collect()]
    assert got == [("3.33", 10 / 3), ("None", 0.0), ("-0.01", -0.005)]
