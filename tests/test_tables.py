import shutil

import pytest
from pyspark.sql import functions as F

from tallyhouse import session
from tallyhouse.sources import run_log, tables


def test_a_batch_replaces_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    assert tables.all_batches(spark, path) is None and tables.batch_of(spark, path, "a", 0) is None
    df = spark.range(10).withColumn("day", F.col("id") % 2)
    for feed, batch, data in (("a", 0, df), ("b", 0, df), ("a", 1, df), ("a", 1, df.where("day = 1").limit(4))):
        assert tables.put_batch(data, path, feed, batch, ["day"]).count() == data.count()
    assert tables.all_batches(spark, path).count() == 24 and tables.all_batches(spark, path, without=("b", 0)).count() == 14
    # Dates of the earlier run are gone, and a run that ends with nothing leaves nothing.
    assert tables.batch_of(spark, path, "a", 1).where("day = 0").count() == 0
    tables.put_batch(df.limit(0), path, "a", 1, ["day"])
    assert tables.all_batches(spark, path).count() == 20 and tables.batch_of(spark, path, "a", 1) is None
    for feed in ("a/b", "12", "x=y", ""):
        with pytest.raises(ValueError):
            tables.put_batch(df, path, feed, 0)


def test_other_batches_are_not_read(spark, tmp_path):
    path = str(tmp_path / "fact")
    for batch in range(3):
        tables.put_batch(spark.range(5), path, "load", batch)
    others = tables.all_batches(spark, path, without=("load", 1))
    shutil.rmtree(f"{path}/feed=load/batch_id=1")
    assert others.count() == 10


def test_partitions_are_replaced(spark, rows, tmp_path):
    path = str(tmp_path / "days")
    tables.replace_partitions(spark.createDataFrame([(1, "x"), (2, "y")], "v int, day string"), path, ["day"])
    tables.replace_partitions(spark.createDataFrame([(3, "y"), (4, "z")], "v int, day string"), path, ["day"])
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,), (4,)]


def test_log(spark, tmp_path):
    path = str(tmp_path / "log")
    run_log.run_step(spark, path, "good", lambda: 5)

    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_log.run_step(spark, path, "bad", fail)
    run_log.run_step(spark, path, "good", lambda: None)
    got = {r["process_name"]: r for r in run_log.report(run_log.read_log(spark, path)).collect()}
    assert (got["good"]["status"], got["good"]["runs"], got["good"]["errors"]) == ("COMPLETED", 2, 0)
    assert (got["bad"]["status"], got["bad"]["error_message"], got["bad"]["errors"]) == ("ERROR", "no", 1)
    assert got["good"]["seconds"] >= 0 and got["bad"]["seconds"] is None


def test_work_dir_is_the_shared_folder(spark):
    assert session.scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
