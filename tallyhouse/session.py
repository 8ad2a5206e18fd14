"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# SQL settings the library is designed for; every one may be set at run time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # An overflowing sum or a bad cast is an error, never a wrong value.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key of an inner, left, semi or anti join is split into several tasks,
    # even where that costs another exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcast only what is small; nothing in the library hints it. Before a run Spark knows no more than the files' compressed size,
    # of which a row may take a byte, and fifty in the driver's hash table; after a shuffle it has measured the rows, of which that table
    # takes three times the size. Either way about 12 MB are sent at most: a cycle of the warehouse has dozens of joins.
    "spark.sql.autoBroadcastJoinThreshold": str(256 << 10),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(4 << 20),
    "spark.sql.files.maxPartitionBytes": str(128 << 20),
    # Adaptive execution lowers the number of shuffle partitions to what the data needs and never
    # raises it, so it starts high. On terabytes set it to about the input's gigabytes times ten.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    # Spark 4.1 may take a union of shuffled inputs for partitioned by their key and then,
    # after the adaptive coalescing of one input, fails to line up the partitions.
    "spark.sql.unionOutputPartitioning": "false",
    # The state of streams lies on local disk instead of the executors' heap, and a batch adds only its changes to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set them on a session that was built elsewhere; a number of shuffle partitions that someone chose stays."""
    chosen = spark.conf.get("spark.sql.shuffle.partitions") != "200" or spark.conf.get(INITIAL, None) is not None
    for key, value in SQL_SETTINGS.items():
        if key != INITIAL or not chosen:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tallyhouse", master: str | None = None, partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `partitions` only for small local runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    settings = {**SQL_SETTINGS, **extra}
    if partitions:
        settings |= {"spark.sql.shuffle.partitions": str(partitions), INITIAL: str(partitions)}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders given out by `scratch`, by application.
_GIVEN: dict[str, list[str]] = {}


def work_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or else a folder in the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name inside the shared folder."""
    path = f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete the folders given out within the block when it ends; results have to be written or collected before."""
    given = _GIVEN.setdefault(spark.sparkContext.applicationId, [])
    before = len(given)
    try:
        yield
    finally:
        for path in given[before:]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del given[before:]


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    For a result that several branches of one plan read: it is computed once, its
    lineage ends, and a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
