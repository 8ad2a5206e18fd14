"""Log of load steps: one appended row per state change, kept apart from the data commit."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.tables import append_row

SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.StringType(), False),
        T.StructField("process_name", T.StringType(), False),
        T.StructField("start_time", T.TimestampNTZType(), False),
        T.StructField("end_time", T.TimestampNTZType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("records_processed", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
STARTED, COMPLETED, ERROR = "STARTED", "COMPLETED", "ERROR"


def _now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def log_event(spark: SparkSession, path: str, process: str, status: str, records: int = 0, error: str | None = None, start: datetime | None = None) -> str:
    """Append one state; an end time only when the step completed."""
    now = _now()
    log_id = str(uuid.uuid4())
    row = (log_id, process, start or now, now if status == COMPLETED else None, status, records, error)
    append_row(spark, path, SCHEMA, row)
    return log_id


def run_step(spark: SparkSession, path: str, process: str, step: Callable[[], int | None]):
    """Log start and end of a step and the number of rows it returns; an error is logged and raised."""
    start = _now()
    log_event(spark, path, process, STARTED, start=start)
    try:
        done = step()
    except Exception as err:
        log_event(spark, path, process, ERROR, error=str(err), start=start)
        raise
    log_event(spark, path, process, COMPLETED, done or 0, start=start)
    return done


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def report(log: DataFrame) -> DataFrame:
    """Latest state, its duration in seconds, rows, number of runs and errors per process."""
    seconds = F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("start_time").cast("timestamp"))
    # Of two states with one start the one after STARTED is the later.
    order = F.struct("start_time", (F.col("status") != STARTED).cast("int"), F.col("end_time"))
    last = F.max_by(F.struct("status", "records_processed", "error_message", (seconds.cast("double") / 1e6).alias("seconds")), order)
    grouped = log.groupBy("process_name").agg(
        last.alias("last"),
        F.count_if(F.col("status") == STARTED).alias("runs"),
        F.count_if(F.col("status") == ERROR).alias("errors"),
    )
    return grouped.select("process_name", "last.status", "last.records_processed", "last.seconds", "last.error_message", "runs", "errors")
