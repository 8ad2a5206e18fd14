"""Parquet tables: typed reads, appends, and tables partitioned by the batch that wrote them."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition columns of a table that is written batch by batch. A feed is one source of batches, numbered on its own: a first
# load, or a stream with its checkpoint.
FEED, BATCH = "feed", "batch_id"


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """Files of a folder as a change feed; `pattern` picks files by name."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def append(df: DataFrame, path: str, partition: Sequence[str] = ()) -> None:
    """Append rows; a fact is partitioned by date, one set of files per date and task."""
    _by(df, partition).write.mode("append").partitionBy(*partition).parquet(path)


def _by(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    # Rebalance instead of hashing by date alone: a hot date is split over several tasks.
    return df.hint("rebalance", *partition) if partition else df


def append_row(spark: SparkSession, path: str, schema: T.StructType, row: Sequence) -> None:
    """Append one row of values known to the driver."""
    values = [F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(schema.fields, row, strict=True)]
    spark.range(0, 1, 1, 1).select(*values).write.mode("append").parquet(path)


def read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The table in a folder, None while nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _is_batch(feed: str, batch_id: int) -> Column:
    return (F.col(FEED) == feed) & (F.col(BATCH) == batch_id)


def put_batch(df: DataFrame, path: str, feed: str, batch_id: int, partition: Sequence[str] = ()) -> DataFrame:
    """Make `df` the rows of one batch of the table, in place of what an earlier run of the batch wrote, and read them back.

    The batch's own partition is overwritten, not only the partitions below it that `df` has rows for, as dynamic overwriting
    would: a run that ends with fewer dates, or with nothing, must not leave the others behind. No other batch is touched.
    """
    if not re.fullmatch(r"[\w.-]*[A-Za-z][\w.-]*", feed):
        raise ValueError(f"{feed!r} can't name a partition")
    own = f"{path}/{FEED}={feed}/{BATCH}={batch_id}"
    _by(df, partition).write.mode("overwrite").partitionBy(*partition).parquet(own)
    return df.sparkSession.read.schema(df.schema).parquet(own)


def batch_of(spark: SparkSession, path: str, feed: str, batch_id: int) -> DataFrame | None:
    """The rows of one batch, None if it never ran."""
    return read_if_any(spark, f"{path}/{FEED}={feed}/{BATCH}={batch_id}")


def all_batches(spark: SparkSession, path: str, without: tuple[str, int] | None = None) -> DataFrame | None:
    """The rows of all batches, or of all but one; which are read is partition pruning."""
    found = read_if_any(spark, path)
    if found is None:
        return None
    return (found.where(~_is_batch(*without)) if without else found).drop(FEED, BATCH)


def remove_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    """Delete the partitions of these values of the table's first partition column; those that aren't there are passed over."""
    for value in values:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={value}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def remove_batch(spark: SparkSession, path: str, feed: str, batch_id: int) -> None:
    """Leave no rows of one batch, as if it never ran."""
    remove_partitions(spark, f"{path}/{FEED}={feed}", BATCH, [batch_id])


def replace_partitions(df: DataFrame, path: str, partition: Sequence[str]) -> None:
    """Overwrite just the partitions that `df` has rows for. `df` must not read them: settle it first."""
    _by(df, partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """A catalog table bucketed by `key`, each bucket sorted by it (and `order`).

    Tables with the same key and number of buckets join and group by the key without an exchange, cycle after cycle; the number is
    chosen once, about one for each 128 MB of the largest of them. All rows of a key are in one bucket.
    """
    by = df.repartition(buckets, key)  # one file a bucket
    by.write.mode("overwrite").bucketBy(buckets, key).sortBy(key, *order).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def write_sorted(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Files that each hold a range of `order`, so that filters on it skip files and row groups by their minima and maxima; as many as
    the data needs, or `files`."""
    df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
