"""What a loop of Spark jobs leaves behind."""

from __future__ import annotations

import gc

from pyspark.sql import SparkSession


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files, broadcasts and plans of finished rounds.

    It does so when the driver's garbage is collected, which may not happen for a long time; a loop asks for it after each round, so
    that neither executors' disks nor the driver fill up with what no later round reads.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
