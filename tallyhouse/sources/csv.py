"""CSV files as text staging tables, and CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A text that no file holds, so that no field is taken for NULL by its content.
NO_NULL_TEXT = "\u0001"
SCAN_ORDER = ("_file", "_block", "_row")


def read_csv_staging(spark: SparkSession, path: str, columns: Sequence[str], force_null: bool = False, multiline: bool | None = None, ordered: bool = False) -> DataFrame:
    """Every column as text, types never inferred; `ordered` adds the place of each row in its files.

    An unquoted empty field is NULL and a quoted one is ''; force_null makes both NULL. Files are split into tasks either way:
    line by line, or with `multiline`, where quoted fields may hold line breaks, record by record (`records`). Unless told which,
    the quotes are counted first.
    """
    options = {"escape": '"', **({"nullValue": ""} if force_null else {"nullValue": NO_NULL_TEXT, "emptyValue": ""})}
    if multiline is None:
        multiline = not _lines(spark, path).where("odd = 1").isEmpty()
    if multiline:
        schema = ", ".join(f"`{c}` string" for c in columns)
        parsed = records(spark, path).withColumn("_csv", F.from_csv("value", schema, options))
        return parsed.select("_csv.*", *(SCAN_ORDER if ordered else ()))
    scan = spark.read.schema(_text_schema(columns)).options(header=True, **options).csv(path)
    return scan.select("*", *_place()) if ordered else scan


def _place() -> list[Column]:
    """Where a scan is: file, split and row."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines in their place; `odd` is 1 where the number of quotes is odd, so that a quoted field begins or ends."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select("value", *_place()).withColumn("odd", quotes % 2)


def records(spark: SparkSession, path: str) -> DataFrame:
    """`value`, the text of every record but the files' headers, with its place; quoted fields may hold line breaks.

    A line begins a record if the quotes before it in its file are even in number. So the quotes of each split are counted, a prefix
    sum over the splits says which begin inside a quoted field, and each split finds its records on its own. Only the last record of
    a split and what goes before the first one of the next meet across splits.
    """
    lines = _lines(spark, path)
    split, earlier = ["_file", "_block"], (Window.unboundedPreceding, -1)
    splits = lines.groupBy(*split).agg((F.sum("odd") % 2).alias("odd"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(*earlier)  # a row is a split
    inside = splits.select(*split, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"))
    along = Window.partitionBy(*split).orderBy("_row")
    starts = (F.coalesce(F.sum("odd").over(along.rowsBetween(*earlier)), F.lit(0)) + F.col("inside")) % 2 == 0
    placed = lines.join(inside, split).withColumn("first", F.row_number().over(along) == 1).withColumn("start", F.when(starts, F.col("_row")))
    placed = placed.withColumn("record", F.max("start").over(along.rowsBetween(Window.unboundedPreceding, 0))).withColumn("final", F.max("start").over(Window.partitionBy(*split)))
    header = (F.col("_block") == 0) & F.col("first")
    line = F.struct("_block", "_row", "value", header.alias("header"))

    def joined(rows: DataFrame, keys: list[str]) -> DataFrame:
        whole = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(line)).alias("lines"))
        text = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x.value), "\n"), "\r$", "")
        return whole.where(~F.col("lines")[0].header).select(text.alias("value"), "_file", F.col("lines")[0]["_block"].alias("_block"), F.col("lines")[0]["_row"].alias("_row"))

    own = F.col("record") < F.col("final")
    across = placed.where(~F.coalesce(own, F.lit(False)))
    within_file = Window.partitionBy("_file").orderBy("_block", "_row").rowsBetween(Window.unboundedPreceding, 0)
    across = across.withColumn("record", F.last("start", ignorenulls=True).over(within_file))
    found = joined(placed.where(own), [*split, "record"]).unionByName(joined(across, ["_file", "record"]))
    return found.where(F.trim("value") != "")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """With header; NULL as an empty field, '' as a quoted one."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", '""').option("nullValue", "").csv(path)


def _text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
