"""Rows next to the row that follows them, without a window over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import settle

# Ids looked at for each cut.
PER_CUT = 100
# An id or a row that holds more than this part of an average partition is hot.
SHARE = 4


def _cut_at(ids: list[tuple[int, int]], n: int) -> list[int]:
    """At most n - 1 ids that cut (id, rows) into parts of about as many rows."""
    ids = sorted(ids)
    ends = np.cumsum([rows for _, rows in ids])
    wanted = np.searchsorted(ends, [int(ends[-1]) * k // n for k in range(1, n)]) if ids else []
    return sorted({ids[i][0] for i in wanted})


def _below(cuts: list[int]) -> Callable[[Column], Column]:
    """How many cuts lie above an id: the place of its range in descending order."""
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(len(edges) - np.searchsorted(edges, ids.to_numpy(np.int64), side="right"))

    return place


def descending_runs(df: DataFrame, id: str, text: str, partitions: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(id, text, borrowed), each partition in descending order of id, ties by a hash of the text and the text, NULL ids last.

    The order is cut into ranges, one or more to a partition. A range ends with the rows of the next range's first key, marked as
    borrowed; the last ends with those of the first. So each row that isn't borrowed is followed by its successor, the last one by
    the first. An id that holds more than a part of an average partition (`SHARE`), NULL among them, has ranges of its own, cut by
    the hash of the text; what is lent is at most that part. Cuts are drawn from about `PER_CUT` distinct ids a partition, weighted
    by their rows; they decide balance, not results.

    Rows equal in id and text that are more than that part come once, and the others are counted in the second table (id, text,
    copies), None if there are none: each of these is followed by its equal.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    held = settle(rows.groupBy("id").agg(F.count("*").alias("rows")), "ids")
    total, ids = held.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
    most = max(1, total // (SHARE * n))
    every = max(1, ids // (PER_CUT * n))
    hot = {r.id: r.rows for r in held.where(F.col("rows") > most).collect()}  # at most SHARE * n ids, or what a small table has
    drawn = [(r.id, r.rows) for r in held.where("id IS NOT NULL").where((F.pmod(F.xxhash64("id"), F.lit(every)) == 0) & (F.col("rows") <= most)).collect()]
    repeats = None
    if hot:
        keys = spark.createDataFrame([(i,) for i in hot], "hot long")
        busy = rows.join(F.broadcast(keys), F.col("id").eqNullSafe(F.col("hot")), "left_semi")
        often = settle(busy.groupBy("id", "mark").agg(F.count("*").alias("rows")).where(F.col("rows") > most).select(F.col("id").alias("o_id"), F.col("mark").alias("o_mark")), "often")
        if not often.isEmpty():
            same = F.col("id").eqNullSafe(F.col("o_id")) & (F.col("mark") == F.col("o_mark"))
            once = settle(rows.join(F.broadcast(often), same, "left_semi").groupBy("id", "text", "mark").agg(F.count("*").alias("rows")), "often-rows")
            rows = rows.join(F.broadcast(often), same, "left_anti").unionByName(once.drop("rows"))
            repeats = once.where("rows > 1").select("id", "text", (F.col("rows") - 1).alias("copies"))
    # A hot id lies between two cuts; the NULL ids come behind all others.
    own = [i for i in hot if i is not None]
    cuts = sorted({*_cut_at(drawn, n), *own, *(i + 1 for i in own if i < 2**63 - 1)})
    places = len(cuts) + 2
    parts, own_range = np.ones(places, int), np.zeros(places, bool)
    for i, held_rows in hot.items():
        at = places - 1 if i is None else len(cuts) - int(np.searchsorted(cuts, i, side="right"))
        parts[at], own_range[at] = -(-held_rows // most), True
    place = F.when(F.col("id").isNull(), F.lit(places - 1)).otherwise(_below(cuts)(F.coalesce("id", F.lit(0))))
    keyed = rows.withColumn("place", place)
    if hot:
        first = np.concatenate(([0], np.cumsum(parts)[:-1]))
        n_parts, begin, is_hot = (F.element_at(F.lit(x), F.col("place") + 1) for x in (parts.tolist(), first.tolist(), own_range.tolist()))
        within = F.least(F.floor((F.col("mark").cast("double") / F.lit(2.0**64) + 0.5) * n_parts), n_parts - 1)
        keyed = keyed.withColumn("run", (begin + within).cast("int")).withColumn("part", F.when(is_hot, F.col("mark")).otherwise(F.lit(0).cast("long")))
    else:
        keyed = keyed.withColumn("run", F.col("place")).withColumn("part", F.lit(0).cast("long"))
    # Of a hot id, only the rows of one hash are lent, else those of one id.
    tops = {r.run: (r.id, r.part) for r in keyed.groupBy("run").agg(F.max("id").alias("id"), F.min("part").alias("part")).collect()}  # one row a range
    used = sorted(tops)
    lends = [(*tops[low], high) for high, low in zip(used, [*used[1:], *used[:1]], strict=True)]
    lent = spark.createDataFrame(lends, "l_id long, l_part long, lent_to int")
    spread = keyed.join(F.broadcast(lent), F.col("id").eqNullSafe(F.col("l_id")) & (F.col("part") == F.col("l_part")), "left")
    own_place = F.struct(F.col("run").alias("run"), F.lit(False).alias("borrowed"))
    copy = F.struct(F.col("lent_to").alias("run"), F.lit(True).alias("borrowed"))
    spread = spread.select("id", "text", "mark", F.explode(F.when(F.col("lent_to").isNull(), F.array(own_place)).otherwise(F.array(own_place, copy))).alias("place"))
    dealt = spread.select("id", "text", "mark", "place.run", "place.borrowed").repartitionById(n, F.col("run"))
    return dealt.sortWithinPartitions("run", "borrowed", F.col("id").desc_nulls_last(), "mark", "text").select("id", "text", "borrowed"), repeats
