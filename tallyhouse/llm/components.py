"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import settle


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large: tie a node's larger neighbours to its least neighbour. Small: the same for its smaller ones and itself."""
    if large:
        seen = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # The least neighbour is reduced per task before the shuffle; a node with many neighbours is split by the skew join.
    least = seen.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    tied = seen.join(least, "a")
    if large:
        out = tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the least node it reaches, of every node in `links` (a, b).

    The links stay a table: each round writes them to the shared folder, until a round changes nothing. Rounds grow with the
    logarithm of the links.
    """
    links = settle(links.select("a", "b").where("a <> b").distinct(), "links")
    before = None
    while True:
        state = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before or state.n == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        links = settle(_star(_star(links, True), False), "links")
