"""Structured Streaming jobs. What a row trigger would do, a micro-batch does for all its rows."""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tallyhouse.operators import dimensions, merge
from tallyhouse.plans.warehouse import History, Warehouse
from tallyhouse.session import scratch
from tallyhouse.sources.tables import all_batches, append, put_batch, stream_table


def in_steps(df: DataFrame, at: str, cuts: Sequence[str], run: Callable[[DataFrame], None], label: str = "feed") -> None:
    """Play a stored table as a stream: the rows before the first cut arrive and are run, then those before the next, and so on.

    Rows without a time arrive first. `run` gets the same stream each time and goes on from its checkpoint.
    """
    in_steps_together([(df, at)], cuts, run, label)


def in_steps_together(feeds: Sequence[tuple[DataFrame, str]], cuts: Sequence[str], run: Callable[..., None], label: str = "feed") -> None:
    """As `in_steps` for several tables, each with the time its rows arrive; `run` gets a stream of each."""
    spark = feeds[0][0].sparkSession
    paths = [scratch(spark, label) for _ in feeds]
    edges = [None, *cuts, None]
    for low, high in zip(edges, edges[1:], strict=False):
        for (df, at), path in zip(feeds, paths, strict=True):
            part = df
            if low:
                part = part.where(F.col(at) >= F.lit(low).cast("timestamp_ntz"))
            if high:
                before = F.col(at) < F.lit(high).cast("timestamp_ntz")
                part = part.where(before if low else before | F.col(at).isNull())
            append(part, path)
        run(*[stream_table(spark, path, df.schema) for (df, _), path in zip(feeds, paths, strict=True)])


class LateRows(StreamingQueryListener):
    """Counts the rows that a query's watermark dropped, over all its micro-batches."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        self.rows.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def finish(query: StreamingQuery, seconds: int | None = None) -> None:
    """Wait until everything available is done; with `seconds`, stop and fail after that long."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        query.stop()
        raise TimeoutError(f"stream still running after {seconds} s")
    if query.exception():
        raise query.exception()


def feed_of(checkpoint: str) -> str:
    """The name of a stream's batches in a table: a checkpoint numbers its batches on its own."""
    return "stream-" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All that is available, micro-batch by micro-batch. `step` may see a batch twice and has to cope."""
    finish(stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_append(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append to a Parquet table, each row exactly once; returns the number of late rows."""
    spark, late = stream.sparkSession, LateRows()
    spark.streams.addListener(late)
    try:
        writer: DataStreamWriter = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        finish(query)
        # Events come in order, that of the end last.
        run = str(query.runId)
        while run not in late.ended:
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(late)
    return late.rows.get(run, 0)


# -- dimensions


def scd2_stream(stream: DataFrame, history: History, tracked: Sequence[str], at: str, checkpoint: str, ties: Sequence[str] = (), width: str | None = None) -> None:
    """Apply a change feed to a type-2 dimension; several states of a key in one batch count in time order."""

    def step(batch: DataFrame, batch_id: int) -> None:
        history.merge(batch, batch_id, tracked, at, ties, width, feed_of(checkpoint))

    run_batches(stream, step, checkpoint)


def device_stream(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Add the devices of new logins; a batch that runs again leaves out its own rows when it looks for known ones."""
    feed = feed_of(checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = dimensions.device_dim(batch)
        known = all_batches(batch.sparkSession, path, without=(feed, batch_id))
        put_batch(rows if known is None else merge.append_new(known, rows, "device_id"), path, feed, batch_id)

    run_batches(stream, step, checkpoint)


# -- facts


def gaming_stream(stream: DataFrame, house: Warehouse, src: Mapping[str, DataFrame], checkpoint: str, session: str | None = None) -> None:
    """Plays into fact, bridge and summary, in that order; players and games may come later than their plays."""
    run_batches(stream, lambda batch, batch_id: house.add_plays(batch, src, batch_id, session, feed_of(checkpoint)), checkpoint)


def waiting_plays(
    plays: DataFrame, new_players: DataFrame, known_players: DataFrame, games: DataFrame, attrs: Sequence[str], wait: str, keep: str, delay: str, at: str = "play_time", known_at: str = "known_at"
) -> DataFrame:
    """Plays with the attributes of their player, who may be known, or come later as a stream; no batch has to be repeated for that.

    Games and known players are tables, joined as each micro-batch comes. A play of a player who isn't known there waits in the
    state of the join for `wait` of event time and comes out as soon as the player does, or without attributes when
    the watermark says that none will. Players who come are kept for `keep` of event time, for plays that follow. `booked` is
    known, waited or unmatched. Each player comes once in `new_players`.
    """
    timed = with_event_time(plays, at, delay).join(games, "game_name", "left_semi")
    known = known_players.select("player_email", *attrs, F.lit(True).alias("_known"))
    looked_up = timed.join(known, "player_email", "left")
    direct = looked_up.where(F.col("_known")).drop("_known").withColumn("booked", F.lit("known"))
    left = looked_up.where(F.col("_known").isNull()).drop("_known", *attrs)
    right = with_event_time(new_players.select(F.col("player_email").alias("_player"), known_at, *attrs), known_at, delay)
    meets = F.expr(f"player_email = _player AND {known_at} <= {at} + interval {wait} AND {known_at} >= {at} - interval {keep}")
    waited = left.join(right, meets, "left").withColumn("booked", F.when(F.col("_player").isNull(), "unmatched").otherwise("waited"))
    columns = [*plays.columns, *attrs, "booked"]
    return direct.select(*columns).unionByName(waited.select(*columns))


def transaction_stream(stream: DataFrame, house: Warehouse, src: Mapping[str, DataFrame], checkpoint: str) -> None:
    run_batches(stream, lambda batch, batch_id: house.add_transactions(batch, src, batch_id, feed_of(checkpoint)), checkpoint)


# -- event-time results


def with_event_time(stream: DataFrame, at: str, delay: str) -> DataFrame:
    """Watermark on a zone-less time, which has to become a TIMESTAMP (session zone UTC) first."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def deduplicated(stream: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """First row per key; copies that come within `delay` are left out."""
    return with_event_time(stream, at, delay).dropDuplicatesWithinWatermark(list(key))


# Bits of a sketch of players: its standard error is 1.04 / 2**(bits / 2), about 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 0.05  # three standard errors


def _window_totals(stream: DataFrame, window: Column, keys: Sequence[str], value: str) -> DataFrame:
    grouped = stream.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.hll_sketch_agg("player_email", SKETCH_BITS).alias("players"))
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "n", "total", "players")


def players_by(windows: DataFrame, *groups: Column | str) -> DataFrame:
    """Distinct players of coarser groups (days, all games) from the sketches of the windows, without a look at the plays."""
    return windows.groupBy(*groups).agg(F.hll_sketch_estimate(F.hll_union_agg("players")).alias("players"))


def with_late(totals: DataFrame, arrived: DataFrame, at: str, width: str, keys: Sequence[str], closed: Column) -> DataFrame:
    """The stored totals of windows with `late`, how many of a window's rows came after it had been given out.

    `arrived` are all rows that ever came, as a table; windows that end after `closed` may still be open and are left out.
    """
    window = F.window(F.col(at).cast("timestamp"), width)
    counted = arrived.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("arrived"))
    counted = counted.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.col("w.end").cast("timestamp_ntz").alias("window_end"), *keys, "arrived")
    both = counted.where(F.col("window_end") <= closed).join(totals, ["window_start", "window_end", *keys], "left")
    return both.withColumn("n", F.coalesce("n", F.lit(0))).withColumn("late", F.col("arrived") - F.col("n")).drop("arrived")


def tumbling(stream: DataFrame, at: str, width: str, delay: str, keys: Sequence[str], value: str) -> DataFrame:
    """Totals per window, given out once the watermark has passed its end."""
    return _window_totals(with_event_time(stream, at, delay), F.window(at, width), keys, value)


def sliding(stream: DataFrame, at: str, width: str, slide: str, delay: str, keys: Sequence[str], value: str) -> DataFrame:
    return _window_totals(with_event_time(stream, at, delay), F.window(at, width, slide), keys, value)


def sessions(stream: DataFrame, at: str, gap: str, delay: str, key: str, value: str) -> DataFrame:
    """Sessions per key that have been quiet for `gap`, with duration in minutes from first to last event."""
    timed = with_event_time(stream, at, delay)
    grouped = timed.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total"), F.max(at).alias("last"))
    micros = F.unix_micros("last") - F.unix_micros("w.start")
    return grouped.select(key, F.col("w.start").cast("timestamp_ntz").alias("session_start"), F.col("w.end").cast("timestamp_ntz").alias("session_end"), "events", "total", micros.alias("duration_us"))


def new_paths(spark: SparkSession, label: str) -> tuple[str, str]:
    """(table, checkpoint) folders for one run."""
    root = scratch(spark, label)
    return f"{root}/table", f"{root}/checkpoint"
