"""The warehouse in a folder: first load, incremental cycles, and the batches of streams, side by side.

Every change carries a feed and a batch number of that feed, which are partition columns. A batch leaves out what all other batches
have, and overwrites its own partition; so it may run again after a failure at any point, or any time later, and feeds never touch
each other's rows. It may also run again with other rows: dates, players and keys that only an earlier run had are noted before its
rows go, and what was derived from them is computed again. Only rows that another batch left out, since this one had them, do not
come back before that other batch runs again too.

    <table>/feed=<f>/batch_id=<n>/   dimensions, facts (below it full_date=<d>/), bridge changes, pending plays, last plays
    dim_player/, dim_staff/          histories, see `History`
    daily_summary/full_date=<d>/     only touched dates are rewritten, as in daily_players/, the players of a day as bitmaps
    replaced_days/                   dates of earlier runs of a batch, by feed and batch
    run_log/
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions import scalars as S
from tallyhouse.operators import dimensions, facts, merge, scd2, summaries, windows
from tallyhouse.session import settle
from tallyhouse.sources import run_log
from tallyhouse.sources.tables import all_batches, batch_of, put_batch, read_if_any, remove_batch, remove_partitions, replace_partitions

FACT_KEY = ("full_date", "player_key", "game_name", "play_time")
LOAD = "load"
PLAY_ORDER = ("game_name", "bet_amount", "win_amount")


def _dates(df: DataFrame | None) -> list:
    """Calendar dates of a batch: as literals they prune partitions, and there are only so many days."""
    return [] if df is None else [row["full_date"] for row in df.select("full_date").distinct().collect()]


class History:
    """A type-2 dimension in a folder, which may get its states late and in any order.

        states/   the states as they came, by feed and batch
        rows/     the versions, by a hash of the key (`part`), each with the time of its key's last state (`seen`)
        replaced/ keys of earlier runs of a batch, by feed and batch

    A batch rewrites only the parts that its keys lie in. A batch that runs again replaces its states and builds its keys, and those
    it had before, from all states that there are, so nothing counts twice and nothing stays that no state says.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, parts: int = 16):
        self.spark, self.path, self.key, self.parts = spark, path.rstrip("/"), key, parts

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def rows(self) -> DataFrame | None:
        rows = read_if_any(self.spark, f"{self.path}/rows")
        return None if rows is None else rows.drop("part", "seen")

    def open_rows(self, keys: DataFrame | None = None) -> DataFrame | None:
        """The open versions, or those of the given keys only."""
        rows = self.rows()
        if rows is None:
            return None
        now = rows.where(F.col("is_current"))
        return now if keys is None else now.join(keys, self.key, "left_semi")

    def merge(self, batch: DataFrame, batch_id: int, tracked: Sequence[str], at: Column | str, ties: Sequence[str] = (), width: str | None = None, feed: str = LOAD) -> None:
        when = (F.col(at) if isinstance(at, str) else at).cast("timestamp_ntz")
        states = f"{self.path}/states"
        replaced = self._note_replaced(feed, batch_id)
        others = all_batches(self.spark, states, without=(feed, batch_id))
        batch = batch.withColumn("_at", when)
        batch = put_batch(batch.drop(at) if isinstance(at, str) else batch, states, feed, batch_id)
        touched = batch.select(self.key)
        if replaced is not None:
            touched = settle(touched.unionByName(replaced).distinct(), "touched")
        parts = sorted(r["part"] for r in touched.select(self._part().alias("part")).distinct().collect())  # `parts` at most
        rows = read_if_any(self.spark, f"{self.path}/rows")
        if rows is None:
            now = scd2.init(batch.drop(*ties, "_at"), F.lit(None)).where(F.lit(False))
            seen = batch.select(self.key, "_at").where(F.lit(False))
        else:
            rows = rows.where(F.col("part").isin(parts))
            now, seen = rows.drop("part", "seen"), rows.where(F.col("is_current")).select(self.key, F.col("seen").alias("_at"))
        if replaced is None:
            merged = scd2.splice(now, batch, others, seen, self.key, tracked, "_at", ties, width=width)
            came = batch
        else:
            # What the earlier runs added is in the rows: build their keys, and this run's, from all states that there are now.
            came = batch if others is None else others.select(*batch.columns).unionByName(batch)
            came = came.join(touched, self.key, "left_semi")
            again = scd2.build(came, self.key, tracked, "_at", ties, width=width).select(*now.columns)
            merged = now.join(touched, self.key, "left_anti").unionByName(again)
            seen = seen.join(touched, self.key, "left_anti")
        last = seen.unionByName(came.select(self.key, "_at")).groupBy(self.key).agg(F.max("_at").alias("seen"))
        merged = settle(merged.join(last, self.key, "left").withColumn("part", self._part()), "versions")
        replace_partitions(merged, f"{self.path}/rows", ["part"])
        if replaced is not None:
            filled = {r["part"] for r in merged.select("part").distinct().collect()}
            remove_partitions(self.spark, f"{self.path}/rows", "part", [p for p in parts if p not in filled])

    def _note_replaced(self, feed: str, batch_id: int) -> DataFrame | None:
        """The keys that earlier runs of the batch had, None if there was none; stored before their states are replaced, so that a run
        which fails in between forgets none."""
        before = batch_of(self.spark, f"{self.path}/states", feed, batch_id)
        if before is None:
            return None
        keys, noted = before.select(self.key), batch_of(self.spark, f"{self.path}/replaced", feed, batch_id)
        keys = settle((keys if noted is None else keys.unionByName(noted)).distinct(), "replaced")
        return put_batch(keys, f"{self.path}/replaced", feed, batch_id)


# Dimensions without history: source, rows, key.
PLAIN = {
    "dim_time": ("player_game", lambda df: dimensions.date_dim(df, "play_time"), "full_date"),
    "dim_game": ("game", dimensions.game_dim, "game_name"),
    "dim_location": ("casino_location", dimensions.location_dim, "location_code"),
    "dim_slot_machine": ("slot_machine", dimensions.slot_machine_dim, "machine_code"),
    "dim_device": ("login_history", dimensions.device_dim, "device_id"),
}


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.players = History(spark, self._path("dim_player"), "player_key")
        self.staff = History(spark, self._path("dim_staff"), "staff_key")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- reading

    def table(self, name: str, without: tuple[str, int] | None = None) -> DataFrame | None:
        """A table that is written by batches; `without` leaves out one of them."""
        return all_batches(self.spark, self._path(name), without)

    def daily_summary(self) -> DataFrame | None:
        return read_if_any(self.spark, self._path("daily_summary"))

    def players_by(self, *groups) -> DataFrame | None:
        """Distinct players of any groups of dates, places and games (columns of the daily summary, or expressions of them), from the
        stored bitmaps: exact, and the plays aren't read."""
        daily = read_if_any(self.spark, self._path("daily_players"))
        return None if daily is None else summaries.fold_players(daily, *groups)

    def gaming(self, width: str = "hour") -> DataFrame | None:
        """The plays. Minutes since the previous play are as booked, but computed again for players one of whose plays came
        after a later one had been booked."""
        fact, late = self.table("gaming"), self.table("late_players")
        if fact is None or late is None:
            return fact
        late = late.select("player_key").distinct()
        again = windows.minutes_since_previous(fact.join(late, "player_key", "left_semi"), ["player_key"], "play_time", PLAY_ORDER, width=width)
        return fact.join(late, "player_key", "left_anti").unionByName(again.select(*fact.columns))

    def pending(self, without: tuple[str, int] | None = None) -> DataFrame | None:
        """Plays that had no player or game when they came and aren't booked yet. `without`: as if that batch hadn't run."""
        waiting, fact = self.table("pending", without), self.table("gaming", without)
        if waiting is None or fact is None:
            return waiting
        booked = fact.select(F.col("player_key").alias("player_email"), "game_name", "play_time")
        return merge.append_new(booked, waiting, ["player_email", "game_name", "play_time"])

    def log(self) -> DataFrame:
        return run_log.read_log(self.spark, f"{self.root}/run_log")

    # -- writing

    def _step(self, name: str, step):
        return run_log.run_step(self.spark, f"{self.root}/run_log", name, step)

    def _put(self, name: str, df: DataFrame, feed: str, batch_id: int, partition: Sequence[str] = ()) -> int:
        return put_batch(df, self._path(name), feed, batch_id, partition).count()

    def load_dimensions(self, src: Mapping[str, DataFrame], as_of: Column, batch_id: int, feed: str = LOAD) -> None:
        """Dates, games, places, machines, devices, players, staff, in this order; any may be missing."""

        def add(name: str) -> int:
            source, build, key = PLAIN[name]
            rows, known = build(src[source]), self.table(name, without=(feed, batch_id))
            return self._put(name, rows if known is None else merge.append_new(known, rows, key), feed, batch_id)

        for name in PLAIN:
            if PLAIN[name][0] in src:
                self._step(name, lambda name=name: add(name))
        if "player" in src:
            rows = dimensions.player_rows(src["player"], as_of.cast("date"))
            self._step("dim_player", lambda: self.players.merge(rows, batch_id, dimensions.PLAYER_TRACKED, as_of, feed=feed))
        if "staff" in src:
            rows = dimensions.staff_rows(src["staff"])
            self._step("dim_staff", lambda: self.staff.merge(rows, batch_id, dimensions.STAFF_TRACKED, as_of, feed=feed))

    def add_plays(self, plays: DataFrame, src: Mapping[str, DataFrame], batch_id: int, session: str | None = None, feed: str = LOAD) -> None:
        """Plays of one batch into fact, bridge and daily summary.

        Plays of a player or game that has no dimension row yet wait in the table `pending` and are tried again with every later
        batch. `session` adds the minutes since the player's previous play, in whatever batch that came.
        """
        plays = settle(plays, "plays")
        waiting = self.pending(without=(feed, batch_id))
        offered = plays if waiting is None else plays.unionByName(waiting.select(*plays.columns))
        known_players = self.players.open_rows().select(F.col("player_key").alias("player_email"))
        known_games = self.table("dim_game").select("game_name")

        def write_fact() -> int:
            self._note_days(batch_id, feed)
            built = facts.gaming_fact(
                offered,
                self.players.open_rows(),
                self.table("dim_game"),
                src["table_game"],
                src["staff_assigned_tables"],
                self.staff.open_rows(),
                self.table("dim_location"),
                src.get("slot_play"),
                src.get("slot_machine"),
                src.get("login_history"),
                session=None,
            )
            return self._append_fact("gaming", built, FACT_KEY, batch_id, feed, session)

        def write_bridge() -> int:
            new = batch_of(self.spark, self._path("gaming"), feed, batch_id)
            if new is None:
                remove_batch(self.spark, self._path("bridge_changes"), feed, batch_id)
                return 0
            return self._put("bridge_changes", summaries.bridge(new), feed, batch_id)

        def write_numbers() -> int:
            new = batch_of(self.spark, self._path("gaming"), feed, batch_id)
            return 0 if new is None else self._number_players(new, batch_id, feed)

        def write_pending() -> int:
            unknown = plays.join(known_players, "player_email", "left_anti")
            misplaced = plays.join(known_players, "player_email", "left_semi").join(known_games, "game_name", "left_anti")
            return self._put("pending", unknown.unionByName(misplaced), feed, batch_id)

        self._step("fact_gaming_activity", write_fact)
        self._step("bridge_game_player", write_bridge)
        self._step("player_numbers", write_numbers)
        self._step("daily_summary", lambda: self.refresh_days(batch_id, feed))
        self._step("pending", write_pending)

    def _append_fact(self, name: str, built: DataFrame, key: Sequence[str], batch_id: int, feed: str, session: str | None = None) -> int:
        """Append the rows that all other batches lack. The date is in the key, so only touched dates are looked at."""
        before = self.table(name, without=(feed, batch_id))
        if before is not None:
            built = settle(built, f"batch-{name}")
            built = merge.append_new(before.where(F.col("full_date").isin(_dates(built))), built, key)
        if session:
            built = self._with_minutes(settle(built, f"new-{name}"), batch_id, feed, session)
        return self._put(name, built, feed, batch_id, ["full_date"])

    def _with_minutes(self, new: DataFrame, batch_id: int, feed: str, width: str) -> DataFrame:
        """Minutes since the previous play, of which the player's last one in earlier batches is kept as state."""
        keyed = windows.minutes_since_previous(new, ["player_key"], "play_time", PLAY_ORDER, width=width)
        ends = new.groupBy("player_key").agg(F.min("play_time").alias("first_play"), F.max("play_time").alias("last_play"))
        state = self.table("last_plays", without=(feed, batch_id))
        if state is not None:
            # Players of an earlier run only: later batches counted from plays that are gone.
            before = batch_of(self.spark, self._path("last_plays"), feed, batch_id)
            noted = batch_of(self.spark, self._path("late_players"), feed, batch_id)
            earlier = state.join(new.select("player_key").distinct(), "player_key", "left_semi").groupBy("player_key").agg(F.max("last_play").alias("before"))
            # Equal times are ordered by game and amounts, which only the whole history shows.
            late = ends.join(earlier, "player_key").where("first_play <= before").select("player_key")
            if before is not None:
                late = late.unionByName(before.select("player_key").join(ends, "player_key", "left_anti"))
            if noted is not None:
                late = late.unionByName(noted)
            self._put("late_players", settle(late.distinct(), "late-players"), feed, batch_id)
            keyed = keyed.join(earlier, "player_key", "left")
            carried = F.when(F.col("session_duration_minutes").isNull(), S.minutes_between("play_time", "before")).otherwise(F.col("session_duration_minutes"))
            keyed = keyed.withColumn("session_duration_minutes", carried).drop("before")
        self._put("last_plays", ends.select("player_key", "last_play"), feed, batch_id)
        return keyed.select(*new.columns)

    def _number_players(self, plays: DataFrame, batch_id: int, feed: str) -> int:
        """Numbers for players without one. A number stays for good, since the bitmaps of other batches' days hold it: a batch that
        runs again keeps what it gave."""
        fresh = settle(summaries.number_players(plays, self.table("player_numbers")), "numbers")
        own = batch_of(self.spark, self._path("player_numbers"), feed, batch_id)
        if own is not None:
            if fresh.isEmpty():
                return own.count()
            fresh = settle(own.unionByName(fresh), "numbers")
        return self._put("player_numbers", fresh, feed, batch_id)

    def _note_days(self, batch_id: int, feed: str) -> None:
        """Keep the dates that earlier runs of the batch had plays on, before these are replaced: their summaries change too."""
        before = batch_of(self.spark, self._path("gaming"), feed, batch_id)
        if before is None:
            return
        days, noted = before.select("full_date"), batch_of(self.spark, self._path("replaced_days"), feed, batch_id)
        days = days if noted is None else days.unionByName(noted)
        self._put("replaced_days", settle(days.distinct(), "replaced-days"), feed, batch_id)

    def refresh_days(self, batch_id: int, feed: str = LOAD) -> int:
        """Compute the summary and the players of the dates that the batch has or had plays on again and replace just these dates."""
        parts = [batch_of(self.spark, self._path(name), feed, batch_id) for name in ("gaming", "replaced_days")]
        days = sorted({day for part in parts for day in _dates(part) if day is not None})
        if not days:
            return 0
        fact = self.table("gaming")
        fact = None if fact is None else fact.where(F.col("full_date").isin(days))
        played = set(_dates(fact))
        if played:
            replace_partitions(summaries.daily_summary(fact), self._path("daily_summary"), ["full_date"])
            replace_partitions(summaries.daily_players(fact, self.table("player_numbers")), self._path("daily_players"), ["full_date"])
        for name in ("daily_summary", "daily_players"):
            remove_partitions(self.spark, self._path(name), "full_date", [day for day in days if day not in played])
        return len(days)

    def bridge(self) -> DataFrame:
        """Totals per player and game: the changes of all batches folded."""
        changes = self.table("bridge_changes")
        return merge.accumulate(changes, changes.limit(0), summaries.BRIDGE_KEY, summaries.BRIDGE_FOLDS)

    def add_transactions(self, transactions: DataFrame, src: Mapping[str, DataFrame], batch_id: int, feed: str = LOAD) -> None:
        def write() -> int:
            built = facts.txn_fact(transactions, self.players.open_rows(), src["table_game"], src["staff_assigned_tables"], self.staff.open_rows())
            return self._append_fact("transactions", built, ["full_date", "transaction_code"], batch_id, feed)

        self._step("fact_financial_transactions", write)


def run_cycle(house: Warehouse, src: Mapping[str, DataFrame], as_of: Column, batch_id: int, session: str | None = None, feed: str = LOAD) -> None:
    """One cycle: dimensions, then facts, bridge and summaries, each step logged.

    The first load and every later one, daily or monthly, are this function on another scope.
    """

    def cycle():
        house.load_dimensions(src, as_of, batch_id, feed)
        if "player_game" in src:
            house.add_plays(src["player_game"], src, batch_id, session, feed)
        if "transaction" in src:
            house.add_transactions(src["transaction"], src, batch_id, feed)

    house._step("cycle", cycle)
