"""N-gram Jaccard join: which documents' shingle sets are alike, exactly, as a size-aware heavy-light join.

A document's set holds its distinct shingles of five words, as 64-bit hashes; fewer words make one shingle, no word none. Two
sets link if 100 |A & B| >= 75 |A | B|.

Equal sets are one set from the start. Small sets enumerate all their subsets of the size that a link needs, and link where one
is shared. Large sets scan inverted lists: in one order for all, rarest first, two linked sets share one of their first
|A| - ceil(0.75 |A|) + 1 shingles, so only those are listed. The boundary between small and large is where the rows of both
together are least, by the counts of sets of each size. How often a shingle occurs is read from a table of 2**20 counters over all
documents; it decides the order only, so its rounding costs time, never a link.

Sets that share a list are not paired all with all. In rounds, all members of a list meet one member of it (the hub), and what links
becomes one component. Then members of different components that may still link by size and position are paired, all of them.
So components are exact, and a group of copies of any size costs its members, not their square. Pairs whose lists share too
little are ruled out first; only of the rest are the texts read again and the whole sets compared.

Lists of shingles that occur very often are spread over their members instead of going to one task, and a task lists a set that it
has just listed only once, so copies of one text fill no list. Links, tried pairs, components and sets stay tables in the shared
folder, to which each round adds its part; components are contracted, so a round handles its new links only.

Pairing the rest in full costs the pairs of components that share a list and may link by size and position. With members that never
link, that is the square of a list's length: the hubs find nothing to join, and all pairs have to be looked at to know so. Rows without id link with nothing and have no component. Repeated rows, NULL and empty texts:
a copy links with its twin, a document without words with nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.components import components
from tallyhouse.llm.rounds import release
from tallyhouse.llm.small import join_small
from tallyhouse.llm.text import LOWER, SPACE, distinct_per_row, hash_spans, mix, row_blocks, rows_of, spans, sum_rows, utf8
from tallyhouse.session import scratch, settle

WORDS = 5
COUNTERS = 20
_CHUNK = 4096
_ODD = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)
RECENT = 16
# Largest size for which subsets are thought of.
MOST_SMALL = 12
# Sets that a task remembers having listed.
REMEMBERED = 1 << 18


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and where each row's begin."""
    low = LOWER[data]
    starts, ends, bounds = spans(low, offsets, SPACE)
    words = hash_spans(low, starts, ends)
    held = np.diff(bounds)
    full = np.maximum(held - WORDS + 1, 0)
    count = np.where(held >= WORDS, full, np.minimum(held, 1))
    at = np.concatenate(([0], np.cumsum(count)))
    out = np.zeros(int(at[-1]), np.uint64)
    if len(words) >= WORDS:
        rolling = sum((words[k : len(words) - WORDS + 1 + k] * _ODD[k] for k in range(1, WORDS)), words[: len(words) - WORDS + 1] * _ODD[0])
        place = np.repeat(bounds[:-1] - np.cumsum(full) + full, full) + np.arange(int(full.sum()))
        out[np.repeat(held >= WORDS, count)] = mix(rolling[place])
    for k in np.flatnonzero((held > 0) & (held < WORDS)).tolist():
        few = words[bounds[k] : bounds[k + 1]]
        out[at[k]] = mix((few * _ODD[: len(few)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(few)))[0]
    return distinct_per_row(at, out)


def set_ids(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each row's set and size."""
    total = np.zeros(len(bounds) - 1, np.uint64)
    held = np.flatnonzero(np.diff(bounds))
    if len(held):
        total[held] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), bounds[:-1][held])
    return mix(total + np.diff(bounds).astype(np.uint64)).view(np.int64)


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(batch.column(column))
    for lo, hi in row_blocks(offsets):
        yield lo, hi, *shingle_sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def count_pass(docs: DataFrame) -> DataFrame:
    """A row (id, set, size) for each document, and from each task its counters in chunks: (chunk, part, counts)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << COUNTERS, np.uint32)
        part = TaskContext.get().partitionId() % 64
        names = ["id", "set", "size", "chunk", "part", "counts"]
        for batch in batches:
            for lo, hi, values, bounds in _blocks(batch, 1):
                counters += np.bincount((values >> np.uint64(64 - COUNTERS)).astype(np.int64), minlength=len(counters)).astype(np.uint32)
                n = hi - lo
                columns = [batch.column(0).slice(lo, n), pa.array(set_ids(values, bounds)), pa.array(np.diff(bounds)), *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names)
        full = [k for k in range(0, len(counters), _CHUNK) if counters[k : k + _CHUNK].any()]
        columns = [*(pa.nulls(len(full), pa.int64()) for _ in range(3)), pa.array([k // _CHUNK for k in full], pa.int32()), pa.array([part] * len(full), pa.int32()), pa.array([counters[k : k + _CHUNK].tobytes() for k in full], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, "id long, set long, size long, chunk int, part int, counts binary")


def collect_counters(counted: DataFrame) -> np.ndarray:
    """The counters of all tasks added up, in two steps; 2**20 numbers come to the driver."""

    def added(group: pa.Table) -> pa.Table:
        total = np.zeros(_CHUNK, np.uint64)
        for piece in group["counts"].to_pylist():
            own = np.frombuffer(piece, np.uint32 if len(piece) == 4 * _CHUNK else np.uint64)
            total += own
        return pa.table({"chunk": pa.array([group["chunk"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    rows = counted.where("chunk IS NOT NULL").select("chunk", "part", "counts")
    once = rows.groupBy("chunk", "part").applyInArrow(added, "chunk int, counts binary")
    twice = once.groupBy("chunk").applyInArrow(added, "chunk int, counts binary")
    out = np.zeros(1 << COUNTERS, np.uint64)
    for r in twice.collect():
        out[r.chunk * _CHUNK : (r.chunk + 1) * _CHUNK] = np.frombuffer(r.counts, np.uint64)
    return out


def needed(size: int) -> int:
    """Shingles that a set of this size shares at least with any set that is not larger and links with it: ceil(0.75 size)."""
    return -(-3 * size // 4)


def subset_sizes(size: int, boundary: int) -> list[int]:
    """Sizes of the subsets that a small set enumerates, for every possible size of the larger set of a link."""
    return sorted({needed(t) for t in range(size, min(boundary, 4 * size // 3) + 1)})


def choose_boundary(sets_of_size: dict[int, int], row_cost: float = 2.0) -> int:
    """The boundary with the fewest rows; a row of an inverted list also costs its share of a later scan (`row_cost`)."""

    def cost(boundary: int) -> float:
        total = 0.0
        for size, n in sets_of_size.items():
            if size <= boundary:
                total += n * sum(comb(size, c) for c in subset_sizes(size, boundary))
            if 4 * size // 3 > boundary:
                total += row_cost * n * (size - needed(size) + 1)
        return total

    return min(range(MOST_SMALL + 1), key=cost)


def bands(most: int) -> np.ndarray:
    """First sizes of the bands; sizes that can link lie in the same or the next band."""
    out = [1]
    while out[-1] <= most:
        out.append(4 * out[-1] // 3 + 1)
    return np.array(out)


def posting_pass(docs: DataFrame, counters: np.ndarray, boundary: int, heavy: int) -> tuple[DataFrame, Broadcast]:
    """Rows (deal, key, set, size, band, place) of all subsets and lists, place is -1 in a subset; and what the tasks share.

    `deal` is 0, or the set for a shingle that occurs `heavy` times or more, so that its list is spread.
    """
    # Of fixed size: 2**20 counters, cut to 32 bits for the order.
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counters, 2**32 - 1).astype(np.uint32))
    edges = bands(1 << 40)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, listed_here = shared.value, set()
        for batch in batches:
            for _, _, values, bounds in _blocks(batch, 0):
                own = set_ids(values, bounds)
                # A set listed by this task already has nothing to add; what is forgotten is listed again, which changes nothing.
                fresh = np.ones(len(own), bool)
                for k, name in enumerate(own.tolist()):
                    fresh[k] = name not in listed_here
                    listed_here.add(name)
                if len(listed_here) > REMEMBERED:
                    listed_here = set()
                sizes = np.where(fresh, np.diff(bounds), 0)
                often = table[(values >> np.uint64(64 - COUNTERS)).astype(np.int64)].astype(np.uint64)
                # Rarest first; the hash, of which 32 bits decide here, breaks ties alike everywhere.
                order = often << np.uint64(32) | (values & np.uint64(2**32 - 1))
                listed = np.where((sizes > 0) & (4 * sizes // 3 > boundary), sizes - -(-3 * sizes // 4) + 1, 0)
                picked = np.empty(int(listed.sum()), np.int64)
                done = 0
                for k in np.flatnonzero(listed).tolist():
                    lo, n = bounds[k], int(listed[k])
                    picked[done : done + n] = lo + np.argsort(order[lo : bounds[k + 1]])[:n]
                    done += n
                row = np.repeat(np.arange(len(sizes)), listed)
                keys, sets = values[picked].view(np.int64), own[row]
                deal = np.where(often[picked] >= np.uint64(heavy), sets, 0)
                place = np.arange(len(row)) - np.repeat(np.cumsum(listed) - listed, listed)
                small = [
                    (k, c, subset)
                    for k in np.flatnonzero((sizes > 0) & (sizes <= boundary)).tolist()
                    for c in subset_sizes(int(sizes[k]), boundary)
                    for subset in combinations(range(bounds[k], bounds[k + 1]), c)
                ]
                if small:
                    sub = np.array([s[0] for s in small])
                    sums = np.array([mix(values[list(s)] + np.uint64(c)).sum(dtype=np.uint64) for _, c, s in small], np.uint64)
                    keys, sets = np.concatenate((keys, mix(sums).view(np.int64))), np.concatenate((sets, own[sub]))
                    deal, place = np.concatenate((deal, np.zeros(len(sub), np.int64))), np.concatenate((place, np.full(len(sub), -1)))
                    row = np.concatenate((row, sub))
                band = np.searchsorted(edges, sizes, "right")[row]
                columns = [deal, keys, sets, sizes[row].astype(np.int32), band.astype(np.int32), place.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["deal", "key", "set", "size", "band", "place"])

    return docs.select("text").mapInArrow(run, "deal long, key long, set long, size int, band int, place int"), shared


def shared_lists(postings: DataFrame) -> DataFrame:
    """The rows whose key stands in two sets or more, a row for each set, with `n`, the number of sets.

    A key of exactly two sets is one row: the first set, and the other one as `other`. Lists that are spread count as long.
    """
    keyed = Window.partitionBy("deal", "key")
    first = F.coalesce(F.lag("set").over(keyed.orderBy("set")) != F.col("set"), F.lit(True))
    member = F.struct("set", "size", "band", "place")
    rows = postings.withColumn("first", first).withColumn("n", F.sum(F.col("first").cast("int")).over(keyed)).withColumn("other", F.max(member).over(keyed))
    rows = rows.withColumn("n", F.when(F.col("deal") != 0, F.lit(3)).otherwise(F.col("n").cast("int")))
    return rows.where("first AND (n > 2 OR n = 2 AND set <> other.set)").select("key", "set", "size", "band", "place", "n", F.when(F.col("n") == 2, F.col("other")).alias("other"))


def _bits(id: str, bits: int) -> list:
    return [F.pmod(F.xxhash64(id, F.lit(k)), F.lit(bits)) for k in range(2)]


def id_filter(wanted: DataFrame) -> tuple[np.ndarray, int]:
    """Bits set for the wanted ids, at most 2**26 (8 MB), which come to the driver.

    An id that isn't wanted passes rarely; above some million ids it passes more often, which costs work, no result.
    """
    bits = min(1 << 26, max(1 << 12, 1 << (16 * wanted.count()).bit_length()))
    places = wanted.select(F.explode(F.array(*_bits("id", bits))).alias("bit"))
    words = places.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 AS int))")).alias("set"))
    out = np.zeros(bits // 64, np.int64)
    held = words.toArrow()
    out[held["word"].to_numpy()] = held["set"].to_numpy()
    return out, bits


def load_sets(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, Broadcast]:
    """`set` and its `shingles`, of the documents whose ids are in `wanted`, and now and then of another; and what the tasks share.

    The texts stay where they are read: a filter of bounded size goes to them instead.
    """
    table, bits = id_filter(wanted)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            passes = np.ones(batch.num_rows, bool)
            for column in (1, 2):
                bit = batch.column(column).to_numpy()
                passes &= shared.value[bit // 64] >> (bit % 64) & 1 == 1
            for _, _, values, bounds in _blocks(batch.filter(pa.array(passes)), 0):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(set_ids(values, bounds)), lists], ["set", "shingles"])

    return docs.select("text", *_bits("id", bits)).mapInArrow(run, "set long, shingles array<long>").dropDuplicates(["set"]), shared


# Sizes s <= t link only if 3 t <= 4 s; from the first shared shingle on, either set has at most what follows it.
_FITS = "4 * least({x}.size, {y}.size) >= 3 * greatest({x}.size, {y}.size) AND ({x}.place < 0 OR 7 * least({x}.size - {x}.place, {y}.size - {y}.place) >= 3 * ({x}.size + {y}.size))"


def _pairs(found: DataFrame, x: str, y: str) -> DataFrame:
    """(a, b, total, most, subset): sets that may link, their sizes' sum and maximum, and if they share a subset."""
    columns = [F.least(f"{x}.set", f"{y}.set").alias("a"), F.greatest(f"{x}.set", f"{y}.set").alias("b")]
    columns += [(F.col(f"{x}.size") + F.col(f"{y}.size")).alias("total"), F.greatest(f"{x}.size", f"{y}.size").alias("most"), (F.col(f"{x}.place") < 0).alias("subset")]
    chosen = found.where(F.expr(_FITS.format(x=x, y=y))).where(f"{x}.set <> {y}.set")
    return chosen.select(*columns).groupBy("a", "b", "total", "most").agg(F.max("subset").alias("subset"))


def two_set_pairs(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From the keys of exactly two sets: pairs that may link, and how many such keys any two sets share."""
    twos = lists.where("n = 2").select(F.struct("set", "size", "place").alias("m"), F.col("other").alias("h"))
    shared = twos.where("m.place >= 0").groupBy(F.col("m.set").alias("a"), F.col("h.set").alias("b")).agg(F.count("*").alias("twos"))
    return _pairs(twos, "m", "h"), shared


def promising(pairs: DataFrame, twos: DataFrame, long: DataFrame) -> DataFrame:
    """The pairs whose lists share enough; `twos` and `long` are the shared keys of two sets and of more.

    Of the set whose list ends first in the common order, what is listed and not shared is not in the other set. So the overlap
    is at most ceil(0.75 s) - 1 unlisted shingles, for the larger s, and the shared listed ones.
    """
    listed = long.where("place >= 0").select("set", "key")
    mine = pairs.select("a", "b").join(listed.withColumnRenamed("set", "a"), "a")
    more = mine.join(listed.withColumnRenamed("set", "b"), ["b", "key"]).groupBy("a", "b").agg(F.count("*").alias("more"))
    counted = pairs.join(twos, ["a", "b"], "left").join(more, ["a", "b"], "left").withColumn("shared", F.coalesce("twos", F.lit(0)) + F.coalesce("more", F.lit(0)))
    return counted.where("subset OR 7 * ((3 * most + 3) div 4 - 1 + shared) >= 3 * total").select("a", "b")


def hub_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """Every member of a list with one member of the same and of the next lower band, where they may link and are not one component yet."""
    # First the member in which the shared shingle stands foremost: an original has no shingles of its own before it, as its edited
    # copies have, so that it is the centre of its group. In later turns another by a hash. Reduced per task before the shuffle.
    luck = F.xxhash64("set", F.lit(turn))
    pick = F.min(F.struct((F.col("place") if turn == 0 else luck).alias("first"), luck.alias("luck"), "set", "size", "place", "component")).alias("hub")
    hubs = lists.groupBy("key", "band").agg(pick).select("key", "band", "hub.set", "hub.size", "hub.place", "hub.component")
    reach = hubs.union(hubs.withColumn("band", F.col("band") + 1))
    met = lists.alias("m").join(reach.alias("h"), F.expr("m.key = h.key AND m.band = h.band AND m.component <> h.component"))
    return _pairs(met, "m", "h")


def rest_pairs(lists: DataFrame) -> DataFrame:
    """All pairs of members of a list that are in different components and may link."""
    # Two sets that share many keys need to meet once only: not where they also share one of the `RECENT` keys just before.
    recent = Window.partitionBy("set").orderBy("place", "key").rowsBetween(-RECENT, -1)
    seen = lists.withColumn("before", F.collect_list("key").over(recent))
    # Of each component in a list, what its best member could reach; pairs of components that can't link are never laid out.
    best = [F.min("size").alias("small"), F.max("size").alias("large"), F.max(F.col("size") - F.col("place")).alias("reach"), F.min("place").alias("place"), F.count("*").alias("n")]
    alone = F.when(F.count("*") == 1, F.min("before")).otherwise(F.array().cast("array<bigint>"))
    groups = seen.groupBy("key", "component").agg(*best, alone.alias("before"))
    may = "4 * p.large >= 3 * q.small AND 4 * q.large >= 3 * p.small AND (p.place < 0 OR 7 * least(p.reach, q.reach) >= 3 * (p.small + q.small)) AND NOT arrays_overlap(p.before, q.before)"
    # The component with fewer members there comes first, so that a single one is not repeated for each member of a large one.
    fewer = "(p.n < q.n OR p.n = q.n AND p.component < q.component)"
    apart = groups.alias("p").join(groups.alias("q"), F.expr(f"p.key = q.key AND {fewer} AND {may}"))
    apart = apart.select("p.key", F.col("p.component").alias("first"), F.col("q.component").alias("second"))
    member = F.struct("set", "size", "place", "before")
    left = apart.join(seen.select("key", F.col("component").alias("first"), member.alias("m")), ["key", "first"])
    both = left.join(seen.select("key", F.col("component").alias("second"), member.alias("h")), ["key", "second"])
    return _pairs(both.where("NOT arrays_overlap(m.before, h.before)"), "m", "h")


def verified(left: DataFrame, docs: DataFrame, first_of: DataFrame) -> DataFrame:
    """The pairs that link, by their whole sets, which are made again from one document of each."""
    needed = left.select(F.col("a").alias("set")).union(left.select("b")).distinct()
    made, shared = load_sets(docs, settle(first_of.join(needed, "set").select(F.col("first").alias("id")), "jaccard-wanted"))
    sets = settle(made, "jaccard-sets")
    shared.destroy()
    first, second = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")), sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    both = left.join(first, "a").join(second, "b").withColumn("shared", F.size(F.array_intersect("x", "y")))
    return both.where("100 * shared >= 75 * (size(x) + size(y) - shared)").select("a", "b")


class Found:
    """Tried pairs and components so far, as tables that every round adds to."""

    PAIR = "a long, b long"

    def __init__(self, spark: SparkSession):
        self.spark, self.tried, self.rounds = spark, scratch(spark, "jaccard-tried"), 0
        # `node` and `component` of every set that links; a component is one of its sets, which is no node.
        self.labels: DataFrame | None = None

    def new(self, pairs: DataFrame) -> DataFrame:
        """The pairs that no earlier round has tried; this round now has."""
        if self.rounds:
            pairs = pairs.join(self.spark.read.schema(self.PAIR).parquet(f"{self.tried}/*"), ["a", "b"], "left_anti")
        own = f"{self.tried}/round{self.rounds}"
        pairs.write.parquet(own)
        self.rounds += 1
        return self.spark.read.schema(self.PAIR).parquet(own)

    def link(self, links: DataFrame) -> None:
        """Join the components that new links connect."""
        if self.labels is None:
            self.labels = components(links)
            return
        ends = links
        for end in ("a", "b"):
            named = self.labels.select(F.col("node").alias(end), F.col("component").alias("of"))
            ends = ends.join(named, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
        moved = components(ends)
        to = moved.select(F.col("node").alias("component"), F.col("component").alias("to"))
        kept = self.labels.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        self.labels = settle(kept.unionByName(moved), "jaccard-labels")

    def name(self, lists: DataFrame) -> DataFrame:
        """The lists with the component of each set."""
        named = lists.drop("component").join(self.labels.select(F.col("node").alias("set"), "component"), "set", "left")
        return settle(named.withColumn("component", F.coalesce("component", "set")), "jaccard-named")


def _left_to_pair(lists: DataFrame) -> int:
    """How often two components meet in a list."""
    held = lists.select("key", "component").distinct().groupBy("key").agg(F.count("*").alias("n"))
    return held.agg(F.sum(F.expr("n * (n - 1) div 2"))).first()[0] or 0


def join(df: DataFrame, text: str = "text", id: str = "doc_id", turns: int = 8) -> DataFrame:
    """`id`, `n_shingles` and `component_id` (the least id reachable by links, its own included) of every row.

    `turns`: rounds with hubs at most before the rest is paired in full. Any number gives the same result.
    """
    docs = df.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counted = settle(count_pass(docs), "jaccard-counts")
    rows = counted.where("chunk IS NULL").select("id", F.col("set"), "size")
    counters = collect_counters(counted)
    sizes = {int(r["size"]): int(r["n"]) for r in rows.where(f"size BETWEEN 1 AND {2 * MOST_SMALL}").groupBy("size").agg(F.count("*").alias("n")).collect()}
    boundary = choose_boundary(sizes)
    heavy = max(256, int(4 * counters.mean()))
    known = docs.where("id IS NOT NULL")
    first_of = settle(rows.where("size > 0 AND id IS NOT NULL").groupBy("set").agg(F.min("id").alias("first")), "jaccard-first")

    postings, shared = posting_pass(known, counters, boundary, heavy)
    lists = settle(shared_lists(postings), "jaccard-lists")
    shared.destroy()
    long = lists.where("n > 2").select("key", "set", "size", "band", "place")
    pairs, twos = two_set_pairs(lists)
    twos = settle(twos, "jaccard-twos")
    # Keys of two sets are settled by their one pair; only the longer lists need turns.
    current, found = long.withColumn("component", F.col("set")), Found(df.sparkSession)

    def link(met: DataFrame) -> int:
        """Verify the pairs that are new, and take up what links."""
        fresh = settle(verified(found.new(promising(met, twos, long)), known, first_of), "jaccard-links")
        n = fresh.count()
        if n:
            found.link(fresh)
        release(df.sparkSession)
        return n

    rows_listed, members = long.count(), long.select("set").distinct().count()
    for turn in range(turns):
        met = hub_pairs(current, turn)
        if turn == 0:
            met = met.unionByName(pairs).groupBy("a", "b", "total", "most").agg(F.max("subset").alias("subset"))
        new = link(met)
        if new:
            current = found.name(current)
        # Another hub helps a group whose members link widely; where little is left or it links few, the rest is paired at once.
        if turn and 20 * new < members or _left_to_pair(current) <= 4 * rows_listed:
            break
    link(rest_pairs(current) if turns else rest_pairs(current).unionByName(pairs))
    return _named(rows, first_of, found.labels, id)


def _named(rows: DataFrame, first_of: DataFrame, found: DataFrame | None, id: str) -> DataFrame:
    named = first_of if found is None else first_of.join(found.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    if found is None:
        least = named.select("set", F.col("first").alias("component_id"))
    else:
        by_component = named.groupBy("component").agg(F.min("first").alias("component_id"))
        least = named.join(by_component, "component").select("set", "component_id")
    out = rows.withColumn("set", F.when(F.col("size") > 0, F.col("set"))).join(least, "set", "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id), F.col("size").alias("n_shingles"), own.alias("component_id"))


def deduplicate(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`df` with one document of each component, the one of least id; rows without id stay. Of rows that repeat an id with the
    same text, one stays; with different texts each is a document of its own."""
    # Ids are unique in most tables; only where they aren't do the texts tell rows apart.
    if df.where(F.col(id).isNotNull()).groupBy(id).count().where("count > 1").isEmpty():
        found = settle(join(df, text, id), "jaccard-components")
        others = settle(found.where(F.col("component_id") != F.col(id)).select(id).distinct(), "jaccard-copies")
        return join_small(df, others, id, "left_anti").select(*df.columns)
    # The row goes along as one column, so no name can clash.
    keyed = df.select(F.struct("*").alias("row"), F.when(F.col(id).isNotNull(), F.xxhash64(id, text)).alias("own_key"))
    one = keyed.where("own_key IS NOT NULL").dropDuplicates(["own_key"]).select("own_key", F.col("row").getField(id).alias("own_id"), F.col("row").getField(text).alias("own_text"))
    named = one.select("own_key", F.struct(F.col("own_id").alias("id"), F.col("own_key").alias("key")).alias("rank"))
    found = settle(join(one, "own_text", "own_key").join(named, "own_key"), "jaccard-components")
    # Of each component the row of least id, and of least hash where it repeats the id.
    least = found.groupBy("component_id").agg(F.min("rank").alias("least"))
    others = settle(found.join(least, "component_id").where("rank <> least").select("own_key"), "jaccard-copies")
    out = join_small(keyed, others, "own_key", "left_anti")
    return out.where("own_key IS NULL").unionByName(out.where("own_key IS NOT NULL").dropDuplicates(["own_key"])).select("row.*")
