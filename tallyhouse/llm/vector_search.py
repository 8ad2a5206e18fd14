"""Exact top-k search by integer inner product: a ball tree for each shard, searched by branch and bound.

Components are turned into floor(256 x). The vectors are dealt to the nearest of at most `MAX_PARTS` centres, which are fitted on a
sample of at most `SAMPLE` rows and decide only where a vector lies. A part larger than `SHARD` rows is split by hash, so a shard
has about `SHARD` rows at most however the vectors are spread. Each shard is one row of a stored table: its vectors in the order
of a balanced ball tree, and centre and radius of every node.

The queries are met in waves of bounded size, each broadcast to the shards. First every query searches its own part only; the k-th
score found there is shared with all tasks. Then all shards are searched: a node whose bound q.c + |q| r lies below the shared or the
task's own k-th score is left out with all below it, and leaves are visited from the highest bound down. Bounds are rounded
up, so the result is exact: nothing is left out that could be in it.

Rows that repeat id and vector are one entry with a count; as a query each gives its own rows, as a candidate each counts. A
vector that is NULL or holds a NULL or non-finite component takes no part. A NULL id is no query, and comes last among ties. Where
vectors differ in length, missing components count as 0. Components and scores beyond 64 bits stop at its limits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.best import Best
from tallyhouse.session import scratch, settle

SHARD = 2048
LEAF = 64
MAX_PARTS = 1024
# Rows of the sample, and its bytes at most.
SAMPLE = 8192
SAMPLE_BYTES = 32 << 20
# Bytes of the queries of a wave, at 8 for a component.
WAVE_BYTES = 16 << 20
_FOUND = "query int, query_id long, copies long, score long, vec_id long"
_TOP = np.iinfo(np.int64).max


def quantise(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that take part, the components of all of them, and where each one's begin."""
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    at = np.concatenate(([0], np.cumsum(length)))
    wrong = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    fit = np.asarray(column.is_valid()) & (wrong[at[1:]] == wrong[at[:-1]])
    with np.errstate(over="ignore"):
        # The largest double below 2**63.
        whole = np.clip(np.floor(256 * flat[np.repeat(fit, length)]), -(2.0**63 - 1024), 2.0**63 - 1024).astype(np.int64)
    return np.flatnonzero(fit), whole, np.concatenate(([0], np.cumsum(length[fit])))


def matrix(values: np.ndarray, bounds: np.ndarray, width: int) -> np.ndarray:
    """Rows of `width` components, cut or filled up with 0."""
    length = np.diff(bounds)
    if (length == width).all():
        return values.reshape(len(length), width)
    out = np.zeros((len(length), width), values.dtype)
    row = np.repeat(np.arange(len(length)), length)
    col = np.arange(len(values)) - bounds[row]
    inside = col < width
    out[row[inside], col[inside]] = values[inside]
    return out


def unpack(packed: list[bytes], width: int | None = None) -> np.ndarray:
    """The vectors of packed rows, as wide as the widest unless told."""
    length = np.array([len(p) // 8 for p in packed], np.int64)
    return matrix(np.frombuffer(b"".join(packed), np.int64), np.concatenate(([0], np.cumsum(length))), int(length.max(initial=0)) if width is None else width)


def _along(points: np.ndarray) -> np.ndarray:
    """The order of points along the line through two that lie far apart."""
    middle = points.mean(axis=0)
    first = points[np.argmax(((points - middle) ** 2).sum(axis=1))]
    second = points[np.argmax(((points - first) ** 2).sum(axis=1))]
    return np.argsort(points @ (second - first), kind="stable")


def centres(points: np.ndarray, n: int) -> np.ndarray:
    """Means of `n` groups of about equal size, from splits between far points."""
    if n <= 1 or len(points) <= 1:
        return points.mean(axis=0, keepdims=True)
    ordered = points[_along(points)]
    cut = max(1, len(points) * (n // 2) // n)
    return np.concatenate((centres(ordered[:cut], n // 2), centres(ordered[cut:], n - n // 2)))


def depth(n: int) -> int:
    """Levels below the root of a tree over n vectors."""
    levels = 0
    while n > LEAF << levels:
        levels += 1
    return levels


def edges(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin and the last one ends."""
    out = np.array([0, n])
    for _ in range(level):
        out = np.insert(out, np.arange(1, len(out)), (out[:-1] + out[1:]) // 2)
    return out


def ball_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the vectors, and centre and radius of each node, level by level."""
    order, middles, radii = np.arange(len(points)), [], []
    real = points.astype(np.float64)
    for level in range(depth(len(points)) + 1):
        at = edges(len(points), level)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own = real[order[lo:hi]]
            middle = own.mean(axis=0)
            middles.append(middle)
            radii.append(np.sqrt(((own - middle) ** 2).sum(axis=1).max()))
            if level < depth(len(points)):
                order[lo:hi] = order[lo:hi][_along(own)]
    return order, np.array(middles).reshape(len(middles), points.shape[1]), np.array(radii)


def _narrow(values: np.ndarray) -> np.ndarray:
    """In the smallest integer type that holds them."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


class Shard:
    """One stored shard: vectors in tree order, ids, counts, and the nodes."""

    schema = "part int, n int, dim int, width int, ids binary, known binary, copies binary, vectors binary, centres binary, radii binary"

    @staticmethod
    def build(group: pa.Table, k: int) -> pa.Table:
        points = unpack(group["vec"].to_pylist())
        order, middles, radii = ball_tree(points)
        ids = group["id"].combine_chunks()
        known = np.asarray(ids.is_valid())
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        # More copies of a candidate than results, and one for the query itself, change nothing.
        copies = np.minimum(group["copies"].to_numpy(), k + 1).astype(np.int64)
        packed = _narrow(points[order])
        columns = [[group["part"][0].as_py()], [len(points)], [points.shape[1]], [packed.itemsize]]
        data = [[x.tobytes()] for x in (ids[order], known[order], copies[order], packed, middles, radii)]
        names = [c.split()[0] for c in Shard.schema.split(", ")]
        return pa.table(dict(zip(names, [*(pa.array(c, pa.int32()) for c in columns), *(pa.array(d, pa.binary()) for d in data)], strict=True)))

    def __init__(self, row: dict, dim: int):
        n, own = row["n"], row["dim"]
        self.part, self.n = row["part"], n
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[row["width"]]
        self.vectors = _fit(np.frombuffer(row["vectors"], kind).reshape(n, own).astype(np.int64), dim)
        self.ids, self.known, self.copies = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool), np.frombuffer(row["copies"], np.int64)
        self.radii = np.frombuffer(row["radii"], np.float64)
        self.centres = _fit(np.frombuffer(row["centres"], np.float64).reshape(len(self.radii), own), dim)


def _fit(rows: np.ndarray, dim: int) -> np.ndarray:
    if rows.shape[1] >= dim:
        return rows[:, :dim]
    return np.pad(rows, ((0, 0), (0, dim - rows.shape[1])))


class Wave:
    """The queries of a wave: ids, vectors, counts, the part each lies in, and the shared k-th scores."""

    def __init__(self, rows: list):
        self.ids = np.array([r.id for r in rows], np.int64)
        self.copies = np.array([r.copies for r in rows], np.int64)
        self.parts = np.array([r.part for r in rows], np.int32)
        self.vectors = unpack([bytes(r.vec) for r in rows])
        self.real = self.vectors.astype(np.float64)
        self.norms = np.sqrt((self.real**2).sum(axis=1))
        self.kth: np.ndarray | None = None


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; beyond 64 bits the nearest number inside."""
    most = float(np.abs(left.astype(np.float64)).max(initial=0)) * float(np.abs(right.astype(np.float64)).max(initial=0)) * left.shape[1]
    if most < 2.0**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    exact = left.astype(object) @ right.T.astype(object)
    return np.clip(exact, -_TOP, _TOP).astype(np.int64) if left.shape[1] else np.zeros(exact.shape, np.int64)


def bounds_of(wave: Wave, queries: np.ndarray, shard: Shard, lo: int, hi: int) -> np.ndarray:
    """What an inner product of each query with a vector of the nodes can't exceed."""
    near = wave.real[queries] @ shard.centres[lo:hi].T
    far = wave.norms[queries][:, None] * shard.radii[lo:hi]
    return near + far + 1e-9 * (np.abs(near) + far + wave.norms[queries][:, None] * np.sqrt((shard.centres[lo:hi] ** 2).sum(axis=1))) + 1e-6


def search_shard(wave: Wave, queries: np.ndarray, shard: Shard, best: Best) -> int:
    """Branch and bound of many queries in one shard; returns how many vectors were looked at."""
    alive = np.ones((len(queries), 1), bool)
    for level in range(depth(shard.n) + 1):
        first = (1 << level) - 1
        bound = bounds_of(wave, queries, shard, first, 2 * first + 1)
        alive = (np.repeat(alive, 2, axis=1) if level else alive) & (bound >= best.kth[queries][:, None])
        some = alive.any(axis=1)
        queries, alive, bound = queries[some], alive[some], bound[some]
        if not len(queries):
            return 0
    at, seen = edges(shard.n, depth(shard.n)), 0
    bound = np.where(alive, bound, -np.inf)
    ranked = np.argsort(-bound, axis=1, kind="stable")
    for turn in range(ranked.shape[1]):
        leaf = ranked[:, turn]
        reach = np.take_along_axis(bound, leaf[:, None], axis=1)[:, 0]
        # Bounds fall from turn to turn and k-th scores rise, so a query that is out stays out.
        open_ = np.flatnonzero((reach > -np.inf) & (reach >= best.kth[queries]))
        if not len(open_):
            break
        open_ = open_[np.argsort(leaf[open_], kind="stable")]
        starts = np.flatnonzero(np.r_[True, leaf[open_][1:] != leaf[open_][:-1]])
        for group in np.split(open_, starts[1:]):
            lo, hi = at[leaf[group[0]]], at[leaf[group[0]] + 1]
            own = queries[group]
            score = products(wave.vectors[own], shard.vectors[lo:hi])
            seen += score.size
            row, col = np.nonzero(score >= best.kth[own][:, None])
            query, place = own[row], lo + col
            same = shard.known[place] & (shard.ids[place] == wave.ids[query])
            same[same] = (shard.vectors[place[same]] == wave.vectors[query[same]]).all(axis=1)
            times = np.minimum(shard.copies[place] - same, best.k)
            query, place, value = np.repeat(query, times), np.repeat(place, times), np.repeat(score[row, col], times)
            best.offer(query, value, shard.ids[place], shard.known[place])
    return seen


def search_wave(shards: DataFrame, wave: Wave, k: int, dim: int, own_part: bool) -> tuple[DataFrame, object]:
    """The `k` best of every task for each query; with `own_part` from the part alone in which the query lies."""
    shared = shards.sparkSession.sparkContext.broadcast(wave)  # at most WAVE_BYTES and a few numbers a query

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wave = shared.value
        best = Best(len(wave.ids), k, wave.kth)
        for batch in batches:
            for row in range(batch.num_rows):
                shard = Shard({name: batch.column(name)[row].as_py() for name in batch.schema.names}, dim)
                queries = np.flatnonzero(wave.parts == shard.part) if own_part else np.arange(len(wave.ids))
                if len(queries):
                    search_shard(wave, queries, shard, best)
        query, score, id, known = best.held()
        columns = [pa.array(query.astype(np.int32)), pa.array(wave.ids[query]), pa.array(wave.copies[query]), pa.array(score), pa.array(id, mask=~known)]
        yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "copies", "score", "vec_id"])

    return shards.mapInArrow(run, _FOUND), shared


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def index(df: DataFrame, k: int, id: str, vector: str) -> tuple[DataFrame, DataFrame, int] | None:
    """(entries, shards, dimension), both stored; None where no vector takes part. `k` bounds the counts that shards keep."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    total, dim = rows.where("vec IS NOT NULL").agg(F.count("*"), F.max(F.size("vec"))).first()
    if not total:
        return None
    bounded = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * max(dim, 1))))
    drawn = rows.where("vec IS NOT NULL").orderBy(F.xxhash64("id", "vec")).limit(bounded).select("vec").toArrow()["vec"].combine_chunks()
    _, values, at = quantise(drawn)
    if len(at) == 1:  # nothing in the sample takes part, or nothing at all
        values, at = np.zeros(dim, np.int64), np.array([0, dim])
    points = matrix(values, at, dim).astype(np.float64)
    middles = centres(points, min(MAX_PARTS, -(-total // SHARD), max(1, len(points) // 4)))
    weight = (middles**2).sum(axis=1)

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit, values, at = quantise(batch.column(1))
            near = np.argmin(weight - 2 * (matrix(values, at, dim).astype(np.float64) @ middles.T), axis=1)
            packed = [values[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [pa.array(near.astype(np.int32)), batch.column(0).take(pa.array(fit)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["part", "id", "vec"])

    # Copies of a row are counted per task before the shuffle.
    entries = settle(rows.mapInArrow(dealt, "part int, id long, vec binary").groupBy("part", "id", "vec").agg(F.count("*").alias("copies")), "vector-entries")
    pieces = entries.groupBy("part").agg(F.ceil(F.count("*") / SHARD).alias("pieces"))
    split = entries.join(F.broadcast(pieces), "part")  # at most MAX_PARTS rows
    split = split.withColumn("piece", F.pmod(F.xxhash64("id", "vec"), F.col("pieces"))).select("part", "piece", "id", "vec", "copies")
    shards = split.groupBy("part", "piece").applyInArrow(lambda group: Shard.build(group, k), Shard.schema)
    return entries, settle(shards, "vector-shards"), dim


def top_k(df: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the `k` highest inner products of each row for which `is_query` (a condition on the
    column `id`) holds, with every other row; fewer where there are fewer."""
    spark = df.sparkSession
    out = "query_id long, rank int, vec_id long, score long"
    built = index(df, k, id, vector)
    if built is None:
        return spark.createDataFrame([], out)
    entries, shards, dim = built
    asked = entries.where(F.col("id").isNotNull() & is_query)
    waves = -(-asked.count() * 8 * max(dim, 1) // wave_bytes)
    asked = asked.withColumn("wave", F.pmod(F.xxhash64("id", "vec"), F.lit(max(waves, 1))))
    path = scratch(spark, "vector-found")
    for number in range(waves):
        rows = asked.where(F.col("wave") == number).select("id", "part", "copies", "vec").collect()  # one wave
        if not rows:
            continue
        wave = Wave(rows)
        near, held = search_wave(shards, wave, k, wave.vectors.shape[1], own_part=True)
        wave.kth = np.full(len(rows), np.iinfo(np.int64).min)
        for r in _ranked(near, k).where(F.col("rank") == k).select("query", "score").collect():  # one row a query
            wave.kth[r["query"]] = r["score"]
        held.destroy()
        found, held = search_wave(shards, wave, k, wave.vectors.shape[1], own_part=False)
        each = F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
        _ranked(found, k).withColumn("copy", each).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        held.destroy()
    return spark.read.schema(out).parquet(path) if waves else spark.createDataFrame([], out)
