"""Document quality by Bradley-Terry pairwise ranking.

From labelled rows, pairs of a better and a worse document are drawn; logistic loss on the difference of their features makes
the better one's score the higher. Features are shares of characters by kind, word lengths, repeated words and lines, each cut
into bins at the training quantiles. The score becomes a threshold by quantile: at the score below which lies the same share of
training documents as are labelled 0, the result is 0.3.

It is fitted on every labelled row. Up to `on_driver` of them are collected and fitted there; more stay where they are: Spark counts
the quantiles, pairs the rows (each is in a pair) and adds up gradients and curvature of Newton's steps, and the driver only
gets numbers of fixed size. Scoring reads every text whole.
NULL counts as the empty text, which has a score like any other; equal texts have equal scores. Without any training row every
score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.learning import Adagrad, collect_features, natural_sample, sigmoid
from tallyhouse.llm.text import SPACE, distinct_packed, hash_spans, row_blocks, rows_of, spans, sum_rows, utf8
from tallyhouse.session import settle

BINS = 16
WINDOW = 40
CUT = 0.3

_KIND = np.full(256, 8)
for _k, _members in enumerate([range(97, 123), range(65, 91), range(48, 58), range(128, 256), b" ", b"\n\r\t", b".,;:'\"()-?", b"|"]):
    _KIND[list(_members)] = _k
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True


def _distinct_share(groups: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct values over all values of each group, 1 for none."""
    bits = 62 - max(1, int(n).bit_length())
    _, at = distinct_packed(groups, hashes >> np.uint64(64 - bits), bits, n)
    held = np.bincount(groups, minlength=n)
    return np.where(held, np.diff(at) / np.maximum(held, 1), 1.0)


def measures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = rows_of(offsets)
    kinds = np.bincount(row * 9 + _KIND[data], minlength=n * 9).reshape(n, 9) / np.maximum(size, 1)[:, None]
    marks = np.bincount(row, data == ord("!"), n) / np.maximum(size, 1)
    starts, ends, bounds = spans(data, offsets, SPACE)
    words = np.diff(bounds)
    hashes, owner = hash_spans(data, starts, ends), rows_of(bounds)
    length = sum_rows((ends - starts).astype(float), bounds) / np.maximum(words, 1)
    long = sum_rows((ends - starts > 20).astype(float), bounds) / np.maximum(words, 1)
    # Distinct words per window, so that long texts compare with short ones.
    inside = np.arange(len(starts)) - bounds[:-1][owner]
    windows = np.concatenate(([0], np.cumsum(-(-words // WINDOW))))
    window = windows[owner] + inside // WINDOW
    fresh = sum_rows(_distinct_share(window, hashes, int(windows[-1])), windows) / np.maximum(np.diff(windows), 1)
    again = np.bincount(owner[1:], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1]), n) / np.maximum(words, 1)
    l_starts, l_ends, l_bounds = spans(data, offsets, _NEWLINE)
    lines = _distinct_share(rows_of(l_bounds), hash_spans(data, l_starts, l_ends), n)
    line_words = words / np.maximum(np.diff(l_bounds), 1)
    return np.column_stack([kinds, marks, length, long, fresh, _distinct_share(owner, hashes, n), again, lines, line_words, np.log1p(words)])


def _as_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = measures(data, offsets)
    return np.tile(np.arange(x.shape[1]), len(x)), x.ravel(), np.arange(len(x) + 1) * x.shape[1]


@dataclass
class Model:
    # Per measure: upper edges of its bins, and the weight of each bin.
    edges: np.ndarray
    weights: np.ndarray
    shift: float


def _bins(edges: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.searchsorted(edges[k], x[:, k], "right") for k in range(x.shape[1])])


def raw_scores(model: Model, x: np.ndarray) -> np.ndarray:
    b = _bins(model.edges, x.astype(np.float32))
    return model.weights[np.arange(b.shape[1]), b].sum(1)


def fit(rows: list[tuple], pairs: int = 200_000, epochs: int = 3, batch: int = 500, rate: float = 0.1, ridge: float = 1e-4, seed: int = 7) -> Model | None:
    """From (label, _, measures): weights of the bins by the pairs' logistic loss."""
    if not rows:
        return None
    x, y = np.stack([r[2] for r in rows]), np.array([int(r[0]) for r in rows])
    edges = np.quantile(x, np.arange(1, BINS) / BINS, axis=0).T.astype(np.float32)
    model = Model(edges, np.zeros((x.shape[1], BINS)), 0.0)
    better, worse = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(better) or not len(worse):
        return model
    flat = _bins(edges, x) + np.arange(x.shape[1]) * BINS
    rng = np.random.default_rng(seed)
    weights = np.zeros(x.shape[1] * BINS)
    step = Adagrad(weights.shape, rate)
    for _ in range(epochs):
        a, b = rng.choice(better, pairs), rng.choice(worse, pairs)
        for lo in range(0, pairs, batch):
            up, down = flat[a[lo : lo + batch]], flat[b[lo : lo + batch]]
            pull = sigmoid(weights[down].sum(1) - weights[up].sum(1)) / len(up)
            each = np.repeat(pull, x.shape[1])
            gradient = np.bincount(down.ravel(), each, len(weights)) - np.bincount(up.ravel(), each, len(weights))
            step.step(weights, gradient + ridge * weights)
    model.weights = weights.reshape(-1, BINS)
    model.shift = float(np.quantile(raw_scores(model, x), len(worse) / len(y)))
    return model


# Rows of the more frequent label that are paired in one group, least rows of the other there, and pairs for each.
GROUP, FEWEST, TURNS = 4096, 64, 4
# Tasks that add up pairs; each sends the driver one row of some hundred thousand numbers.
ADDERS = 64
# Leading bits of a 32-bit float by which values are counted: quantiles are right to one part in 2,000.
KEY_BITS = 20


def _keys(x: np.ndarray) -> np.ndarray:
    """Leading bits of floats, in the floats' order; 0 and -0 alike."""
    bits = (x.astype(np.float32) + np.float32(0)).view(np.uint32)
    return np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)) >> np.uint32(32 - KEY_BITS)


def _lowest(keys: np.ndarray) -> np.ndarray:
    """The value whose other bits are 0, for each key."""
    bits = keys.astype(np.uint32) << np.uint32(32 - KEY_BITS)
    return np.where(bits >> 31, bits & np.uint32((1 << 31) - 1), ~bits).astype(np.uint32).view(np.float32)


def _matrix(column: pa.Array, dtype: type) -> np.ndarray:
    return np.stack([np.frombuffer(v, dtype) for v in column.to_pylist()])


def _quantiles(rows: DataFrame, numbers, n: int, shares: np.ndarray) -> np.ndarray:
    """The values at the given shares of all `n` rows (vals), for each of the columns that `numbers` makes of the measures."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                for k, x in enumerate(numbers(_matrix(batch.column(0), np.float32)).T):
                    key, held = np.unique(_keys(x), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), k)), pa.array(key.astype(np.int64)), pa.array(held)], ["column", "key", "held"])

    held = rows.select("vals").mapInArrow(run, "column long, key long, held long").groupBy("column", "key").agg(F.sum("held").alias("held"))
    upto = held.withColumn("upto", F.sum("held").over(Window.partitionBy("column").orderBy("key")))
    places = F.explode(F.array(*[F.lit(int(share * (n - 1))) for share in shares]))
    at = upto.withColumn("place", places).where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("held")))
    found = at.groupBy("column", "place").agg(F.first("key").alias("key")).orderBy("column", "place").collect()
    value = {(r.column, r.place): _lowest(np.array([r.key]))[0] for r in found}
    return np.array([[value[k, int(share * (n - 1))] for share in shares] for k in range(1 + max(r.column for r in found))], np.float32)


def _pairs(rows: DataFrame, edges: np.ndarray, better: int, worse: int) -> DataFrame:
    """Bins of a better row, then of a worse one. Rows are dealt over groups by a hash of the id; where one label is rare, its rows go to
    several, so that no group lacks them."""
    often, rare = max(better, worse), min(better, worse)
    groups = -(-often // GROUP)
    copies = -(-FEWEST * groups // rare)
    is_rare = (F.col("label") == 1) == F.lit(better < worse)
    copy = F.explode(F.when(is_rare, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0))))
    dealt = rows.select("id", "label", "vals", copy.alias("copy")).withColumn("group", F.pmod(F.xxhash64("id", "copy"), F.lit(groups)))

    def pair(group: pa.Table) -> pa.Table:
        group = group.sort_by([("id", "ascending"), ("copy", "ascending")])
        bins, label = _bins(edges, _matrix(group.column("vals"), np.float32)).astype(np.uint8), group.column("label").to_numpy()
        up, down = bins[label == 1], bins[label == 0]
        many = max(len(up), len(down)) if len(up) and len(down) else 0
        i = np.arange(TURNS * many)
        joined = np.hstack([up[i % len(up)], down[(i + i // many) % len(down)]]) if many else np.zeros((0, 2), np.uint8)
        return pa.table({"pair": pa.array([r.tobytes() for r in joined], pa.binary())})

    return dealt.groupBy("group").applyInArrow(pair, "pair binary")


def _slope(pairs: DataFrame, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss over all pairs, its gradient and its curvature."""
    size = len(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, gradient, curve = 0, 0.0, np.zeros(size), np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                both = _matrix(batch.column(0), np.uint8).astype(np.int64)
                half = both.shape[1] // 2
                apart, each = np.zeros((len(both), size)), np.arange(len(both))[:, None]
                at = np.arange(half) * BINS
                apart[each, both[:, :half] + at] += 1
                apart[each, both[:, half:] + at] -= 1
                ahead = apart @ weights
                pull = sigmoid(-ahead)
                n, loss = n + len(both), loss + float(np.logaddexp(0, -ahead).sum())
                gradient -= apart.T @ pull
                curve += apart.T @ (apart * (pull * (1 - pull))[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(([n, loss], gradient, curve.ravel())).tobytes()], pa.binary())], ["sums"])

    sums = np.zeros(2 + size + size * size)
    for row in pairs.coalesce(ADDERS).mapInArrow(run, "sums binary").toLocalIterator():
        sums += np.frombuffer(row.sums)
    n = max(sums[0], 1.0)
    return sums[1] / n, sums[2 : 2 + size] / n, sums[2 + size :].reshape(size, size) / n


def fit_all(rows: DataFrame, steps: int = 12, ridge: float = 1e-4, least: float = 1e-6) -> Model | None:
    """From a stored table of id, label and measures, of any size: the weights of least logistic loss over the pairs, by Newton's steps,
    halved where one leads up."""
    held = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    n, better, worse = sum(held.values()), held.get(1, 0), held.get(0, 0)
    if not n:
        return None
    edges = _quantiles(rows, lambda x: x, n, np.arange(1, BINS) / BINS)
    model = Model(edges, np.zeros((len(edges), BINS)), 0.0)
    if not better or not worse:
        return model
    pairs = settle(_pairs(rows, edges, better, worse), "pairs")
    weights, step, best = np.zeros(model.weights.size), np.zeros(model.weights.size), np.inf
    for _ in range(steps):
        loss, gradient, curve = _slope(pairs, weights + step)
        loss += ridge / 2 * float((weights + step) @ (weights + step))
        if loss > best:
            step = step / 2
            continue
        weights, gained, best = weights + step, best - loss, loss
        if gained < least:
            break
        step = -np.linalg.solve(curve + ridge * np.eye(len(weights)), gradient + ridge * weights)
    model.weights = weights.reshape(-1, BINS)
    model.shift = float(_quantiles(rows, lambda x: raw_scores(model, x)[:, None], n, np.array([worse / n]))[0, 0])
    return model


def _measured(docs: DataFrame, labels: DataFrame, id: str, text: str, label: str) -> DataFrame:
    """id, label and measures of every labelled row; of repeated ids the one that `collect_features` takes. Texts aren't shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                x = measures(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([r.tobytes() for r in x], pa.binary())], ["id", "vals"])

    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
    found = docs.where(F.col(id).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, vals binary")
    return found.join(known, "id").groupBy("id").agg(F.min(F.struct("vals", "label")).alias("one")).select("id", "one.label", "one.vals")


def train(docs: DataFrame, labels: DataFrame, on_driver: int = 16_000, id: str = "doc_id", text: str = "text", label: str = "quality") -> Model | None:
    """Fit on all labelled rows: `labels` has the id and a 0/1 label, 1 for the better."""
    if labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).limit(on_driver + 1).count() <= on_driver:
        return fit(collect_features(docs, natural_sample(labels, label, on_driver, id), _as_features, id, text))
    return fit_all(settle(_measured(docs, labels, id, text, label), "measured"))


def scores(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id`, `score` from 0 to 1 and `rank_score`, the Bradley-Terry score, of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                if model is None:
                    raw, score = np.zeros(hi - lo), np.full(hi - lo, 0.5)
                else:
                    raw = raw_scores(model, measures(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
                    score = sigmoid(raw - model.shift + np.log(CUT / (1 - CUT)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score), pa.array(raw)], ["id", "score", "rank_score"])

    picked = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "id long, score double, rank_score double").withColumnRenamed("id", id)
