"""Bounded training samples and small logistic models over sparse rows, fitted on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.text import row_blocks, utf8

# Of a block of texts (bytes and row offsets): the features of every row (int32 ids, float32 values or None for all 1, where each
# row's begin).
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray | None, np.ndarray]]

SALTS = 64


def fold(id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; NULL for a NULL id."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % n


def sample(rows: DataFrame, label: str, limit: int, id: str = "doc_id") -> DataFrame:
    """At most `limit` rows (id, label), chosen by a hash of the id, as many of each label as there are.

    Rows without id or label are left out. Labels take turns; a label is dealt over `SALTS` tasks, so that a frequent one
    doesn't fill one, and Spark keeps the first rows of each per task before the shuffle.
    """
    known = rows.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(label).alias("label"))
    salted = known.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    turn = F.row_number().over(Window.partitionBy("label", "salt").orderBy(F.xxhash64("id"), "id"))
    return salted.withColumn("turn", turn).where(F.col("turn") <= limit).orderBy("turn", "salt", F.xxhash64("id"), "id", "label").limit(limit).select("id", "label")


def natural_sample(rows: DataFrame, label: str, limit: int, id: str = "doc_id") -> DataFrame:
    """At most `limit` rows (id, label), chosen by a hash of the id, labels as frequent as they are."""
    known = rows.where(F.col(id).isNotNull() & F.col(label).isNotNull()).select(F.col(id).cast("long").alias("id"), F.col(label).alias("label"))
    return known.orderBy(F.xxhash64("id"), "id", "label").limit(limit)


def collect_features(docs: DataFrame, chosen: DataFrame, features: Features, id: str = "doc_id", text: str = "text") -> list[tuple]:
    """(label, ids, values) of the chosen rows, values empty for all 1; `chosen` is bounded by `sample`, so it is broadcast and collected.

    Of documents that repeat a chosen id, and of labels that do, one counts: the one with the least features and label.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                ids, values, bounds = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                cut = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                values = np.zeros(0) if values is None else values
                packed = [pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (ids.astype(np.int32), values.astype(np.float32))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), *packed], ["label", "id", "ids", "vals"])

    label_type = chosen.schema["label"].dataType.simpleString()
    found = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("label", "text", "id")
    made = found.mapInArrow(run, f"label {label_type}, id long, ids binary, vals binary")
    rows = made.groupBy("id").agg(F.min(F.struct("ids", "vals", "label")).alias("one")).select("one.label", "id", "one.ids", "one.vals").collect()
    rows.sort(key=lambda r: (r.id, bytes(r.ids)))  # the same order whatever task ended first
    return [(r.label, np.frombuffer(r.ids, np.int32), np.frombuffer(r.vals, np.float32)) for r in rows]


def stack(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, values and bounds of all rows."""
    bounds = np.concatenate(([0], np.cumsum([len(r[1]) for r in rows]))).astype(np.int64)
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.float32), bounds
    return np.concatenate([r[1] for r in rows]), np.concatenate([r[2] for r in rows]), bounds


def take(bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the chosen rows' items, and the new bounds."""
    count = bounds[rows + 1] - bounds[rows]
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(bounds[rows] - ends + count, count) + np.arange(total), np.concatenate(([0], ends))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adagrad:
    def __init__(self, shape, rate: float):
        self.seen, self.rate = np.full(shape, 1e-6), rate

    def step(self, weights: np.ndarray, gradient: np.ndarray) -> None:
        self.seen += gradient * gradient
        weights -= self.rate * gradient / np.sqrt(self.seen)
