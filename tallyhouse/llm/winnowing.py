"""Document fingerprints by winnowing.

Every run of K code points has a rolling hash. Of every window of W consecutive hashes the least is kept, the rightmost of equal
ones, with its position. So two texts that share K + W - 1 consecutive code points share a mark, and positions say where. A text
with fewer than W hashes is one window; one shorter than K code points has one mark, the hash of the whole text; the empty text
and NULL have none.

The likeness of two fingerprints is the Jaccard similarity of their distinct marks: 1 for equal texts, also for two empty ones.
Texts are handled whole, in blocks of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.order import descending_runs
from tallyhouse.llm.text import BLOCK, mix, rows_of, string_blocks

K, W = 16, 48
# Equal rows given out by one task.
AT_ONCE = 1000
_BASE = 0x9E3779B97F4A7C15
_NONE = np.uint64(2**64 - 1)
# Bits of a position in a packed mark.
_AT = np.uint64(31)


def _rolling(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k points from each place on, by doubling; k is split into powers of two."""
    size = 1
    power = mix(points.astype(np.uint64) + np.uint64(1))
    out, done = None, 0
    while True:
        if k & size:
            # Append a run of `size` points behind the `done` points so far.
            out = power if out is None else out[: len(power) - done] * np.uint64(pow(_BASE, size, 1 << 64)) + power[done:]
            done += size
        if size * 2 > k:
            return out[: len(points) - k + 1]
        power = power[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + power[size:]
        size *= 2


def _least(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w values."""
    size = 1
    while size * 2 <= w:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (w - size)], values[w - size :])


def winnow(texts: list[str], k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """32-bit marks and their positions, in order of position, and where each text's begin."""
    sizes = np.array([len(t) for t in texts], np.int64)
    # A gap behind every text keeps windows from reaching the next.
    gap = "\0" * (w + k)
    points = np.frombuffer((gap.join(texts) + gap).encode("utf-32-le", "surrogatepass"), np.uint32)
    begin = np.cumsum(sizes + w + k) - sizes - w - k
    hashes = mix(_rolling(points, k)) >> np.uint64(32)
    packed = hashes << _AT | (np.uint64(2**31 - 1) - np.arange(len(hashes), dtype=np.uint64))
    grams = np.maximum(sizes - k + 1, 0)
    # Only runs inside a text count.
    change = np.zeros(len(packed) + 1, np.int8)
    held = grams > 0
    change[begin[held]] += 1
    change[begin[held] + grams[held]] -= 1
    packed[np.cumsum(change[:-1]) == 0] = _NONE
    least = _least(packed, w)
    windows = np.where(held, np.maximum(grams - w + 1, 1), 0)
    ends = np.cumsum(windows)
    first = np.repeat(begin - ends + windows, windows) + np.arange(int(ends[-1]) if len(ends) else 0)
    chosen, owner = least[first], np.repeat(np.arange(len(texts)), windows)
    new = np.ones(len(chosen), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    chosen, owner = chosen[new], owner[new]
    marks = (chosen >> _AT).astype(np.uint32)
    places = (np.uint64(2**31 - 1) - (chosen & np.uint64(2**31 - 1))).astype(np.int64) - begin[owner]
    short = np.flatnonzero((sizes > 0) & ~held)
    if len(short):
        whole = np.array([int.from_bytes(hashlib.blake2b(texts[i].encode("utf-8", "surrogatepass"), digest_size=4).digest()) for i in short], np.uint32)
        order = np.argsort(np.concatenate((owner, short)), kind="stable")
        owner = np.concatenate((owner, short))[order]
        marks, places = np.concatenate((marks, whole))[order], np.concatenate((places, np.zeros(len(short), np.int64)))[order]
    return marks, places, np.searchsorted(owner, np.arange(len(texts) + 1))


def _distinct(marks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    key = rows.astype(np.int64) << 32 | marks.astype(np.int64)
    key.sort()
    return key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key


def likeness(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Jaccard similarity of each of n rows, from sorted row-and-mark keys; 1 if both are empty."""
    both = np.concatenate((a, b))
    both.sort()
    shared = np.bincount(both[1:][both[1:] == both[:-1]] >> 32, minlength=n) if len(both) else np.zeros(n, int)
    union = np.bincount(a >> 32, minlength=n) + np.bincount(b >> 32, minlength=n) - shared
    return np.where(union, shared / np.maximum(union, 1), 1.0)


def spelled(marks: np.ndarray, bounds: np.ndarray) -> list[str]:
    """Eight hex digits for each mark, in order of position."""
    text = marks.astype(">u4").tobytes().hex()
    return [text[8 * a : 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def fingerprints(df: DataFrame, text: str = "text", id: str = "doc_id", k: int = K, w: int = W) -> DataFrame:
    """`id`, `n_chars`, `marks` and `positions` (code points) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in string_blocks(batch.column(1)):
                marks, places, bounds = winnow(texts, k, w)
                at = pa.array(bounds, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int64))) for x in (marks, places)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts], pa.int64()), *lists], ["id", "n_chars", "marks", "positions"])

    picked = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "id long, n_chars long, marks array<long>, positions array<long>").withColumnRenamed("id", id)


def edited(text: str, following: str) -> str:
    """The last third (rounded down) replaced by the first as many code points of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def against_next(df: DataFrame, text: str = "text", id: str = "doc_id", partitions: int | None = None) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and their likeness and that to the next row's, in descending order of id.

    The texts are shuffled once, into ranges of ids. Rows of equal id follow each other by a hash of the text and the text, so equal
    rows stand together; NULL ids come last. Of very many equal rows one goes through the ranges, the others are measured once
    against themselves and given out by several tasks.
    """

    def measured(ids: list, texts: list[str], borrowed: list[bool]) -> pa.RecordBatch:
        """Of all rows but the last, which has no successor here."""
        n = len(texts) - 1
        changed = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
        marks, _, at = winnow(texts)
        other, _, other_at = winnow(changed)
        rows = rows_of(at)
        mine, following = rows < n, rows > 0
        a, e = _distinct(marks[mine], rows[mine]), _distinct(other, rows_of(other_at))
        b = _distinct(marks[following], rows[following] - 1)
        columns = [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed], pa.string()),
            pa.array(spelled(marks, at)[:-1], pa.string()),
            pa.array(spelled(other, other_at), pa.string()),
            pa.array(likeness(a, e, n)),
            pa.array(likeness(a, b, n)),
            pa.array(np.diff(at)[:-1]),
        ]
        out = pa.RecordBatch.from_arrays(columns, ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_marks"])
        return out.filter(pa.array([not x for x in borrowed[:-1]]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, borrowed = [], [], []
        for batch in batches:
            for lo, hi, block in string_blocks(batch.column(1), BLOCK // 2):
                ids = ids[-1:] + batch.column(0).slice(lo, hi - lo).to_pylist()
                borrowed = borrowed[-1:] + batch.column(2).slice(lo, hi - lo).to_pylist()
                texts = texts[-1:] + block
                if len(texts) > 1:
                    yield measured(ids, texts, borrowed)

    def with_itself(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, block in string_blocks(batch.column(1), BLOCK // 2):
                for i, text in enumerate(block, lo):
                    (number,) = batch.column(0).slice(i, 1).to_pylist()
                    one = measured([number] * 2, [text] * 2, [False] * 2)
                    yield pa.RecordBatch.from_arrays([*one.columns, batch.column(2).slice(i, 1)], [*one.schema.names, "copies"])

    schema = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_marks long"
    runs, repeats = descending_runs(df, id, text, partitions)
    rows = runs.mapInArrow(run, schema)
    if repeats is not None:
        part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / AT_ONCE)))
        dealt = repeats.mapInArrow(with_itself, f"{schema}, copies long").withColumn("part", part).repartition("id", "part")
        times = F.least(F.lit(AT_ONCE).cast("long"), F.col("copies") - F.col("part") * AT_ONCE).cast("int")
        rows = rows.unionByName(dealt.withColumn("one", F.explode(F.array_repeat(F.lit(0), times))).drop("copies", "part", "one"))
    return rows.withColumnRenamed("id", id)
