"""Toxicity by a factorization machine over hashed terms.

score(x) = sigmoid(bias + sum_i w_i + sum_{i<j} <v_i, v_j>) over the hashed terms i present in a text: its words, lower-cased
in Latin-1, and their first three to five bytes. The pairwise part is computed as half of (|sum v|^2 - sum |v|^2), so its cost is
linear in the terms. A pair such as an insult next to a group's name gets a weight that neither term has.

It is fitted on the driver on at most `max_train` labelled rows, chosen by a hash of the id. Terms have a weight if they go with
the label (chi-squared of at least 20) or are in a fifth of the training rows, where pairs of them may tell what neither
does; the rest would only be learned by heart. Scoring reads every text whole. NULL and empty texts have the score of the bias
alone; equal texts have equal scores. Without any training row (empty tables) every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.learning import Adagrad, collect_features, sample, sigmoid, take
from tallyhouse.llm.text import BETWEEN, distinct_packed, fold, hash_spans, mix, row_blocks, rows_of, spans, sum_rows, utf8
from tallyhouse.session import settle

BITS = 18
PREFIXES = (3, 4, 5)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, None, np.ndarray]:
    """Distinct hashed terms of every row."""
    low = fold(data)
    starts, ends, bounds = spans(low, offsets, BETWEEN)
    rows = rows_of(bounds)
    hashes = [hash_spans(low, starts, ends)]
    hashes += [hash_spans(low, starts, np.minimum(ends, starts + n)) ^ np.uint64(n << 56) for n in PREFIXES]
    dims = mix(np.concatenate(hashes)) >> np.uint64(64 - BITS)
    ids, at = distinct_packed(np.concatenate([rows] * len(hashes)), dims, BITS, len(offsets) - 1)
    return ids.astype(np.int32), None, at


@dataclass
class Model:
    bias: float
    # Row i: weight of term i, then its vector.
    table: np.ndarray


def telling(seen, among, rows, positive, min_docs: int = 5, min_chi2: float = 20.0, common: float = 0.2):
    """If a term has a weight, from the rows that hold it and those of them with label 1; for columns and for arrays alike."""
    share = positive / rows
    off = among - seen * share
    least = min_chi2 * seen * (1 - seen / rows) * share * (1 - share)
    far = ((off > 0.5) & ((off - 0.5) * (off - 0.5) >= least)) | ((off < -0.5) & ((off + 0.5) * (off + 0.5) >= least))
    return (seen >= min_docs) & (far | (seen >= common * rows))


def telling_terms(found: DataFrame) -> np.ndarray:
    """A mark for each term that has a weight, counted where the sampled rows (label, text) are; few terms come to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place counts the rows.
        seen, among = np.zeros((1 << BITS) + 1, np.int64), np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            label = np.array(batch.column(0).to_pylist(), np.int64)
            for lo, hi in row_blocks(offsets):
                ids, _, bounds = terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                seen += np.bincount(ids, minlength=len(seen))
                among += np.bincount(ids[np.repeat(label[lo:hi] == 1, np.diff(bounds))], minlength=len(seen))
            seen[-1] += len(label)
            among[-1] += int((label == 1).sum())
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held]), pa.array(among[held])], ["term", "seen", "among"])

    counts = settle(found.mapInArrow(run, "term long, seen long, among long").groupBy("term").agg(F.sum("seen").alias("seen"), F.sum("among").alias("among")), "terms")
    out = np.zeros(1 << BITS, bool)
    total = counts.where(f"term = {1 << BITS}").first()
    if total is not None and 0 < total.among < total.seen:
        rows, positive = float(total.seen), float(total.among)
        kept = counts.where(f"term < {1 << BITS}").where(telling(F.col("seen"), F.col("among"), rows, positive)).select("term")
        out[[r.term for r in kept.collect()]] = True
    return out


def fit(rows: list[tuple], rank: int = 4, epochs: int = 16, batch: int = 256, rate: float = 0.1, ridge: float = 1e-5, seed: int = 7) -> Model:
    """Logistic loss by Adagrad over mini-batches; rows are (label, term ids, _), of which the telling ones are used."""
    table = np.zeros((1 << BITS, 1 + rank), np.float32)
    if not rows:
        return Model(-40.0, table)
    y = np.array([float(r[0]) for r in rows])
    seen, among = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for label, ids, _ in rows:  # a row has a term once
        seen[ids] += 1
        among[ids] += label
    kept = np.flatnonzero(telling(seen, among, float(len(y)), float(y.sum())))
    place = np.full(1 << BITS, -1, np.int32)
    place[kept] = np.arange(len(kept), dtype=np.int32)
    known = [p[p >= 0] for p in (place[r[1]] for r in rows)]
    local, bounds = np.concatenate(known), np.concatenate(([0], np.cumsum([len(k) for k in known])))
    rng = np.random.default_rng(seed)
    share = float(y.mean())
    weights = np.zeros((len(kept), 1 + rank))
    weights[:, 1:] = rng.normal(0, 0.01, (len(kept), rank))
    bias = np.array([_logit(share)])
    step, step_bias = Adagrad(weights.shape, rate), Adagrad(1, rate)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            at, cut = take(bounds, chosen)
            used = local[at]
            held = weights[used]
            sums = sum_rows(held, cut)
            squares = sum_rows(held[:, 1:] ** 2, cut)
            raw = bias[0] + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - squares).sum(1)
            error = (sigmoid(raw) - y[chosen]) / len(chosen)
            each = np.repeat(error, np.diff(cut))
            gradient = np.empty_like(weights)
            gradient[:, 0] = np.bincount(used, each, len(kept))
            inner = np.repeat(sums[:, 1:], np.diff(cut), axis=0) - held[:, 1:]
            for k in range(rank):
                gradient[:, 1 + k] = np.bincount(used, each * inner[:, k], len(kept))
            step.step(weights, gradient + ridge * weights)
            step_bias.step(bias, np.array([error.sum()]))
    table[kept] = weights
    return Model(float(bias[0]), table)


def score_block(model: Model, ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    held = model.table[ids]
    sums = sum_rows(held, bounds)
    return sigmoid(model.bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2 - sum_rows(held[:, 1:] ** 2, bounds)).sum(1))


def train(docs: DataFrame, labels: DataFrame, max_train: int = 16_000, id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on labelled rows: `labels` has the id and a 0/1 label.

    The sample has as many toxic rows as there are; the bias is then set back to their share among all labelled rows.
    """
    chosen = settle(sample(labels, label, max_train, id), "sample")
    # Bounded by the sample's size.
    found = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id").select("label", "text")
    useful = telling_terms(found)

    def useful_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, None, np.ndarray]:
        ids, _, bounds = terms(data, offsets)
        keep = useful[ids]
        return ids[keep], None, np.concatenate(([0], np.cumsum(keep)))[bounds]

    rows = collect_features(docs, chosen, useful_terms, id, text)
    model = fit(rows)
    all_rows = labels.where(F.col(id).isNotNull()).agg(F.avg(F.col(label).cast("double"))).first()[0]
    if rows and all_rows is not None:
        model.bias += _logit(all_rows) - _logit(np.mean([float(r[0]) for r in rows]))
    return model


def _logit(share: float) -> float:
    share = min(max(share, 1e-3), 1 - 1e-3)
    return float(np.log(share / (1 - share)))


def scores(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """`id` and `score` of every row."""
    # Of fixed size: 2**BITS rows.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                ids, _, bounds = terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(score_block(shared.value, ids, bounds))], ["id", "score"])

    picked = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "id long, score double").withColumnRenamed("id", id)


def reject(docs: DataFrame, model: Model, cut: float = 0.3, text: str = "text") -> DataFrame:
    """`docs` without the rows whose score is `cut` or more; all columns stay, and no row is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for lo, hi in row_blocks(offsets):
                ids, _, bounds = terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield batch.slice(lo, hi - lo).filter(pa.array(score_block(shared.value, ids, bounds) < cut))

    return docs.mapInArrow(run, docs.schema)
