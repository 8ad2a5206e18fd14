"""Language identification by error-correcting output codes.

Every language has a codeword; each of its bits is predicted by a logistic model over hashed byte trigrams. A text gets the
language whose codeword has the least loss, each bit's loss weighted by how far the bit's model is better than chance on its
training rows. Up to seven languages have the exhaustive code; more have the best of some drawn codes by least distance.

It is fitted on the driver on at most `max_train` rows, chosen by a hash of the id, as many of each language as there are. Every
text is read whole. NULL texts and texts without a letter are `und` with score 0; equal texts have equal results; without any
training row everything is `und`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.learning import Adagrad, collect_features, sample, sigmoid, stack, take
from tallyhouse.llm.text import LOWER, distinct_packed, row_blocks, rows_of, sum_rows, utf8

BITS = 14
# Positions scored at once, so that the gathered weights stay in the cache.
PIECE = 1 << 15
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of bytes, digits and ASCII case made alike, within each row."""
    low = LOWER[data]
    low[(low >= 48) & (low <= 57)] = 48
    size = np.maximum(np.diff(offsets) - 2, 0)
    bounds = np.concatenate(([0], np.cumsum(size)))
    if len(low) < 3:
        return np.zeros(0, np.int32), bounds
    x = low[:-2].astype(np.uint32) | low[1:-1].astype(np.uint32) << np.uint32(8) | low[2:].astype(np.uint32) << np.uint32(16)
    dims = ((x * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)
    inside = np.ones(len(dims), bool)
    edge = np.concatenate((offsets[1:-1] - 1, offsets[1:-1] - 2))
    inside[edge[(edge >= 0) & (edge < len(dims))]] = False
    # A row shorter than three bytes has no position left.
    return dims[inside], bounds


def shares(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every row: its distinct trigrams with their shares."""
    dims, bounds = trigrams(data, offsets)
    n, rows = len(offsets) - 1, rows_of(bounds)
    ids, at = distinct_packed(rows, dims, BITS, n)
    key = rows << BITS | dims
    key.sort()
    count = np.diff(np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])) if len(key) else np.zeros(0)
    return ids, count / np.maximum(np.diff(bounds), 1)[rows_of(at)], at


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +1 and -1 for each of n classes."""
    if n <= 7:
        columns = [[1 if k == 0 or word >> (k - 1) & 1 else -1 for k in range(n)] for word in range(2 ** max(n - 1, 1) - 1)]
        return np.array(columns).T.reshape(n, -1)
    rng, best, apart = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice([-1, 1], (n, int(np.ceil(10 * np.log2(n)))))
        code = code[:, np.abs(code.sum(0)) < n]  # a column must tell some classes apart
        distance = (code.shape[1] - code @ code.T) // 2 + np.eye(n, dtype=int) * 10**6
        if distance.min() > apart:
            best, apart = code, distance.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray
    scale: float


def fit(rows: list[tuple], epochs: int = 12, batch: int = 128, rate: float = 0.3, ridge: float = 1e-6, seed: int = 7) -> Model | None:
    """Logistic regression of each bit on the shares' square roots, scaled; rows are (language, trigrams, shares)."""
    if not rows:
        return None
    languages = sorted({r[0] for r in rows})
    code = codewords(len(languages))
    ids, values, bounds = stack(rows)
    values = values.astype(np.float64) * 100
    place = {x: k for k, x in enumerate(languages)}
    target = (code[[place[r[0]] for r in rows]] + 1) / 2
    bits = code.shape[1]
    weights, bias = np.zeros((1 << BITS, bits)), np.zeros(bits)
    step, step_bias = Adagrad(weights.shape, rate), Adagrad(bits, rate)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            at, cut = take(bounds, chosen)
            used, x = ids[at], values[at]
            raw = sum_rows(weights[used] * x[:, None], cut) + bias
            error = (sigmoid(raw) - target[chosen]) / len(chosen)
            each = np.repeat(error, np.diff(cut), axis=0) * x[:, None]
            gradient = np.stack([np.bincount(used, each[:, k], 1 << BITS) for k in range(bits)], 1) if bits else weights
            step.step(weights, gradient + ridge * weights)
            step_bias.step(bias, error.sum(0))
    wrong = np.zeros(bits)
    for lo in range(0, len(rows), batch):
        at, cut = take(bounds, np.arange(lo, min(lo + batch, len(rows))))
        raw = sum_rows(weights[ids[at]] * values[at][:, None], cut) + bias
        wrong += ((raw > 0) != (target[lo : lo + batch] > 0.5)).sum(0) / len(rows)
    trust = np.maximum(0.01, 1 - 2 * wrong)
    return Model(languages, code, weights.astype(np.float32), bias, trust / trust.sum() if bits else trust, 100.0)


def decode(model: Model, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword by weighted loss: best class, its score, and the gap in loss to the next class."""
    if len(model.languages) == 1:
        return np.zeros(len(raw), int), np.ones(len(raw)), np.full(len(raw), np.inf)
    loss = np.stack([(np.logaddexp(0, -np.clip(raw * word, -30, 30)) * model.trust).sum(1) for word in model.code], 1)
    order = np.argsort(loss, axis=1, kind="stable")
    least = np.take_along_axis(loss, order[:, :2], 1)
    weight = np.exp(-(loss - least[:, :1]) * model.code.shape[1] / 2)
    return order[:, 0], 1 / weight.sum(1), least[:, 1] - least[:, 0]


def raw_bits(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    dims, bounds = trigrams(data, offsets)
    total = np.zeros((len(offsets) - 1, model.code.shape[1]))
    for lo in range(0, len(dims), PIECE):
        hi = min(len(dims), lo + PIECE)
        first, last = int(np.searchsorted(bounds, lo, "right")) - 1, int(np.searchsorted(bounds, hi, "left"))
        total[first:last] += sum_rows(model.weights[dims[lo:hi]], np.clip(bounds[first : last + 1], lo, hi) - lo)
    return total * (model.scale / np.maximum(np.diff(bounds), 1))[:, None] + model.bias


def has_letter(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    found = sum_rows(_ASCII_LETTER[data].astype(np.int64), offsets) > 0
    for k in np.flatnonzero(~found).tolist():
        found[k] = any(c.isalpha() for c in column[k].as_py() or "")
    return found


def train(docs: DataFrame, known: DataFrame, max_train: int = 6_000, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fit on the rows of `known` (id and language, NULL left out)."""
    return fit(collect_features(docs, sample(known, lang, max_train, id), shares, id, text))


def predict(docs: DataFrame, model: Model | None, id: str = "doc_id", text: str = "text", gap: float = 0.15) -> DataFrame:
    """`id`, `lang_pred`, `score` and `ambiguous` (the next codeword's loss is within `gap`) of every row."""
    # Of fixed size: 2**BITS weights per bit.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                known = has_letter(batch.column(1).slice(lo, hi - lo), part, at) & (m is not None)
                if m is None:
                    names, score, near = ["und"] * (hi - lo), np.zeros(hi - lo), known
                else:
                    best, score, apart = decode(m, raw_bits(m, part, at))
                    names = [m.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                    score, near = np.where(known, score, 0.0), known & (apart < gap)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score), pa.array(near)], ["id", "lang_pred", "score", "ambiguous"])

    picked = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "id long, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id)
