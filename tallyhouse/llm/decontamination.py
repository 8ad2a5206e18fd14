"""Benchmark decontamination by latent semantic retrieval.

1. The words of the benchmark passages are the terms; their document frequency is counted over passages of the whole corpus.
   A passage's informative terms are those in at most `stop_share` of all passages, and its `rarest` rarest ones anyway.
2. Every document is reduced to where informative terms stand in it. On that table, which is small, the corpus passages form a
   TF-IDF matrix, whose leading right singular vectors are found by a randomised SVD: tasks multiply their rows with a random
   matrix and back, twice, the products are added up, and one Rayleigh-Ritz step turns them into singular vectors. The benchmark's own
   passages weigh as much as the corpus, so that the latent space holds all of them.
3. Windows of every document that share at least a quarter of a passage's informative terms are compared with it by their
   cosine in the latent space. Since other items may stand beside a short passage, windows of its own length or twice that
   (`WIDTHS`) are compared as well, and those that hold nearly all of its terms are candidates whatever the cosine.
4. Candidates are read again, and the longest common subsequence of words decides: nearly all words of the passage in order are
   a copy; half of all its words, of its informative words and of its answer, in order, are a paraphrase. The answer is the
   benchmark's `answer` column, or else the passage's last sentence.

The benchmark is taken in blocks of `block_items` passages, so what a block sends to the driver or to all tasks (terms times the
rank of the space) is bounded. The texts are read once for a group of `group_blocks` blocks in each of the steps 1, 2 and 4, whose
terms and passages are bounded by that; a block's space and search (2, 3) read only the small table. The corpus is searched whole for each
block, and grouping changes no result. Long items are cut into passages of `PART` words.
Items of fewer than `min_words` words are searched for as they are, word after word (with an `answer` column, half of the answer
must stand near): a copy has no cosine, and an item of one common word is in many documents. Items without words are in none. Rows without id cannot be reported and are left out; NULL and empty
texts are clean; a row that is repeated is reported once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.small import join_small
from tallyhouse.llm.text import BETWEEN, fold, hash_spans, row_blocks, rows_of, spans, sum_rows, utf8
from tallyhouse.session import scratch, settle

PART = 64
WINDOW, STRIDE = 64, 24
# Windows for short passages: those of a quarter of the width to all of it. They begin as far apart, for their width, as the others.
WIDTHS = (8, 16, 32)
# Terms whose rows of a product travel together.
_CHUNK = 64


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every row, lower-cased in Latin-1, and where each row's begin."""
    low = fold(data)
    starts, ends, bounds = spans(low, offsets, BETWEEN)
    return hash_spans(low, starts, ends), bounds


def hashes_of(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    return word_hashes(raw, np.array([0, len(raw)]))[0]


@dataclass
class Passage:
    item: int
    words: np.ndarray
    answer: np.ndarray
    # The informative terms, as numbered in the block, and their hashes.
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rare: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))


def passages_of(item: int, text: str, answer: str | None, min_words: int) -> list[Passage]:
    """The item's passages; the answer goes with the last."""
    words = hashes_of(text or "")
    if len(words) < min_words:
        return []
    if answer:
        last = hashes_of(answer)
    else:
        sentences = [s for s in re.split(r"[.?!]+", text) if s.strip()]
        last = hashes_of(sentences[-1]) if sentences else words[:0]
        if len(last) < 3:
            last = words[-max(3, len(words) // 4) :]
    count = max(1, round(len(words) / PART))
    cuts = [len(words) * k // count for k in range(count + 1)]
    return [Passage(item, words[a:b], last if b == len(words) else words[:0]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Terms:
    """Finds the ids of known word hashes; a table by leading bits rules most others out."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.first = np.zeros(1 << 20, bool)
        self.first[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known words, and their ids."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.first[(words >> np.uint64(44)).astype(np.int64)])
        ids = np.minimum(np.searchsorted(self.hashes, words[at]), len(self.hashes) - 1)
        same = self.hashes[ids] == words[at]
        return at[same], ids[same]


def _text_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, word hashes and bounds of blocks of rows (id, text)."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for lo, hi in row_blocks(offsets):
            yield batch.column(0).slice(lo, hi - lo), *word_hashes(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])


def passage_frequencies(docs: DataFrame, hashes: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many corpus passages each term stands, and how many there are; one number a term comes to the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(Terms(hashes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen, total = shared.value, np.zeros(len(hashes) + 1, np.int64), 0
        for _, words, bounds in _text_blocks(batches):
            count = -(-np.diff(bounds) // WINDOW)
            begin = np.concatenate(([0], np.cumsum(count)))
            at, ids = known.find(words)
            row = np.searchsorted(bounds, at, "right") - 1
            key = np.unique((begin[row] + (at - bounds[row]) // WINDOW) * (len(hashes) + 1) + ids)
            seen += np.bincount(key % (len(hashes) + 1), minlength=len(seen))
            total += int(begin[-1])
        seen[-1] = total
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(seen[held])], ["term", "n"])

    out = np.zeros(len(hashes) + 1, np.int64)
    for r in docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term] = r.n
    shared.destroy()
    return out[:-1], int(out[-1])


def sieve(docs: DataFrame, hashes: np.ndarray, least: int) -> DataFrame:
    """(id, at, terms): where informative terms stand, as packed int32, of documents with `least` of them."""
    shared = docs.sparkSession.sparkContext.broadcast(Terms(hashes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, words, bounds in _text_blocks(batches):
            at, ids = shared.value.find(words)
            row = np.searchsorted(bounds, at, "right") - 1
            cut = np.searchsorted(row, np.arange(len(bounds)))
            place, term = (at - bounds[row]).astype(np.int32), ids.astype(np.int32)
            keep = np.flatnonzero(np.diff(cut) >= least).tolist()
            packed = [pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in keep], pa.binary()) for x in (place, term)]
            yield pa.RecordBatch.from_arrays([own.take(pa.array(keep, pa.int64())), *packed], ["id", "at", "terms"])

    return docs.mapInArrow(run, "id long, at binary, terms binary")


def _unpacked(batch: pa.RecordBatch, numbers: np.ndarray | None, size: int = 512) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, rows, places and terms of slices of the sieved table; `numbers` are those that a block gives to the table's terms, -1 for
    terms of other blocks."""
    for lo in range(0, batch.num_rows, size):
        part = batch.slice(lo, size)
        at, terms = ([np.frombuffer(x, np.int32) for x in part.column(c).to_pylist()] for c in (1, 2))
        rows = np.repeat(np.arange(part.num_rows), [len(x) for x in at])
        places, found = np.concatenate(at).astype(np.int64), np.concatenate(terms).astype(np.int64)
        if numbers is not None:
            found = numbers[found]
            own = found >= 0
            rows, places, found = rows[own], places[own], found[own]
        yield part.column(0), rows, places, found


def _rows_of_matrix(row: np.ndarray, term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """TF-IDF rows of unit length, from (row, term) of each word: terms, values, and where each row's begin."""
    key, count = np.unique(row * len(idf) + term, return_counts=True)
    r, t = key // len(idf), key % len(idf)
    new = np.r_[True, r[1:] != r[:-1]] if len(r) else np.zeros(0, bool)
    bounds = np.concatenate((np.flatnonzero(new), [len(r)]))
    value = (1 + np.log(count)) * idf[t]
    norm = np.sqrt(sum_rows(value**2, bounds))
    return t, value / np.repeat(np.maximum(norm, 1e-12), np.diff(bounds)), bounds


def _gram(terms: np.ndarray, values: np.ndarray, bounds: np.ndarray, right: np.ndarray, into: np.ndarray, step: int = 256) -> None:
    """into += A' A right, for the rows of a block of A."""
    for lo in range(0, len(bounds) - 1, step):
        cut = bounds[lo : lo + step + 1]
        t, v = terms[cut[0] : cut[-1]], values[cut[0] : cut[-1], None]
        across = sum_rows(right[t] * v, cut - cut[0])
        back = across[rows_of(cut - cut[0])] * v
        order = np.argsort(t, kind="stable")
        first = np.flatnonzero(np.r_[True, t[order][1:] != t[order][:-1]]) if len(t) else np.zeros(0, int)
        if len(first):
            into[t[order][first]] += np.add.reduceat(back[order], first, axis=0)


def corpus_gram(sieved: DataFrame, idf: np.ndarray, right: np.ndarray, numbers: np.ndarray | None = None) -> np.ndarray:
    """A' A right over the corpus passages with two informative words or more; the sum, as large as `right`, comes to the driver."""
    shared = sieved.sparkSession.sparkContext.broadcast((idf, right.astype(np.float32), numbers))
    width = right.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, matrix, own = shared.value
        total = np.zeros(matrix.shape, np.float64)
        for batch in batches:
            for _, row, at, term in _unpacked(batch, own):
                place = row * (1 << 32) + at // WINDOW
                _, passage, words = np.unique(place, return_inverse=True, return_counts=True)
                more = words[passage] > 1
                if more.any():
                    _gram(*_rows_of_matrix(passage[more], term[more], weights), matrix, total)
        part = TaskContext.get().partitionId() % 64
        chunks = [k for k in range(0, len(total), _CHUNK) if total[k : k + _CHUNK].any()]
        columns = [pa.array([k // _CHUNK for k in chunks], pa.int32()), pa.array([part] * len(chunks), pa.int32()), pa.array([total[k : k + _CHUNK].astype(np.float32).tobytes() for k in chunks], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "part", "product"])

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in group["product"].to_pylist())
        return pa.table({"chunk": pa.array([group["chunk"][0].as_py()], pa.int32()), "product": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    parts = sieved.mapInArrow(run, "chunk int, part int, product binary")
    once = parts.groupBy("chunk", "part").applyInArrow(added, "chunk int, product binary")
    out = np.zeros(right.shape)
    for r in once.groupBy("chunk").applyInArrow(added, "chunk int, product binary").collect():
        piece = np.frombuffer(r.product, np.float32).reshape(-1, width)
        out[r.chunk * _CHUNK : r.chunk * _CHUNK + len(piece)] = piece
    shared.destroy()
    return out


def latent_space(sieved: DataFrame, passages: list[Passage], idf: np.ndarray, n_rows: int, numbers: np.ndarray | None = None, extra: int = 32, seed: int = 7) -> np.ndarray:
    """Leading right singular vectors (terms x rank) of the corpus passages and the benchmark's."""
    rank = min(len(idf), len(passages) + extra)
    owner = np.repeat(np.arange(len(passages)), [len(p.terms) for p in passages])
    own = _rows_of_matrix(owner, np.concatenate([p.terms for p in passages]), idf)
    weight = max(1.0, n_rows / len(passages))

    def product(right: np.ndarray) -> np.ndarray:
        mine = np.zeros(right.shape)
        _gram(*own, right, mine)
        return corpus_gram(sieved, idf, right, numbers) + weight * mine

    start = np.random.default_rng(seed).normal(size=(len(idf), min(len(idf), rank + 16)))
    # A second product draws the basis towards the leading vectors.
    basis, _ = np.linalg.qr(product(np.linalg.qr(product(start))[0]))
    _, turn = np.linalg.eigh(basis.T @ product(basis))
    return (basis @ turn[:, ::-1])[:, :rank]


def candidates(
    sieved: DataFrame, passages: list[Passage], idf: np.ndarray, space: np.ndarray, share: float, cosine: float, enough: float = 0.9, numbers: np.ndarray | None = None
) -> DataFrame:
    """(id, passage, start, width, cosine) of the windows (first word `start`) that are near a passage in the latent space, or
    are about as long and hold `enough` of its terms."""
    owner = np.repeat(np.arange(len(passages)), [len(p.terms) for p in passages])
    flat = np.concatenate([p.terms for p in passages])
    terms, values, bounds = _rows_of_matrix(owner, flat, idf)
    wanted = sum_rows(space[terms] * values[:, None], bounds)
    wanted /= np.maximum(np.linalg.norm(wanted, axis=1, keepdims=True), 1e-12)
    sizes, own = np.array([len(p.words) for p in passages]), np.diff(bounds)
    need, plenty = np.maximum(2, np.ceil(share * own)), np.maximum(2, np.ceil(enough * own))
    by_term = np.argsort(terms, kind="stable")
    held, owned = rows_of(bounds)[by_term], terms[by_term]
    # The passages of each width, by term; the widest windows are for all.
    scales = []
    for width in (*WIDTHS, WINDOW):
        members = (sizes * 4 > width) & (sizes <= width) | (width == WINDOW)
        chosen = members[held]
        if chosen.any():
            scales.append((width, held[chosen], np.searchsorted(owned[chosen], np.arange(len(idf) + 1))))
    # Bounded by the block of the benchmark: terms x rank, passages x rank.
    shared = sieved.sparkSession.sparkContext.broadcast((idf, space.astype(np.float32), wanted.astype(np.float32), scales, need, np.where(sizes * 4 > WINDOW, plenty, np.inf), plenty, numbers))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, vectors, goal, scales, least, most_wide, most_narrow, own = shared.value
        n = len(goal)
        for batch in batches:
            for ids, row, at, term in _unpacked(batch, own, 256):
                for width, members, first in scales:
                    stride, most = width * STRIDE // WINDOW, most_wide if width == WINDOW else most_narrow
                    reach = width // stride + 1
                    if not (first[term + 1] > first[term]).any():
                        continue
                    # The windows that hold a word: those that begin at most width - 1 before it.
                    last = at // stride
                    begins = last[:, None] - np.arange(reach)
                    inside = ((begins >= 0) & (at[:, None] - begins * stride < width)).ravel()
                    w_row, w_begin, w_term = np.repeat(row, reach)[inside], begins.ravel()[inside], np.repeat(term, reach)[inside]
                    names, window = np.unique(w_row << 40 | w_begin, return_inverse=True)
                    pair = np.unique(window * len(weights) + w_term)
                    p_window, p_term = pair // len(weights), pair % len(weights)
                    count = first[p_term + 1] - first[p_term]
                    ends = np.cumsum(count)
                    met = members[np.repeat(first[p_term] - ends + count, count) + np.arange(int(ends[-1]) if len(ends) else 0)]
                    both, common = np.unique(np.repeat(p_window, count) * n + met, return_counts=True)
                    kept = common >= least[both % n]
                    both, common = both[kept], common[kept]
                    if not len(both):
                        continue
                    near = np.isin(window, np.unique(both // n))
                    chosen, local = np.unique(window[near], return_inverse=True)
                    t, v, cut = _rows_of_matrix(local, w_term[near], weights)
                    latent = sum_rows(vectors[t] * v[:, None], cut)
                    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)
                    close = (latent[np.searchsorted(chosen, both // n)] * goal[both % n]).sum(1)
                    good = (close >= cosine) | (common >= most[both % n])
                    name = names[both[good] // n]
                    starts = ((name & ((1 << 40) - 1)) * stride).astype(np.int64)
                    columns = [ids.take(pa.array(name >> 40)), pa.array((both[good] % n).astype(np.int32)), pa.array(starts), pa.array(np.full(len(name), width, np.int32)), pa.array(close[good].astype(np.float64))]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "passage", "start", "width", "cosine"])

    return sieved.mapInArrow(run, "id long, passage int, start long, width int, cosine double")


def common_subsequence(masks: dict, size: int, words: list) -> int:
    """Length of the longest common subsequence, bit-parallel; masks: by word, the bits of its places in a sequence of `size`."""
    full = (1 << size) - 1
    state = full
    for w in words:
        hit = state & masks.get(w, 0)
        state = ((state + hit) | (state - hit)) & full
    return size - state.bit_count()


def _masks(words: list) -> dict:
    out: dict = {}
    for k, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << k
    return out


def _prepared(p: Passage) -> tuple:
    """What the subsequence checks look up, of words, informative words and answer."""
    words, answer, rare = p.words.tolist(), p.answer.tolist(), set(p.rare.tolist())
    told = [w for w in words if w in rare]
    return p.item, len(words), _masks(words), len(told), _masks(told), rare, len(answer), _masks(answer)


def verify(docs: DataFrame, found: DataFrame, passages: list[Passage]) -> DataFrame:
    """(id, item_id, kind, lcs, rare_lcs, answer_lcs, cosine, start, end) of the candidates that hold up; places in words."""
    shared = docs.sparkSession.sparkContext.broadcast(passages)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[int, tuple] = {}
        names = ["id", "item_id", "kind", "lcs", "rare_lcs", "answer_lcs", "cosine", "start", "end"]
        types = [pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * 4, pa.int64(), pa.int64()]
        for batch in batches:
            rows, seen = [], 0
            whole = batch.column(2)
            for own, words, bounds in _text_blocks([batch]):
                for k, id in enumerate(own.to_pylist()):
                    text = words[bounds[k] : bounds[k + 1]]
                    for c in whole[seen].as_py():
                        if c["passage"] not in ready:
                            if len(ready) >= 256:
                                ready.clear()
                            ready[c["passage"]] = _prepared(shared.value[c["passage"]])
                        item, size, masks, told, told_masks, rare, asked, answer = ready[c["passage"]]
                        lo, hi = max(0, c["start"] - size // 2), min(len(text), c["start"] + c["width"] + size // 2)
                        part = text[lo:hi].tolist()
                        lcs = common_subsequence(masks, size, part) / size
                        if lcs < 0.5:
                            continue
                        rare_lcs = common_subsequence(told_masks, told, [w for w in part if w in rare]) / max(told, 1)
                        said = common_subsequence(answer, asked, part) / asked if asked else 1.0
                        if rare_lcs < 0.5 or said < 0.5:
                            continue
                        rows.append((id, item, "copy" if lcs >= 0.9 else "paraphrase", lcs, rare_lcs, said, c["cosine"], lo, hi))
                    seen += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)

    spots = found.groupBy("id").agg(F.collect_list(F.struct("passage", "start", "width", "cosine")).alias("spots"))
    joined = join_small(docs, settle(spots, "spots"), "id", "inner").select("id", "text", "spots")
    return joined.mapInArrow(run, "id long, item_id long, kind string, lcs double, rare_lcs double, answer_lcs double, cosine double, start long, end long")


def _keys(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` words, by its first."""
    n = max(0, len(words) - size + 1)
    out = words[:n].copy()
    for k in range(1, size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : n + k]
    return out


def exact(docs: DataFrame, shorts: list[Passage]) -> DataFrame:
    """The rows of `verify` for short items whose words stand one after the other, the best place of each document."""
    by_size = []
    for size in sorted({len(p.words) for p in shorts}):
        chosen = [(_keys(p.words, size)[0], p.item, p.words, len(p.answer), _masks(p.answer.tolist())) for p in shorts if len(p.words) == size]
        known = np.unique(np.array([c[0] for c in chosen], np.uint64))
        by_size.append((size, Terms(known), [[c[1:] for c in chosen if c[0] == key] for key in known]))
    shared = docs.sparkSession.sparkContext.broadcast(by_size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "item_id", "kind", "lcs", "rare_lcs", "answer_lcs", "cosine", "start", "end"]
        types = [pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * 4, pa.int64(), pa.int64()]
        for own, words, bounds in _text_blocks(batches):
            best: dict[tuple[int, int], tuple[float, int, int]] = {}
            for size, known, items in shared.value:
                at, keys = known.find(_keys(words, size))
                rows = np.searchsorted(bounds, at, "right") - 1
                inside = at + size <= bounds[rows + 1]
                for place, key, row in zip(at[inside].tolist(), keys[inside].tolist(), rows[inside].tolist(), strict=True):
                    for item, wanted, asked, answer in items[key]:
                        if best.get((row, item), (0.0,))[0] == 1.0 or (words[place : place + size] != wanted).any():
                            continue
                        lo, hi = max(bounds[row], place - WINDOW), min(bounds[row + 1], place + size + WINDOW)
                        said = common_subsequence(answer, asked, words[lo:hi].tolist()) / asked if asked else 1.0
                        if said >= 0.5 and said > best.get((row, item), (0.0,))[0]:
                            best[row, item] = (said, place - int(bounds[row]), place - int(bounds[row]) + size)
            out = [(own[row].as_py(), item, "copy", 1.0, 1.0, said, None, lo, hi) for (row, item), (said, lo, hi) in best.items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], names)

    return docs.mapInArrow(run, "id long, item_id long, kind string, lcs double, rare_lcs double, answer_lcs double, cosine double, start long, end long")


def _blocks(benchmark: DataFrame, text: str, item: str, answer: str | None, size: int, min_words: int) -> Iterator[tuple[list[Passage], list[Passage]]]:
    """Blocks of passages and of short items."""
    block: list[Passage] = []
    short: list[Passage] = []
    columns = [F.col(item).cast("long").alias("item"), F.col(text).alias("text"), (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer")]
    known = benchmark.select(*columns).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    for r in known.orderBy("item", "text").toLocalIterator():
        words = hashes_of(r.text)
        if 0 < len(words) < min_words:
            short.append(Passage(r.item, words, hashes_of(r.answer or "")))
        else:
            block += passages_of(r.item, r.text, r.answer, min_words)
        if len(block) + len(short) >= size:
            yield block, short
            block, short = [], []
    if block or short:
        yield block, short


def _inform(passages: list[Passage], hashes: np.ndarray, frequency: np.ndarray, total: int, stop_share: float, rarest: int) -> np.ndarray:
    """Choose the passages' informative terms and number them in the block; returns the block's terms as places in `hashes`."""
    for p in passages:
        own = np.unique(np.searchsorted(hashes, p.words))
        order = own[np.argsort(frequency[own], kind="stable")]
        p.terms = order[(frequency[order] <= stop_share * total) | (np.arange(len(order)) < rarest)]
        p.rare = hashes[p.terms]
    known = np.unique(np.concatenate([p.terms for p in passages]))
    for p in passages:
        p.terms = np.searchsorted(known, p.terms)
    return known


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    item: str = "item_id",
    answer: str | None = None,
    item_text: str | None = None,
    block_items: int = 256,
    group_blocks: int = 8,
    min_words: int = 6,
    stop_share: float = 0.002,
    rarest: int = 8,
    share: float = 0.25,
    cosine: float = 0.4,
    enough: float = 0.9,
) -> DataFrame:
    """One row for each document and benchmark item that it holds: id, `item_id`, `kind` (copy or paraphrase), the shares of the
    passage's words, informative words and answer found in order, the cosine, and the region in words. The items' texts are in
    `item_text`, or in a column of the documents' name."""
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    schema = "id long, item_id long, kind string, lcs double, rare_lcs double, answer_lcs double, cosine double, start long, end long"
    out = docs.sparkSession.createDataFrame([], schema)
    blocks = _blocks(benchmark, item_text or text, item, answer, block_items, min_words)
    while group := list(islice(blocks, group_blocks)):
        shorts = [p for _, short in group for p in short]
        if shorts:
            out = out.unionByName(exact(rows, shorts))
        taken = [passages for passages, _ in group if passages]
        if not taken:
            continue
        hashes = np.unique(np.concatenate([p.words for passages in taken for p in passages]))
        frequency, total = passage_frequencies(rows, hashes)
        terms = [_inform(passages, hashes, frequency, total, stop_share, rarest) for passages in taken]
        known = np.unique(np.concatenate(terms))
        sieved = settle(sieve(rows, hashes[known], 2), "sieved")
        near, first = scratch(docs.sparkSession, "near"), 0
        for passages, own in zip(taken, terms, strict=True):
            numbers = None
            if len(own) < len(known):
                numbers = np.full(len(known), -1, np.int32)
                numbers[np.searchsorted(known, own)] = np.arange(len(own))
            idf = np.log((total + 1) / (frequency[own] + 1)) + 0.1
            space = latent_space(sieved, passages, idf, total, numbers)
            some = candidates(sieved, passages, idf, space, share, cosine, enough, numbers)
            some.withColumn("passage", F.col("passage") + F.lit(first)).write.mode("append").parquet(near)
            first += len(passages)
        found = docs.sparkSession.read.schema("id long, passage int, start long, width int, cosine double").parquet(near)
        out = out.unionByName(verify(rows, found, [p for passages in taken for p in passages]))
    best = F.max_by(F.struct("kind", "lcs", "rare_lcs", "answer_lcs", "cosine", "start", "end"), F.struct("lcs", "rare_lcs", "cosine", -F.col("start"))).alias("best")
    return out.groupBy(F.col("id").alias(id), "item_id").agg(best).select(id, "item_id", "best.*")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", id: str = "doc_id", **options) -> DataFrame:
    """`docs` without the documents that hold a benchmark item; rows without id stay. Of rows that repeat an id, those go whose
    text holds one."""
    # A hash of id and text instead of the id, which need not be unique; the row goes along as one column, so no name can clash.
    rows = docs.select(F.struct("*").alias("row"), F.when(F.col(id).isNotNull(), F.xxhash64(id, text)).alias("own_key"))
    texts = rows.select("own_key", F.col("row").getField(text).alias("own_text"))
    found = settle(find(texts, benchmark, "own_text", "own_key", item_text=text, **options).select("own_key").distinct(), "contaminated")
    return join_small(rows, found, "own_key", "left_anti").select("row.*")
