"""Exact ranked lexical search of many items at once, as a dual-tree search over items and documents.

Terms are runs of ASCII letters and digits and of everything beyond ASCII, only A-Z lower-cased. A document's score for an item is
the sum over the item's terms of weight times impact, both whole numbers (`weights`, `impacts`), so it is an inner product of
coordinates that are never negative.

The texts are read once for each block of items (`BLOCK_TERMS`, `BLOCK_ITEMS`; nearly always one) and reduced to the items' terms,
which are counted over all documents and stored. Then each task builds two hierarchies: one over some hundred items at a time and
one over a shard of documents, whose nodes hold the greatest coordinate of all below them. The inner product of two nodes bounds
every score of an item below the one and a document below the other. Where it lies below the weakest k-th score of the
node's items, the whole batch is left out; what remains is split further, and scored exactly at the leaves. k-th scores
of a bounded number of documents (`SEED`) are found first and shared with all tasks, which go on to raise their own.

Nothing is left out that could be in the result; an equal score is never pruned, since its smaller doc_id may win. Documents
that are NULL or empty have no term and count for nothing. Repeated documents are documents of their own; a NULL id is one too
and comes last among ties. Items that repeat id and text are one item, other texts of the same id are items of their own.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.best import NONE, Best
from tallyhouse.llm.text import BETWEEN, LOWER, hash_spans, row_blocks, rows_of, spans, utf8
from tallyhouse.session import scratch, settle

# Items of a block at most: their terms and their number; what a task holds of them.
BLOCK_TERMS = 1 << 20
BLOCK_ITEMS = 1 << 15
# Items under one hierarchy, documents in a shard and below a leaf, children of a node.
GROUP = 256
SHARD = 4096
LEAF = 16
FAN = 4
# Documents from which the first k-th scores come.
SEED = 8192
# Term occurrences that a shard may hold.
_SHARD_TERMS = 1 << 21
_EXACT = 2.0**52


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row its distinct term hashes, sorted, how often each stands there, where each row's begin, and all terms with repeats."""
    low = LOWER[data]
    starts, ends, bounds = spans(low, offsets, BETWEEN)
    terms, rows = hash_spans(low, starts, ends), rows_of(bounds)
    order = np.lexsort((terms, rows))
    terms, rows = terms[order], rows[order]
    new = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])][: len(terms)])
    counts = np.diff(np.append(new, len(terms)))
    return terms[new], counts, np.searchsorted(rows[new], np.arange(len(offsets))), np.diff(bounds)


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.binary())


def item_terms(items: DataFrame, id: str, text: str) -> DataFrame:
    """`item`, `terms` (hashes) and `counts` of every different item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            terms, counts, bounds, _ = term_counts(data, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), _cut(terms, bounds), _cut(counts.astype(np.int64), bounds)], ["item", "terms", "counts"])

    rows = items.select(F.col(id).cast("long").alias("item"), F.col(text).alias("text")).dropDuplicates()
    return rows.mapInArrow(run, "item long, terms binary, counts binary").where(F.length("terms") > 0)


class Items:
    """A block of items: ids, and for each the places of its terms in `vocabulary` and how often it has them."""

    def __init__(self, rows: list):
        self.known = np.array([r["item"] is not None for r in rows])
        self.ids = np.array([r["item"] or 0 for r in rows], np.int64)
        hashes = [np.frombuffer(bytes(r["terms"]), np.uint64) for r in rows]
        self.vocabulary = np.unique(np.concatenate(hashes))
        self.terms = [np.searchsorted(self.vocabulary, h) for h in hashes]
        self.counts = [np.frombuffer(bytes(r["counts"]), np.int64) for r in rows]
        self.weights = np.zeros(len(self.vocabulary), np.int64)
        self.mean = (0, 1)
        self.kth: np.ndarray | None = None

    def weigh(self, documents: int, occurrences: int, holding: np.ndarray) -> None:
        """`holding`: in how many documents each term stands."""
        self.weights = weights(documents, holding)
        self.mean = (documents, max(occurrences, 1))


def weights(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in holding.tolist()], np.int64)


def impacts(tf: np.ndarray, length: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    norm = 100 - 25 + (25 * length * documents) // occurrences
    return (1_000_000_000 * tf) // (1000 * tf + 12 * norm)


def reduce_texts(docs: DataFrame, items: Items) -> DataFrame:
    """A row (id, n, terms, tfs) for each document, with the terms of the items only, and from each task how many of its documents
    hold each term (term, holding)."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocabulary)  # at most BLOCK_TERMS

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        holding = np.zeros(len(vocabulary), np.int64)
        names = ["id", "n", "terms", "tfs", "term", "holding"]
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                terms, counts, bounds, n = term_counts(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                place = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                asked = vocabulary[place] == terms
                at = np.concatenate(([0], np.cumsum(asked)))[bounds]
                place = place[asked].astype(np.int32)
                holding += np.bincount(place, minlength=len(holding))
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(n), _cut(place, at), _cut(counts[asked].astype(np.int32), at), pa.nulls(hi - lo, pa.int32()), pa.nulls(hi - lo, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)
        held = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(held), t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())), pa.array(held.astype(np.int32)), pa.array(holding[held])], names)

    return docs.mapInArrow(run, "id long, n long, terms binary, tfs binary, term int, holding long")


class ItemTree:
    """A hierarchy over some items: level by level the greatest coordinates, in a table with a column for each of their terms."""

    def __init__(self, items: Items, members: np.ndarray):
        self.columns = np.unique(np.concatenate([items.terms[i] for i in members.tolist()]))
        rows = np.zeros((len(members), len(self.columns)))
        for row, i in enumerate(members.tolist()):
            rows[row, np.searchsorted(self.columns, items.terms[i])] = items.weights[items.terms[i]] * items.counts[i]
        order = self._ordered(rows, np.arange(len(members)))
        size = 1 << max(0, len(members) - 1).bit_length()
        # Items that fill the lowest level up have no coordinates and are never reached.
        self.members = np.append(members[order], np.full(size - len(members), -1))
        self.levels = [np.concatenate((rows[order], np.zeros((size - len(members), rows.shape[1]))))]
        while len(self.levels[0]) > 1:
            self.levels.insert(0, np.maximum(self.levels[0][0::2], self.levels[0][1::2]))

    def _ordered(self, rows: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Items that share much next to each other: split by likeness to the heaviest one, then each half again."""
        if len(chosen) <= 2:
            return chosen
        own = rows[chosen]
        near = own @ own[np.argmax(own.sum(axis=1))]
        chosen = chosen[np.argsort(-near, kind="stable")]
        half = 1 << (len(chosen) - 1).bit_length() - 1
        return np.concatenate((self._ordered(rows, chosen[:half]), self._ordered(rows, chosen[half:])))

    def weakest(self, best: Best) -> list[np.ndarray]:
        """Of each node the least k-th score of its items, 1 at least: a score of 0 is no result."""
        out = [np.where(self.members >= 0, np.maximum(best.kth[self.members], 1), np.iinfo(np.int64).max)]
        while len(out[0]) > 1:
            out.insert(0, np.minimum(out[0][0::2], out[0][1::2]))
        return out


class DocTree:
    """A hierarchy over a shard of documents, by their terms' impacts: a node's terms and the greatest impact of each below it."""

    def __init__(self, tree: ItemTree, ids: np.ndarray, known: np.ndarray, row: np.ndarray, column: np.ndarray, impact: np.ndarray):
        """`row`, `column`, `impact`: the coordinates of all documents, sorted by row."""
        # Documents that the same items may want lie together, the most promising first.
        coarse = tree.levels[min(4, len(tree.levels) - 1)]
        held, starts = np.unique(row, return_index=True)
        promise = np.add.reduceat(coarse[:, column] * impact, starts, axis=1)
        order = np.lexsort((-promise.max(axis=0), promise.argmax(axis=0)))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.ids, self.known = ids[held][order], known[held][order]
        place = np.repeat(rank, np.diff(np.append(starts, len(row))))
        wide = np.int64(len(tree.columns))
        by = np.argsort(place * wide + column, kind="stable")
        key, most = (place * wide + column)[by], impact[by].astype(np.float64)
        # The lowest level are the documents, above them leaves of LEAF, then nodes of FAN children each.
        self.levels = [(key // wide, key % wide, most)]
        node, col = key // wide // LEAF, key % wide
        while True:
            key = node * wide + col
            by = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]])
            most = np.maximum.reduceat(most[by], first)
            node, col = key[by][first] // wide, key[by][first] % wide
            self.levels.insert(0, (node, col, most))
            if node[-1] == 0:
                break
            node = node // FAN
        self.bounds = [np.searchsorted(node, np.arange(node[-1] + 2)) for node, _, _ in self.levels]

    def node(self, level: int, i: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.bounds[level][i], self.bounds[level][i + 1]
        _, col, most = self.levels[level]
        return col[lo:hi], most[lo:hi]

    def children(self, level: int, i: int) -> range:
        return range(i * FAN, min((i + 1) * FAN, len(self.bounds[level + 1]) - 1))


class Search:
    """One shard of documents against one group of items."""

    def __init__(self, tree: ItemTree, docs: DocTree, best: Best):
        self.tree, self.docs, self.best = tree, docs, best
        self.weak = tree.weakest(best)
        self.scored = 0

    def run(self) -> None:
        col, most = self.docs.node(0, 0)
        self.visit(0, 0, 0, np.zeros(1, np.int64), self.tree.levels[0][:, col] @ most)

    def open(self, level: int, nodes: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Which node pairs may still hold a result; a bound too large for exact sums is rounded up."""
        return nodes[np.where(bound < _EXACT, bound, bound * (1 + 1e-9)) >= self.weak[level][nodes]]

    def visit(self, doc_level: int, doc: int, item_level: int, nodes: np.ndarray, bound: np.ndarray) -> None:
        nodes = self.open(item_level, nodes, bound)
        if not len(nodes):
            return
        last = len(self.tree.levels) - 1
        if doc_level == len(self.docs.levels) - 2:
            col, most = self.docs.node(doc_level, doc)
            while item_level < last:
                item_level, nodes = item_level + 1, np.concatenate((2 * nodes, 2 * nodes + 1))
                nodes = self.open(item_level, nodes, self.tree.levels[item_level][nodes[:, None], col] @ most)
                if not len(nodes):
                    return
            self.score(doc, nodes)
            return
        if item_level < last:
            item_level, nodes = item_level + 1, np.concatenate((2 * nodes, 2 * nodes + 1))
        ahead = []
        for child in self.docs.children(doc_level, doc):
            col, most = self.docs.node(doc_level + 1, child)
            ahead.append((child, self.tree.levels[item_level][nodes[:, None], col] @ most))
        for child, bound in sorted(ahead, key=lambda x: -x[1].max()):
            self.visit(doc_level + 1, child, item_level, nodes, bound)

    def score(self, leaf: int, nodes: np.ndarray) -> None:
        """Items against the documents of a leaf."""
        place, col, impact = self.docs.levels[-1]
        lo, hi = leaf * LEAF, min((leaf + 1) * LEAF, len(self.docs.ids))
        a, b = self.docs.bounds[-1][lo], self.docs.bounds[-1][hi]
        used, at = np.unique(col[a:b], return_inverse=True)
        table = np.zeros((len(used), hi - lo))
        table[at, place[a:b] - lo] = impact[a:b]
        rows = self.tree.levels[-1][nodes[:, None], used]
        score = rows @ table
        if score.max(initial=0) >= _EXACT:
            score = rows.astype(np.int64) @ table.astype(np.int64)
        score = score.astype(np.int64)
        self.scored += score.size
        members = self.tree.members[nodes]
        item, doc = np.nonzero(score >= np.maximum(self.best.kth[members], 1)[:, None])
        if self.best.offer(members[item], score[item, doc], self.docs.ids[lo + doc], self.docs.known[lo + doc]):
            self.weak = self.tree.weakest(self.best)


def search(docs: DataFrame, items: Items, k: int) -> tuple[DataFrame, object]:
    """The `k` best documents of every task for each item, from stored (id, n, terms, tfs)."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = Best(len(items.ids), k, items.kth)
        groups = [np.arange(lo, min(lo + GROUP, len(items.ids))) for lo in range(0, len(items.ids), GROUP)]
        kept: dict[int, ItemTree] = {}  # where there is one group it is built once

        def shard(ids: pa.Array, n: np.ndarray, terms: list[bytes], tfs: list[bytes]) -> None:
            row = np.repeat(np.arange(len(terms)), [len(t) // 4 for t in terms])
            term, tf = (np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in (terms, tfs))
            impact = impacts(tf, n[row], *items.mean)
            known, number = np.asarray(ids.is_valid()), ids.fill_null(0).to_numpy(zero_copy_only=False)
            for g, members in enumerate(groups):
                tree = kept.get(g) or ItemTree(items, members)
                if len(groups) == 1:
                    kept[g] = tree
                place = np.minimum(np.searchsorted(tree.columns, term), len(tree.columns) - 1)
                own = (tree.columns[place] == term) & (impact > 0)
                if own.any():
                    Search(tree, DocTree(tree, number, known, row[own], place[own], impact[own]), best).run()

        for batch in batches:
            size = np.array([len(x) for x in batch.column(2).to_pylist()], np.int64)
            for lo, hi in row_blocks(np.concatenate(([0], np.cumsum(size))), 4 * _SHARD_TERMS):
                for at in range(lo, hi, SHARD):
                    part = batch.slice(at, min(SHARD, hi - at))
                    shard(part.column(0), part.column(1).to_numpy(), part.column(2).to_pylist(), part.column(3).to_pylist())
        item, score, id, known = best.held()
        columns = [pa.array(item.astype(np.int32)), pa.array(items.ids[item], mask=~items.known[item]), pa.array(score), pa.array(id, mask=~known)]
        yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "score", "doc_id"])

    return docs.mapInArrow(run, "item int, item_id long, score long, doc_id long"), shared


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search_block(docs: DataFrame, items: Items, k: int, path: str) -> None:
    """Rank all documents for one block of items and append the result."""
    reduced = settle(reduce_texts(docs, items), "search-terms")
    rows = reduced.where("term IS NULL")
    documents, occurrences = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = reduced.where("term IS NOT NULL").groupBy("term").agg(F.sum("holding").alias("holding")).toArrow()  # at most BLOCK_TERMS
    holding = np.zeros(len(items.vocabulary), np.int64)
    holding[held["term"].to_numpy()] = held["holding"].to_numpy()
    items.weigh(documents, occurrences, holding)
    rows = rows.where(F.length("terms") > 0).select("id", "n", "terms", "tfs")
    # Any documents give a lower limit of the k-th scores; a few thousand are enough to begin with.
    few = rows.where(F.pmod(F.xxhash64("id", "terms"), F.lit(max(1, documents // SEED))) == 0).limit(SEED)
    first, shared = search(few, items, k)
    seeds = _ranked(first, k).where(F.col("rank") == k).select("item", "score").collect()  # one row an item
    shared.destroy()
    items.kth = np.full(len(items.ids), NONE, np.int64)
    for r in seeds:
        items.kth[r["item"]] = r["score"]
    found, shared = search(rows, items, k)
    _ranked(found, k).select("item_id", "rank", "doc_id", "score").write.mode("append").parquet(path)
    shared.destroy()


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """`item_id`, `rank`, `doc_id`, `score`: the `k` documents of highest score above 0 for every item, equal scores by doc_id."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    asked = settle(item_terms(items, item_id, item_text), "search-items")
    terms, count = asked.agg(F.coalesce(F.sum(F.length("terms") / 8), F.lit(0)), F.count("*")).first()
    blocks = max(math.ceil(terms / block_terms), math.ceil(count / block_items))
    path = scratch(spark, "search-found")
    written = False
    for number in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)) == number).orderBy("item", "terms").collect()  # one block
        if block:
            search_block(rows, Items(block), k, path)
            written = True
    out = "item_id long, rank int, doc_id long, score long"
    return spark.read.schema(out).parquet(path) if written else spark.createDataFrame([], out)
