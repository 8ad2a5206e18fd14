"""Vector and ranked search against plain loops over everything."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import ranked_search, vector_search
from tallyhouse.llm.best import NONE, Best

from .conftest import LONG

VECTORS = "vec_id long, embedding array<float>, query_id long, score string, part int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x", 9) for i, v in rows], VECTORS)


def brute_vectors(rows, k, divisor=50):
    whole = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, v) in enumerate(whole):
        if i is not None and i % divisor == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), j is None, j or 0) for b, (j, w) in enumerate(whole) if b != a)
            out += [(i, rank + 1, None if gone else j, -s) for rank, (s, gone, j) in enumerate(scored[:k])]
    return sorted(out, key=str)


def found_vectors(df, k=5, **more):
    out = vector_search.top_k(df, F.col("id") % 50 == 0, k, **more)
    return sorted((tuple(r) for r in out.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_best_keeps_the_k_highest():
    rng = np.random.default_rng(1)
    best, seen = Best(7, 3), []
    for _ in range(40):
        n = int(rng.integers(0, 30))
        query, score, id, known = rng.integers(0, 7, n), rng.integers(-5, 6, n), rng.integers(0, 40, n), rng.random(n) > 0.2
        seen += zip(query.tolist(), score.tolist(), id.tolist(), known.tolist(), strict=True)
        best.offer(query, score, id, known)
    for q in range(7):
        full = sorted((-s, not known, i) for x, s, i, known in seen if x == q)[:3]
        assert [(-best.score[q, j], not best.known[q, j], best.id[q, j]) for j in range(3)] == full
    assert Best(1, 2, np.array([9])).offer(np.array([0]), np.array([8]), np.array([1]), np.array([True])) is False


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 700])
def test_ball_tree_holds_every_vector(n):
    points = np.random.default_rng(n).integers(-50, 50, (n, 6))
    order, middles, radii = vector_search.ball_tree(points)
    assert sorted(order.tolist()) == list(range(n))
    node = 0
    for level in range(vector_search.depth(n) + 1):
        at = vector_search.edges(n, level)
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            assert 0 < hi - lo
            assert np.sqrt(((points[order[lo:hi]] - middles[node]) ** 2).sum(axis=1)).max() <= radii[node] + 1e-9
            node += 1
    assert node == len(radii)


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(vector_search, "SHARD", 60)
    monkeypatch.setattr(vector_search, "LEAF", 8)


def clustered(n, dim, seed):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(9, dim))
    rows = heads[rng.integers(0, 9, n)] + 0.2 * rng.normal(size=(n, dim))
    return [(i, [float(x) for x in row]) for i, row in enumerate(rows)]


def test_vector_search(spark, small_shards):
    rows = clustered(900, 12, 1)
    df = vectors(spark, rows)
    expected = brute_vectors(rows, 5)
    assert found_vectors(df) == expected
    # Several waves.
    assert found_vectors(df, wave_bytes=12 * 8 * 4) == expected


def test_vector_search_leaves_work_out():
    points = np.floor(256 * np.array([v for _, v in clustered(2000, 12, 2)])).astype(np.int64)
    order, middles, radii = vector_search.ball_tree(points)
    group = {"part": 0, "n": 2000, "dim": 12, "width": 8, "ids": np.arange(2000)[order].tobytes(), "known": np.ones(2000, bool).tobytes(), "copies": np.ones(2000, np.int64).tobytes()}
    shard = vector_search.Shard({**group, "vectors": points[order].tobytes(), "centres": middles.tobytes(), "radii": radii.tobytes()}, 12)

    class Row:
        def __init__(self, i):
            self.id, self.copies, self.part, self.vec = i, 1, 0, points[i].tobytes()

    wave = vector_search.Wave([Row(i) for i in range(0, 2000, 50)])
    best = Best(40, 5)
    seen = vector_search.search_shard(wave, np.arange(40), shard, best)
    assert seen < 0.6 * 40 * 2000
    for q in range(40):
        full = points @ points[q * 50]
        assert best.score[q].tolist() == sorted(np.delete(full, q * 50).tolist(), reverse=True)[:5]


def test_vector_search_odd_rows(spark, small_shards):
    inf, nan = float("inf"), float("nan")
    rows = clustered(120, 3, 3)
    rows += [(200, None), (201, [1.0, None, 2.0]), (202, [inf, 0.0, 0.0]), (203, [nan, 0.0, 0.0]), (250, [nan, 1.0, 1.0])]
    # Repeated rows, one id with two vectors, NULL ids, no components, fewer and more of them, a group of equal vectors.
    rows += [(300, [0.5, 0.5, 0.5])] * 3 + [(350, [0.1, 0.2, 0.3]), (350, [0.3, 0.2, 0.1]), (None, [2.0, 2.0, 2.0]), (None, [2.0, 2.0, 2.0])]
    rows += [(400, []), (450, [1.0]), (451, [1.0, 1.0, 1.0, 1.0])] + [(500 + i, [0.7, 0.1, -0.2]) for i in range(90)] + [(700, [0.7, 0.1, -0.2])] * 80
    assert found_vectors(vectors(spark, rows)) == brute_vectors(rows, 5)


def test_vector_search_large_components(spark):
    rows = [(0, [1e30, -1e30]), (1, [1e30, 1e30]), (2, [3e12, 1.0]), (50, [3e12, 2.0]), (4, [-3e12, 1.0])]
    got = {(q, v): s for q, _, v, s in found_vectors(vectors(spark, rows))}
    assert got[50, 2] == 2**63 - 1 and got[50, 4] == -(2**63 - 1) and got[0, 4] == -(2**63 - 1)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0])], [(1, [1.0]), (2, [2.0])]])
def test_vector_search_few_rows(spark, rows):
    assert found_vectors(vectors(spark, rows)) == brute_vectors(rows, 5)


# -- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_ranks(docs, items, k=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c, n in held:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, rank + 1, None if gone else doc, -s) for rank, (s, gone, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found_ranks(docs, items, **more):
    out = ranked_search.top_documents(docs, items, **more)
    return sorted((tuple(r) for r in out.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [[f"{'abcd'[g]}{k}" for k in range(60)] for g in range(4)]
    docs = []
    for i in range(n):
        own = words[rng.randrange(4)]
        docs.append((i, " ".join(own[min(59, int(rng.expovariate(0.08)))] for _ in range(rng.randint(1, 60)))))
    items = [(i, " ".join(rng.choices(words[rng.randrange(4)], k=rng.randint(1, 15)))) for i in range(30)]
    return docs, items


def item_table(spark, rows):
    return spark.createDataFrame([(i, t, 3, "x") for i, t in rows], "item_id long, text string, doc_id long, score string")


@pytest.fixture
def small_trees(monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD", 70)
    monkeypatch.setattr(ranked_search, "LEAF", 4)
    monkeypatch.setattr(ranked_search, "GROUP", 8)
    monkeypatch.setattr(ranked_search, "SEED", 50)


def test_ranked_search(spark, table, small_trees):
    docs, items = corpus(500, 1)
    expected = brute_ranks(docs, items, 5)
    assert found_ranks(table(docs), item_table(spark, items), k=5) == expected
    # Several blocks of items, so several passes.
    assert found_ranks(table(docs), item_table(spark, items), k=5, block_items=11) == expected
    assert found_ranks(table(docs), item_table(spark, items), k=5, block_terms=70) == expected


def test_ranked_search_leaves_work_out():
    docs, items = corpus(3000, 2)
    vocabulary = sorted({t for _, text in docs + items for t in terms(text)})
    place = {t: np.uint64(i) for i, t in enumerate(vocabulary)}
    rows = []
    for i, text in items:
        c = Counter(terms(text))
        at = sorted((place[t], n) for t, n in c.items())
        rows.append({"item": i, "terms": np.array([t for t, _ in at], np.uint64).tobytes(), "counts": np.array([n for _, n in at], np.int64).tobytes()})
    block = ranked_search.Items(rows)
    held = [Counter(terms(t)) for _, t in docs]
    df = Counter(t for c in held for t in c)
    block.weigh(len(docs), sum(sum(c.values()) for c in held), np.array([df[vocabulary[int(h)]] for h in block.vocabulary]))
    tree = ranked_search.ItemTree(block, np.arange(len(items)))
    number = {int(h): i for i, h in enumerate(block.vocabulary)}
    row, col, tf, n = [], [], [], []
    for d, c in enumerate(held):
        for at, count in sorted((number[int(place[t])], count) for t, count in c.items() if int(place[t]) in number):
            row.append(d), col.append(at), tf.append(count), n.append(sum(c.values()))
    impact = ranked_search.impacts(np.array(tf), np.array(n), *block.mean)
    best = Best(len(items), 5)
    run = ranked_search.Search(tree, ranked_search.DocTree(tree, np.arange(len(docs)), np.ones(len(docs), bool), np.array(row), np.array(col), impact), best)
    run.run()
    assert run.scored < 0.5 * len(docs) * len(items)
    got = sorted((items[q][0], r + 1, int(best.id[q, r]), int(best.score[q, r])) for q in range(len(items)) for r in range(5) if best.score[q, r] != NONE)
    assert got == sorted(brute_ranks(docs, items, 5))


def test_ranked_search_odd_rows(spark, table, small_trees):
    docs, items = corpus(60, 3)
    docs += [(900, None), (901, ""), (902, " \n-"), (903, LONG), (None, "a1 a2 a3"), (None, "a1 a2 a3"), (904, "A1 É1 é1 ÀB 中文_x 7"), (1, docs[1][1]), (1, docs[1][1])]
    docs += [(1000 + i, "b1 b2 b3 same words") for i in range(100)]
    items += [(None, "a1 a2"), (70, None), (71, ""), (72, "nowhere at all"), (5, "b2 b2 b2 b3"), (5, "b2 b2 b2 b3"), (5, "c1"), (73, "É1 àb é1 7 7"), (74, LONG), (75, "same words"), (76, "a1. A1, (a1)")]
    assert found_ranks(table(docs), item_table(spark, items)) == brute_ranks(docs, items)


def test_ranked_search_nothing(spark, table, nothing):
    docs, items = corpus(5, 4)
    assert found_ranks(nothing, item_table(spark, items)) == []
    assert found_ranks(table(docs), item_table(spark, [])) == []
    assert found_ranks(table([(1, None)]), item_table(spark, items)) == []
