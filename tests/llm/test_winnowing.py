"""Marks against a plain loop, the match guarantee, and rows next to their successors."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import order, winnowing

from .conftest import ODD


def brute(text, k, w):
    if not text:
        return []
    hashes = []
    for i in range(len(text) - k + 1):
        x = 0
        for c in text[i : i + k]:
            x = (x * winnowing._BASE + int(winnowing.mix(np.array([ord(c) + 1], np.uint64))[0])) % (1 << 64)
        hashes.append(int(winnowing.mix(np.array([x], np.uint64))[0]) >> 32)
    out = []
    for s in range(max(1, len(hashes) - w + 1)):
        window = hashes[s : s + w]
        at = s + max(i for i, v in enumerate(window) if v == min(window))
        if not out or out[-1] != (hashes[at], at):
            out.append((hashes[at], at))
    return out


@pytest.mark.parametrize(("k", "w"), [(4, 5), (5, 3), (16, 48), (3, 1), (1, 2)])
def test_marks(k, w):
    random.seed(2)
    texts = ["".join(random.choice("abñ") for _ in range(random.randint(0, 90))) for _ in range(40)]
    marks, places, at = winnowing.winnow(texts, k, w)
    for i, text in enumerate(texts):
        got = list(zip(marks[at[i] : at[i + 1]].tolist(), places[at[i] : at[i + 1]].tolist(), strict=True))
        if 0 < len(text) < k:
            assert len(got) == 1
        else:
            assert got == brute(text, k, w)


def test_shared_runs_share_a_mark():
    random.seed(3)
    letters = "abcdefghij é"
    for _ in range(60):
        run = "".join(random.choice(letters) for _ in range(winnowing.K + winnowing.W - 1))
        texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 300))) + run + "".join(random.choice(letters) for _ in range(random.randint(0, 300))) for _ in range(2)]
        marks, _, at = winnowing.winnow(texts)
        assert set(marks[: at[1]].tolist()) & set(marks[at[1] :].tolist())


def jaccard(a, b):
    marks, _, at = winnowing.winnow([a, b])
    x, y = set(marks[: at[1]].tolist()), set(marks[at[1] :].tolist())
    return len(x & y) / len(x | y) if x | y else 1.0


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_next_rows(table, partitions):
    random.seed(4)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "ñandú"]
    texts = {i * 3: random.choice([None, "", " ".join(random.choice(words) for _ in range(random.randint(1, 80)))]) for i in range(40)}
    rows = {r.doc_id: r for r in winnowing.against_next(table(texts.items()), partitions=partitions).collect()}
    order = sorted(texts, reverse=True)
    assert len(rows) == len(order)
    for k, i in enumerate(order):
        text, following = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        changed = winnowing.edited(text, following)
        r = rows[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(text, changed)) and r.near_next == pytest.approx(jaccard(text, following))
        assert (r.fingerprint == r.edited_fingerprint) or text != changed


def test_odd_rows(odd, spark):
    rows = winnowing.against_next(odd).collect()
    assert len(rows) == len(ODD)
    same = {r.fingerprint for r in rows if r.doc_id in (3, 4)}
    assert len(same) == 1 and next(r for r in rows if r.doc_id == 2).fingerprint == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    # Equal ids follow each other by text: the twin of 4 is as like as can be.
    assert max(r.near_next for r in rows if r.doc_id == 4) == 1.0


@pytest.mark.parametrize("hot", [12, None, 2**62])
def test_hot_ids(table, hot):
    """A third of the rows have one id or none, and a third of all rows are equal: no task holds them, and every row has a successor."""
    random.seed(5)
    rows = [(k, f"row {k} " + "lorem ipsum " * (k % 9)) for k in range(400)]
    rows += [(hot, f"other {k} " + "dolor sit amet " * (k % 7)) for k in range(400)]
    rows += [(77, "the very same row, word by word")] * 2500 + [(2**62 + 1, "x"), (-(2**62), "y" * 80)]
    random.shuffle(rows)
    df = table(rows)
    runs, repeats = order.descending_runs(df, "doc_id", "text", 8)
    sizes = [r["count"] for r in runs.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 250 and sum(r.copies for r in repeats.collect()) == 2499
    placed = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = winnowing.against_next(df, partitions=8).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    # Within an id the order is that of hashes; what a row's edited text ends in says who follows.
    marks = dict(df.select("text", F.xxhash64("text")).distinct().collect())
    placed.sort(key=lambda r: (r[0] is None, -(r[0] or 0), marks[r[1]], r[1]))
    following = [*placed[1:], placed[0]]
    want = sorted((str(a[0]), hashlib.sha256(winnowing.edited(a[1], b[1]).encode()).hexdigest()) for a, b in zip(placed, following, strict=True))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == want


def test_one_row_follows_itself(table):
    (r,) = winnowing.against_next(table([(9, "abcdef")])).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_fingerprints_keep_positions(odd):
    for r in winnowing.fingerprints(odd).collect():
        assert len(r.marks) == len(r.positions) and r.positions == sorted(r.positions)


def test_nothing(nothing):
    assert winnowing.against_next(nothing).collect() == [] and winnowing.fingerprints(nothing).collect() == []
