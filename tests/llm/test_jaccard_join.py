"""Components of near copies against all pairs."""

import collections
import random
import re

import pytest

from tallyhouse.llm import jaccard_join
from tallyhouse.llm.components import components


def brute(docs):
    sets = {}
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = collections.defaultdict(list)
    for i in sorted(sets):
        for j, n in collections.Counter(j for s in sets[i] for j in lists[s]).items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            lists[s].append(i)
    return {i: (len(sets[i]), root(i)) for i in sets}


def near_copies(seed, n, sizes):
    random.seed(seed)
    words = [f"w{k}" for k in range(40)]
    docs = []
    while len(docs) < n:
        base = [random.choice(words) for _ in range(random.choice(sizes))]
        for _ in range(random.choice([1, 1, 2, 3, 8, 40])):
            share = random.choice([0, 0.0, 0.01, 0.03, 0.05])
            text = [random.choice(words) if random.random() < share else w for w in base]
            if random.random() < 0.3:
                text = text[random.randint(0, 2) :]
            docs.append((len(docs) * 7 % 100_003, " ".join(text).upper() if random.random() < 0.2 else " ".join(text)))
    return docs


@pytest.mark.parametrize(("seed", "sizes"), [(5, [0, 1, 3, 5, 6, 7, 8, 9, 10, 11, 12, 14, 20, 40, 100]), (6, [6, 7, 8, 9, 10, 11])])
def test_components(table, seed, sizes):
    docs = near_copies(seed, 500, sizes)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(table(docs)).collect()}
    assert got == brute(docs)


def test_chains_and_groups_without_a_common_hub(table):
    """Neighbours link, others don't: the hub of a list reaches only some of it, the rest is paired in full."""
    words = [f"v{k}" for k in range(400)]
    docs = [(k, " ".join(words[3 * k : 3 * k + 40])) for k in range(90)]
    want = brute(docs)
    assert len({c for _, c in want.values()}) < 5
    for turns in (0, 1, 4):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join(table(docs), turns=turns).collect()}
        assert got == want


def test_boundary_follows_the_cost():
    assert jaccard_join.choose_boundary({}) == 0
    few, many = jaccard_join.choose_boundary({40: 1000, 12: 5}), jaccard_join.choose_boundary({3: 1000, 40: 10})
    assert few <= 12 and many >= 3
    assert jaccard_join.subset_sizes(4, 12) == [3, 4] and jaccard_join.subset_sizes(4, 4) == [3]


def test_odd_rows(odd):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(odd).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 5, 3), (4, 5, 3), (6, 0, 6), (7, 1, 7)} <= got
    assert jaccard_join.join(odd).count() == odd.count()
    kept = sorted((r.doc_id for r in jaccard_join.deduplicate(odd).collect()), key=str)
    assert kept == sorted([1, 2, 3, 5, 6, 7, 8, None], key=str)


def test_repeated_ids_without_a_group(table):
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (1, "other words stand in this one row"), (2, None)]
    kept = sorted((r.doc_id, r.text or "") for r in jaccard_join.deduplicate(table(rows)).collect())
    assert kept == [(1, rows[0][1]), (1, rows[2][1]), (2, "")]


def test_nothing(nothing):
    assert jaccard_join.join(nothing).collect() == [] and jaccard_join.deduplicate(nothing).collect() == []


def test_stars(spark):
    random.seed(8)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(500, 499), (500, 500)] + [(random.randint(1000, 1100), random.randint(1000, 1100)) for _ in range(60)]
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {k: got.get(k, k) for k in parent} == {k: root(k) for k in parent}


def test_a_repeated_id_goes_only_where_its_text_is_a_copy(table):
    first, second, third = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    near = " ".join(second.split()[:-1])
    rows = [(1, first), (5, first), (5, second), (5, second), (6, near), (7, third), (7, third + " end"), (8, None), (8, ""), (None, first)]
    left = sorted((str(r.doc_id), r.text) for r in jaccard_join.deduplicate(table(rows)).collect() if r.doc_id not in (7, 8))
    assert left == sorted([("1", first), ("5", second), ("None", first)])
    kept = [r.doc_id for r in jaccard_join.deduplicate(table(rows)).collect()]
    assert kept.count(7) == 1 and kept.count(8) == 2


def test_columns_of_internal_names_come_back(table):
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    for rows in ([(1, a), (2, a), (3, b)], [(1, a), (1, b), (2, a), (3, None)]):
        df = table(rows)
        kept = jaccard_join.deduplicate(df)
        assert kept.columns == df.columns
        assert all(r.own_key == f"keep-{r.doc_id}" and r.row == "r" and r.set == 4 for r in kept.collect())


def test_copies_of_one_text_fill_no_list(table, monkeypatch):
    """A third of all rows hold one text; a task lists its set once."""
    hot = " ".join(f"h{k}" for k in range(60))
    rows = [(k, hot if k % 3 == 0 else " ".join(f"w{random.Random(k).randint(0, 400)}" for _ in range(30))) for k in range(1500)]
    df = table(rows).coalesce(4)
    docs = df.select("doc_id", "text")
    counted = jaccard_join.count_pass(docs.selectExpr("doc_id AS id", "text"))
    postings, _ = jaccard_join.posting_pass(docs, jaccard_join.collect_counters(counted), 0, 256)
    most = postings.groupBy("deal", "key").count().agg({"count": "max"}).first()[0]
    assert most <= 4 + 40
    got = {r.doc_id: r.component_id for r in jaccard_join.join(df).collect()}
    assert {got[k] for k in range(0, 1500, 3)} == {0}
    monkeypatch.setattr(jaccard_join, "REMEMBERED", 5)
    assert {r.doc_id: r.component_id for r in jaccard_join.join(df).collect()} == got


def test_components_are_contracted(spark):
    random.seed(3)
    found, all_links = jaccard_join.Found(spark), []
    for _ in range(4):
        links = [(random.randint(1, 80), random.randint(1, 80)) for _ in range(18)]
        all_links += links
        found.link(spark.createDataFrame(links, "a long, b long"))
    whole = {r.node: r.component for r in components(spark.createDataFrame(all_links, "a long, b long")).collect()}
    got = {r.node: r.component for r in found.labels.collect()}
    nodes = {x for pair in all_links for x in pair}
    assert {n: got.get(n, n) for n in nodes} == {n: whole.get(n, n) for n in nodes}
