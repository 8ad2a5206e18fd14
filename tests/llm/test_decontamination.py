"""Planted benchmark items, whole and reworded, against clean documents."""

import random

import numpy as np
import pytest

from tallyhouse.llm import decontamination as dc

from .conftest import ODD

COMMON = "the of and to in that it is was for on with as at by".split()


def word(rng):
    return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(2, 4)))


def sentence(rng, n, rare):
    return " ".join(rng.choice(COMMON) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(9)
    rare = [word(rng) for _ in range(20_000)]
    items = [(k, sentence(rng, rng.randint(14, 40), rare) + ". " + sentence(rng, rng.randint(6, 15), rare) + ".") for k in range(30)]
    docs = [[k, sentence(rng, rng.randint(20, 400), rare)] for k in range(400)]
    planted = {}
    for n, share in enumerate([0, 0, 0.1, 0.1, 0.2, 0.2]):
        for j in range(10):
            k, (item, text) = n * 40 + j * 3, items[(n * 7 + j) % 30]
            words = [rng.choice(["some", "other", "words"]) if rng.random() < share else w for w in text.split()]
            body = docs[k][1].split()
            at = rng.randrange(len(body))
            docs[k][1] = " ".join(body[:at] + words + body[at:])
            planted[k, item] = share
    return items, [tuple(d) for d in docs], planted


@pytest.mark.parametrize("block", [256, 7])
def test_planted_items_are_found_and_clean_documents_are_not(spark, table, corpus, block):
    items, docs, planted = corpus
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find(table(docs), benchmark, block_items=block).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert {p for p, share in planted.items() if share == 0} <= got
    assert np.mean([p in got for p in planted]) >= 0.9
    assert not got - set(planted)
    assert {r.kind for r in found if planted[r.doc_id, r.item_id] == 0} == {"copy"}
    left = dc.clean(table(docs), benchmark, block_items=block)
    assert left.columns == table(docs).columns and {r.doc_id for r in left.collect()} == {d[0] for d in docs} - {k for k, _ in got}


def test_groups_of_blocks_change_nothing(spark, table, corpus, monkeypatch):
    """Texts are counted and sieved once a group; every column is as with each block on its own."""
    items, docs, _ = corpus
    benchmark = spark.createDataFrame([*items, (90, "zebra quagga"), (91, docs[399][1].split()[0])], "item_id long, text string")
    sieves, real = [], dc.sieve
    monkeypatch.setattr(dc, "sieve", lambda *a: (sieves.append(1), real(*a))[1])
    alone = sorted(map(tuple, dc.find(table(docs), benchmark, block_items=11, group_blocks=1).collect()), key=str)
    apart = len(sieves)
    together = sorted(map(tuple, dc.find(table(docs), benchmark, block_items=11, group_blocks=8).collect()), key=str)
    assert together == alone and any(r[1] == 91 for r in together) and apart == 3 and len(sieves) == apart + 1


def test_candidate_search_finds_what_brute_force_finds(spark, table, corpus):
    """Recall of the latent search against all pairs by the exact subsequence."""
    items, docs, planted = corpus
    got = {(r.doc_id, r.item_id) for r in dc.find(table(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    passages = [p for item, text in items for p in dc.passages_of(item, text, None, 6)]
    masks = [dc._masks(p.words.tolist()) for p in passages]
    for k, text in docs:
        words = dc.hashes_of(text).tolist()
        for p, m in zip(passages, masks, strict=True):
            if any(dc.common_subsequence(m, len(p.words), words[s : s + 96]) / len(p.words) >= 0.8 for s in range(0, len(words), 16)):
                want.add((k, p.item))
    assert want and len(want & got) / len(want) >= 0.9


def test_common_subsequence():
    rng = random.Random(3)

    def brute(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 20))] for _ in range(2))
        assert dc.common_subsequence(dc._masks(a), len(a), b) == brute(a, b)


def test_latent_space_spans_the_leading_vectors(spark, table, corpus):
    """The randomised SVD against numpy's on the whole matrix."""
    items, docs, _ = corpus
    rows = table(docs).selectExpr("doc_id AS id", "text")
    passages = [p for item, text in items for p in dc.passages_of(item, text, None, 6)]
    hashes = np.unique(np.concatenate([p.words for p in passages]))
    for p in passages:
        p.terms = np.unique(np.searchsorted(hashes, p.words))
    frequency, total = dc.passage_frequencies(rows, hashes)
    assert total == sum(-(-len(d[1].split()) // dc.WINDOW) for d in docs)
    idf = np.log((total + 1) / (frequency + 1)) + 0.1
    space = dc.latent_space(dc.sieve(rows, hashes, 1), passages, idf, total)
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-5)
    owner = np.repeat(np.arange(len(passages)), [len(p.terms) for p in passages])
    t, v, at = dc._rows_of_matrix(owner, np.concatenate([p.terms for p in passages]), idf)
    a = np.zeros((len(passages), len(idf)))
    a[np.repeat(np.arange(len(passages)), np.diff(at)), t] = v
    # The benchmark's passages lie in the space.
    assert np.linalg.norm(a - a @ space @ space.T, axis=1).max() < 0.05


def test_odd_rows(spark, odd, nothing):
    benchmark = spark.createDataFrame([(1, "a benchmark item with several words of its own. And its answer."), (2, None), (3, ""), (None, "an item without a number but with words"), (4, "too short")], "item_id long, text string")
    assert dc.find(odd, benchmark).collect() == []
    assert dc.clean(odd, benchmark).count() == len(ODD)
    assert dc.find(nothing, benchmark).collect() == [] and dc.clean(nothing, benchmark).collect() == []
    assert dc.find(odd, benchmark.limit(0)).collect() == [] and dc.clean(odd, benchmark.limit(0)).count() == len(ODD)


def test_a_row_that_is_repeated_is_reported_once(spark, table):
    text = "seven quick zebras jumped over lazy purple dogs near the old mill. They answered quietly at dawn."
    docs = table([(1, f"intro {text} outro"), (1, f"intro {text} outro"), (2, "nothing of the kind is in here at all"), (None, text)])
    found = dc.find(docs, spark.createDataFrame([(5, text)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.kind) for r in found] == [(1, 5, "copy")]
    assert sorted(str(r.doc_id) for r in dc.clean(docs, spark.createDataFrame([(5, text)], "item_id long, text string")).collect()) == ["2", "None"]


@pytest.mark.parametrize("size", [6, 8, 12, 20])
def test_short_items_listed_back_to_back(spark, table, corpus, size):
    rng = random.Random(size)
    rare = [word(rng) for _ in range(2_000)]
    items = [(k, sentence(rng, size, rare)) for k in range(48)]
    lists = [(1000 + k, " ".join(text for _, text in items[k : k + 12])) for k in range(0, 48, 12)]
    found = dc.find(table(corpus[1] + lists), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(1000 + k - k % 12, k) for k in range(48)}
    got = {(r.doc_id, r.item_id) for r in found if r.kind == "copy"}
    assert len(want & got) / len(want) >= 0.98


@pytest.mark.parametrize("block", [256, 1])
def test_items_of_few_words(spark, table, block):
    items = [(1, "Who wrote the blue book?", "Ann Bell"), (2, "capital of Freeland", None), (3, "Zyx", None), (4, "", None), (5, "...", None), (6, "same same", None), (7, "a much longer item that has enough words for the other search", None)]
    docs = [
        (1, "quiz: who wrote, the BLUE book -- it was ann bell of course"),
        (2, "who wrote the blue book is not known"),
        (3, "who wrote the old blue book, ann bell asked"),
        (4, "the capital"),
        (5, "of freeland and zyx; capital of freeland capital of freeland"),
        (6, "same"),
        (7, "same same same"),
        (8, None),
        (None, "zyx"),
        (9, " ".join(["filler"] * 500) + " who wrote the blue book " + " ".join(["filler"] * 500) + " ann bell who wrote the blue book"),
    ]
    benchmark = spark.createDataFrame(items, "item_id long, text string, answer string")
    found = dc.find(table(docs), benchmark, answer="answer", block_items=block).collect()
    assert {(r.doc_id, r.item_id, r.kind, r.start, r.end) for r in found} == {(1, 1, "copy", 1, 6), (5, 2, "copy", 4, 7), (5, 3, "copy", 3, 4), (7, 6, "copy", 0, 2), (9, 1, "copy", 1007, 1012)}
    assert len(found) == 5 and all(r.lcs == 1.0 and r.cosine is None for r in found)
    # Without the answers their words need not be there.
    assert {r.doc_id for r in dc.find(table(docs), benchmark, block_items=block).where("item_id = 1").collect()} == {1, 2, 9}
    assert {r.doc_id for r in dc.clean(table(docs), benchmark, answer="answer").collect()} == {None, 2, 3, 4, 6, 8}


def test_a_repeated_id_goes_only_where_its_text_holds_an_item(spark, table):
    item = "seven quick zebras jumped over lazy purple dogs near the old mill. They answered quietly at dawn."
    docs = table([(1, f"intro {item} outro"), (1, "a clean text of the same number"), (2, "nothing of the kind is in here at all")])
    left = dc.clean(docs, spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert left.columns == docs.columns and sorted((r.doc_id, r.text[:7]) for r in left.collect()) == [(1, "a clean"), (2, "nothing")]


def test_columns_of_internal_names_come_back(spark, table):
    df = table([(1, "nothing of any interest stands here at all"), (2, None), (1, "one two three four five six seven eight nine ten")])
    items = spark.createDataFrame([(5, "one two three four five six seven eight nine ten")], "item_id long, text string")
    kept = dc.clean(df, items)
    assert kept.columns == df.columns and sorted((r.doc_id, r.own_key, r.row) for r in kept.collect()) == [(1, "keep-1", "r"), (2, "keep-2", "r")]
