"""Learned scores: held-out accuracy, the models' parts against plain arithmetic, and odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tallyhouse.llm import langid, learning, quality, toxicity
from tallyhouse.llm.text import utf8
from tallyhouse.session import settle

from .conftest import ODD

PLAIN = "the of and to in it river stone bread window garden morning paper street music winter".split()


def block(texts):
    return utf8(pa.array(texts, pa.string()))


def prose(rng, n):
    return " ".join(rng.choice(PLAIN) for _ in range(n))


@pytest.fixture(scope="module")
def insults(spark):
    """Half of the toxic texts hold an insult; the others a pair of words that are harmless alone."""
    rng, rows, labels = random.Random(3), [], []
    for k in range(1600):
        kind = k % 8
        words = prose(rng, rng.randint(5, 60)).split()
        extra = {0: ["idiot"], 1: ["vermin"], 2: ["people", "rats"], 3: ["people", "rats"], 4: ["people"], 5: ["rats"]}.get(kind, [])
        for w in extra:
            words.insert(rng.randrange(len(words)), w)
        rows.append((k, " ".join(words)))
        labels.append((k, int(kind < 4)))
    return rows, labels


def test_toxicity_learns_insults_and_pairs(spark, table, insults):
    rows, labels = insults
    docs, known = table(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, known.where(learning.fold("doc_id", 4) != 2))
    score = {r.doc_id: r.score for r in toxicity.scores(docs, model).collect()}
    held = [(y, score[k], k % 8) for k, y in labels if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 300
    hits = {kind: np.mean([s >= 0.3 for y, s, j in held if j == kind]) for kind in range(8)}
    assert min(hits[k] for k in (0, 1)) > 0.95 and min(hits[k] for k in (2, 3)) > 0.9
    assert max(hits[k] for k in (6, 7)) < 0.05 and max(hits[k] for k in (4, 5)) < 0.25
    kept = {r.doc_id for r in toxicity.reject(docs, model).collect()}
    assert kept == {k for k, s in score.items() if s < 0.3}
    assert toxicity.reject(docs, model).columns == docs.columns


def test_factorization_machine_equals_the_double_sum():
    rng = np.random.default_rng(2)
    table = rng.normal(size=(1 << toxicity.BITS, 4)).astype(np.float32)
    rows = [rng.choice(1 << toxicity.BITS, n, replace=False) for n in (0, 1, 5, 9)]
    bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    got = toxicity.score_block(toxicity.Model(0.25, table), np.concatenate(rows).astype(int), bounds)
    for r, g in zip(rows, got, strict=True):
        raw = 0.25 + table[r, 0].sum() + sum(float(table[a, 1:] @ table[b, 1:]) for k, a in enumerate(r) for b in r[k + 1 :])
        assert g == pytest.approx(1 / (1 + np.exp(-raw)), rel=1e-4)


def test_quality_ranks_and_cuts(spark, table):
    rng, rows, labels = random.Random(4), [], []
    for k in range(1200):
        good = k % 6 != 0
        text = prose(rng, rng.randint(20, 90))
        if not good:
            text = [text.upper() + "!!", " | ".join(text.split()), " ".join([text.split()[0]] * 60), text.replace(" ", "%%% ")][k // 6 % 4]
        rows.append((k, text))
        labels.append((k, int(good)))
    docs, known = table(rows), spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, known.where(learning.fold("doc_id", 5) != 0))
    score = {r.doc_id: r.score for r in quality.scores(docs, model).collect()}
    held = [(y, score[k] >= 0.3) for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert len(held) > 150 and np.mean([y == p for y, p in held]) > 0.97


def graded(k, rng):
    return (k, prose(rng, rng.randint(20, 90)), 1) if k % 6 else (k, " | ".join(prose(rng, 40).upper().split()) + "!!", 0)


def test_quality_is_learned_from_every_labelled_row(spark, table):
    """A kind of bad text that few labels show, in whatever place, is known: no row is left out beyond some number."""
    rng = random.Random(8)
    rows = [graded(k, rng) for k in range(900)] + [(k, "%%% ".join(prose(rng, 30).split()), 0) for k in range(900, 930)]
    rows += rows[:3]
    docs, known = table([r[:2] for r in rows]), spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, quality int")
    measured = settle(quality._measured(docs, known, "doc_id", "text", "quality"), "measured")
    n, better = 930, sum(y for _, _, y in rows[:930])
    x = {r.id: np.frombuffer(r.vals, np.float32) for r in measured.collect()}
    assert len(x) == n
    edges = quality._quantiles(measured, lambda x: x, n, np.arange(1, 16) / 16)
    want = np.quantile(np.stack(list(x.values())), np.arange(1, 16) / 16, axis=0, method="lower").T
    assert np.allclose(edges, want, rtol=1 / 1000)
    pairs = [r.pair for r in quality._pairs(measured, edges, better, n - better).collect()]
    bins = {k: quality._bins(edges, v[None]).astype(np.uint8).tobytes() for k, v in x.items()}
    size = len(bins[0])
    label = {k: y for k, _, y in rows}
    assert {p[:size] for p in pairs} == {bins[k] for k in x if label[k]} and {p[size:] for p in pairs} == {bins[k] for k in x if not label[k]}
    model = quality.train(docs, known, on_driver=100)
    score = {r.doc_id: r.score for r in quality.scores(docs, model).collect()}
    assert np.mean([(score[k] >= 0.3) == label[k] for k in score]) > 0.97
    assert np.mean([score[k] < 0.3 for k in range(900, 930)]) > 0.9


def test_newton_steps_reach_the_least_loss(spark):
    """The gradient over all pairs, added up by a loop, is nothing at the weights found."""
    rng = np.random.default_rng(5)
    rows = [(k, int(k % 3 == 0), (rng.normal(size=4) + (k % 3 == 0)).astype(np.float32).tobytes()) for k in range(300)]
    measured = settle(spark.createDataFrame(rows, "id long, label int, vals binary"), "measured")
    model = quality.fit_all(measured, steps=20, ridge=1e-3, least=1e-12)
    pairs = [r.pair for r in quality._pairs(measured, model.edges, 100, 200).collect()]
    gradient = 1e-3 * model.weights
    for p in pairs:
        ahead = sum(model.weights[m, p[m]] - model.weights[m, p[4 + m]] for m in range(4))
        pull = 1 / (1 + np.exp(ahead)) / len(pairs)
        for m in range(4):
            gradient[m, p[m]] -= pull
            gradient[m, p[4 + m]] += pull
    assert np.abs(gradient).max() < 1e-4
    assert quality.fit_all(measured.where("id < 0")) is None and not quality.fit_all(measured.where("label = 1")).weights.any()


def test_measures_of_one_text_do_not_depend_on_its_neighbours():
    texts = ["one two two\nthree", "", "A|B|c!!", "é" * 50, "x " * 300]
    together = quality.measures(*block(texts))
    for k, t in enumerate(texts):
        assert np.allclose(together[k], quality.measures(*block([t]))[0])


@pytest.fixture(scope="module")
def tongues():
    words = {
        "en": "the and that with this from they have were which would there their".split(),
        "de": "der die und das nicht mit sich auf eine auch für über schön".split(),
        "fr": "le la les des est dans pour qui une sur avec être même où".split(),
        "es": "el los las una por con para está como pero sus más año".split(),
        "it": "il gli della che non per una sono nel anche più alla come".split(),
    }
    rng = random.Random(5)
    return [(k, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(4, 40))), lang) for k in range(900) for lang in [sorted(words)[k % 5]]]


def test_languages(table, tongues):
    docs = table(tongues)
    model = langid.train(docs, docs.where(learning.fold("doc_id", 4) != 2))
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    held = [(lang, got[k]) for k, _, lang in tongues if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 150 and np.mean([r.lang_pred == lang for lang, r in held]) > 0.97
    assert all(0 <= r.score <= 1 for _, r in held)


def test_trigrams_stay_within_their_row():
    texts = ["abcd", "", "é", "ab", "xyz", "Hello 12"]
    dims, bounds = langid.trigrams(*block(texts))
    for k, t in enumerate(texts):
        alone, _ = langid.trigrams(*block([t]))
        assert dims[bounds[k] : bounds[k + 1]].tolist() == alone.tolist()


def test_codewords_tell_classes_apart():
    for n in (2, 3, 5, 7, 9, 20):
        code = langid.codewords(n)
        assert code.shape[0] == n and min((code[a] != code[b]).sum() for a in range(n) for b in range(a)) >= max(1, code.shape[1] // 4)
    # A wrong bit is put right: with five classes the words differ in eight of fifteen bits.
    code = langid.codewords(5)
    model = langid.Model(list("abcde"), code, None, None, np.full(15, 1 / 15), 1.0)
    for c in range(5):
        for wrong in range(15):
            raw = code[c] * 4.0
            raw[wrong] *= -1
            assert langid.decode(model, raw[None])[0][0] == c


def test_no_letter_and_no_text_are_undetermined(table, tongues):
    model = langid.train(table(tongues), table(tongues))
    rows = [(1, None), (2, ""), (3, "123 !? 45"), (4, "中文"), (5, "der die das und nicht")]
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(table(rows), model).collect()}
    assert {got[k] for k in (1, 2, 3)} == {("und", 0.0)} and got[4][0] != "und" and got[5][0] == "de"


def test_odd_rows(spark, odd, insults, table):
    rows, labels = insults
    # Few toxic rows, as in a corpus.
    few = [(k, y) for k, y in labels if k % 8 in (0, 4, 5, 6, 7)]
    known = spark.createDataFrame([*few, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(table(rows), known)
    assert toxicity.scores(odd, model).count() == len(ODD) and toxicity.reject(odd, model).count() == len(ODD)
    marks = known.withColumnRenamed("toxic", "quality")
    assert quality.scores(odd, quality.train(table(rows), marks)).where("score BETWEEN 0 AND 1").count() == len(ODD)
    for frame in (toxicity.scores(odd, model), quality.scores(odd, quality.train(table(rows), marks)), langid.predict(odd, langid.train(odd, odd))):
        assert len({tuple(r)[1:] for r in frame.where("doc_id IN (3, 4)").collect()}) == 1


def test_nothing_to_learn_from(spark, odd, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int, lang string")
    model = toxicity.train(odd, none)
    assert toxicity.scores(odd, model).where("score < 0.01").count() == len(ODD)
    assert quality.scores(odd, quality.train(odd, none)).where("score = 0.5").count() == len(ODD)
    assert langid.predict(odd, langid.train(odd, none)).where("lang_pred = 'und'").count() == len(ODD)
    assert toxicity.scores(nothing, model).collect() == [] and quality.scores(nothing, None).collect() == [] and langid.predict(nothing, None).collect() == []


def test_a_balanced_sample_keeps_the_share(spark, table, insults):
    """A sample with as many toxic rows as others scores a text without a term as the whole table would."""
    rows, labels = insults
    few = spark.createDataFrame([(k, y) for k, y in labels if k % 8 in (0, 4, 5, 6, 7)], "doc_id long, toxic int")
    whole, part = (toxicity.train(table(rows), few, max_train=n) for n in (10_000, 250))
    blank = [toxicity.score_block(m, np.zeros(0, int), np.array([0, 0]))[0] for m in (whole, part)]
    assert max(blank) < 0.2


def test_the_sample_is_bounded_and_takes_turns(spark):
    rows = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(5000)], "doc_id long, y int")
    chosen = learning.sample(rows, "y", 600).collect()
    assert len(chosen) == 600 and 250 <= sum(r.label for r in chosen) <= 350
    assert {tuple(r) for r in chosen} == {tuple(r) for r in learning.sample(rows.repartition(7), "y", 600).collect()}


def test_preference_pairs_are_fitted_as_by_loops():
    """Every pair's gradient of the logistic loss on the difference of features, bin by bin, and the cut at the quantile."""
    rng = np.random.default_rng(3)
    rows = [(int(k % 3 == 0), None, (rng.normal(size=4) + (k % 3 == 0)).astype(np.float32)) for k in range(60)]
    options = {"pairs": 40, "epochs": 2, "batch": 7, "rate": 0.1, "ridge": 1e-4, "seed": 5}
    model = quality.fit(rows, **options)
    x, y = np.stack([r[2] for r in rows]), [r[0] for r in rows]
    bins = [[sum(float(e) <= float(v) for e in model.edges[k]) for k, v in enumerate(row)] for row in x]
    better, worse = [k for k, v in enumerate(y) if v], [k for k, v in enumerate(y) if not v]
    weights, seen = {}, {}
    draw = np.random.default_rng(5)
    for _ in range(options["epochs"]):
        a, b = draw.choice(better, 40), draw.choice(worse, 40)
        for lo in range(0, 40, 7):
            pairs = list(zip(a[lo : lo + 7].tolist(), b[lo : lo + 7].tolist(), strict=True))
            gradient = {(m, n): options["ridge"] * weights.get((m, n), 0.0) for m in range(4) for n in range(quality.BINS)}
            for up, down in pairs:
                ahead = sum(weights.get((m, bins[up][m]), 0.0) - weights.get((m, bins[down][m]), 0.0) for m in range(4))
                pull = 1 / (1 + np.exp(ahead)) / len(pairs)
                for m in range(4):
                    gradient[m, bins[up][m]] -= pull
                    gradient[m, bins[down][m]] += pull
            for cell, g in gradient.items():
                seen[cell] = seen.get(cell, 1e-6) + g * g
                weights[cell] = weights.get(cell, 0.0) - options["rate"] * g / np.sqrt(seen[cell])
    want = np.array([[weights[m, n] for n in range(quality.BINS)] for m in range(4)])
    assert np.allclose(model.weights, want)
    raw = sorted(sum(want[m, own[m]] for m in range(4)) for own in bins)
    place = len(worse) / len(y) * (len(raw) - 1)
    low = int(place)
    assert np.isclose(model.shift, raw[low] + (place - low) * (raw[min(low + 1, len(raw) - 1)] - raw[low]))


@pytest.mark.parametrize("classes", [1, 2, 4, 9])
def test_codewords_are_decoded_as_by_loops(classes):
    rng = np.random.default_rng(classes)
    code = langid.codewords(classes)
    bits = code.shape[1]
    trust = rng.random(bits)
    model = langid.Model([f"l{k}" for k in range(classes)], code, np.zeros((1, bits)), np.zeros(bits), trust / trust.sum() if bits else trust, 1.0)
    raw = rng.normal(size=(50, bits)) * 5
    best, score, gap = langid.decode(model, raw)
    for k in range(50):
        loss = [sum(t * np.log1p(np.exp(-np.clip(r * c, -30, 30))) for r, c, t in zip(raw[k], word, model.trust, strict=True)) for word in code]
        order = sorted(range(classes), key=lambda j: (loss[j], j))
        assert best[k] == order[0]
        if classes > 1:
            weight = [np.exp(-(v - loss[order[0]]) * bits / 2) for v in loss]
            assert np.isclose(score[k], 1 / sum(weight)) and np.isclose(gap[k], loss[order[1]] - loss[order[0]])


def test_a_sampled_id_that_a_third_of_the_rows_hold_counts_once(spark, table):
    docs = table([(7 if k % 3 == 0 else 1000 + k, f"word{k % 5} and more words here") for k in range(600)])
    labels = spark.createDataFrame([(7, 1), (7, 0), (1001, 0), (1001, 0)], "doc_id long, quality int")
    rows = learning.collect_features(docs, learning.natural_sample(labels, "quality", 100), quality._as_features)
    assert len(rows) == 2
