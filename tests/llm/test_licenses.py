"""Phrases and template containment against plain loops."""

import random
import re

from tallyhouse.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(text):
    words = WORD.findall(low(text))
    places = [(k, label) for phrase, label in licenses.PHRASES.items() for p in [phrase.split()] for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    lines = [set(WORD.findall(low(x))) for x in (text or "").split("\n")]
    more = {}
    for label, template in licenses.TEMPLATES:
        wanted = set(licenses.words_of(template))
        for k in range(len(lines)):
            n = len(set().union(*lines[k : k + licenses.SPAN]) & wanted)
            if n >= -(-len(wanted) * 8 // 10):
                more[label] = max(more.get(label, 0), n / len(wanted))
    base = sorted({label for _, label in places})
    first, last = (min(places)[0], max(places)[0]) if places else (None, None)
    return (len(words), len(places), first, last, ",".join(base), ",".join(sorted({*base, *more})), 1.0 if places else max(more.values(), default=0.0))


def test_against_loops(table):
    random.seed(6)
    pool = ["GNU", "General", "public", "license", "Apache", "cc", "BY", "mit", " ", "  ", "\n", "-", ".", "é", "x1", "İ", "😀", "K", "\x7f", " gnu general public license ", " mit license", "cc by", "apache  license"]
    texts = ["".join(random.choice(pool) + random.choice([" ", " ", "", ",\n"]) for _ in range(random.randint(0, 20))) for _ in range(800)] + [None, ""]
    for _, template in licenses.TEMPLATES:
        for _ in range(15):
            words = template.split()
            for _ in range(random.randint(0, 9)):
                words[random.randrange(len(words))] = random.choice(["foo", "the", "bar"])
            text = "pre line\n" * random.randint(0, 3) + " ".join(words) + "\ntail of it"
            for _ in range(random.randint(0, 4)):
                at = random.randrange(len(text))
                text = text[:at] + "\n" + text[at:]
            texts.append(text)
    rows = licenses.scan(table(list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    wrong = [(texts[r.doc_id], tuple(r)[1:]) for r in rows if tuple(r)[1:] != brute(texts[r.doc_id])]
    assert wrong == []
    assert any("bsd" in r.labels for r in rows)


def test_odd_rows(odd):
    rows = licenses.scan(odd).collect()
    assert len(rows) == odd.count() and all(r.n_base == 0 and r.labels == "" and r.score == 0.0 for r in rows)
    assert {r.n_words for r in rows if r.doc_id in (1, 2, 6)} == {0}


def test_nothing(nothing):
    assert licenses.scan(nothing).collect() == []


def test_no_python_in_the_plan(table):
    plan = licenses.scan(table([(1, "mit license")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def wrapped(text, width):
    lines = [""]
    for word in text.split():
        if lines[-1] and len(lines[-1]) + 1 + len(word) > width:
            lines.append("")
        lines[-1] = f"{lines[-1]} {word}".strip()
    return lines


def by_runs(text):
    """Label and best share over all runs of words."""
    words, out = WORD.findall(low(text)), {}
    for label, template in licenses.TEMPLATES:
        wanted, size = set(licenses.words_of(template)), licenses.run_of(template, licenses.THRESHOLD)
        n = max((len(set(words[k : k + size]) & wanted) for k in range(len(words))), default=0)
        if n >= -(-len(wanted) * 8 // 10):
            out[label] = n / len(wanted)
    return out


def test_wrapped_notices(table):
    random.seed(7)
    texts, planted = [None, "", "no notice"], [None] * 3
    for label, template in licenses.TEMPLATES:
        for width in (12, 20, 30, 40, 50, 60, 80):
            for gap in ("\n", "\n\n", "\n \n\n", "\n# ", "\r\n"):
                texts.append("some words\n" * 3 + gap.join(wrapped(template, width)) + "\nother words")
                planted.append(label)
        for _ in range(20):
            words = [random.choice(["foo", "bar baz", w, w, w, w, w, w]) for w in template.split()]
            texts.append("\n\n".join(words))
            planted.append(None)
    rows = licenses.scan(table(list(enumerate(texts))), runs=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text, whole = texts[r.doc_id], brute(texts[r.doc_id])
        more = by_runs(text)
        assert set(filter(None, r.labels.split(","))) == {*filter(None, whole[5].split(",")), *more}, text
        assert r.score == max([whole[6], *more.values()]), text
        assert tuple(r)[1:6] == whole[:5]
        if planted[r.doc_id]:
            assert planted[r.doc_id] in r.labels.split(",") and r.score == 1.0, text


def test_query_finds_wrapped_notices(spark, table, tmp_path):
    from tallyhouse.llm.queries import QUERIES

    text = "\n\n".join(wrapped(dict(licenses.TEMPLATES)["mit"], 30))
    table([(1, text)]).write.parquet(f"{tmp_path}/documents.parquet")
    assert [(r.labels, r.score) for r in QUERIES["op9_licenses"](spark, str(tmp_path)).collect()] == [("mit", 1.0)]


def test_no_python_in_the_plan_of_runs(table):
    plan = licenses.scan(table([(1, "mit license")]), runs=True)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
