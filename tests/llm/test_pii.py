"""Base spans against plain patterns; disguised identifiers."""

import hashlib
import random
import re

import pytest

from tallyhouse.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    out = {kind: [] for kind in PATTERNS}
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 13 <= len(d) <= 19 and _luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]
            if good():
                out[kind].append(m.span())
    return out


def test_base_spans():
    random.seed(3)
    pool = list("0123456789") * 3 + list(".@+- ()aZ%_") + ["é", "1.2.3.4", "4111 1111 1111 1111", "a@b.c", "+1 (555) 123-4567", "255", "@", "."]
    for _ in range(20_000):
        text = "".join(random.choice(pool) for _ in range(random.randint(0, 25)))
        assert pii.base_spans(text) == brute(text), text


def test_long_runs_are_linear():
    for text in ("a" * 200_000 + "@", "1" * 200_000, "a.b@" * 50_000, "1." * 100_000, "+1 " * 60_000, "1 " * 100_000):
        assert pii.base_spans(text).keys() == PATTERNS.keys()
        pii.added_spans(text, pii.base_spans(text))


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("mail john (at) mail [dot] example dot com now", "email", "john (at) mail [dot] example dot com"),
        ("write jo at ex dot org", "email", "jo at ex dot org"),
        ("a{at}b.co", "email", "a{at}b.co"),
        ("ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ", "email", "ｊｏｈｎ＠ｍａｉｌ．ｃｏｍ"),
        ("see jоhn@mаil.com, x", "email", "jоhn@mаil.com"),
        ("plus one two three four five six seven eight nine zero!", "phone", "plus one two three four five six seven eight nine zero"),
        ("pay four one one one one one one one one one one one one one one one ok", "card", "four one one one one one one one one one one one one one one one"),
        ("ip １９２.168.0.1", "ip", "１９２.168.0.1"),
    ],
)
def test_disguises_map_back(table, text, kind, value):
    found = [(r.kind, r.value) for r in pii.find(table([(1, text)])).where("disguised").collect()]
    assert (kind, value) in found


@pytest.mark.parametrize("text", ["look at example.com", "one two three", "at the dot at", "five dot six"])
def test_plain_prose_is_left_alone(table, text):
    assert pii.find(table([(1, text)])).collect() == []


def test_added_spans_never_replace_base_ones():
    text = "a@b.co and a (at) b.co"
    base = pii.base_spans(text)
    assert base["email"] == [(0, 6)]
    assert pii.added_spans(text, base)["email"] == [(11, 22)]


def test_digests(odd, table):
    rows = [(1, "mail a@b.co, +1 (555) 123-4567 é 4111 1111 1111 1111 9.9.9.9"), (2, None), (3, "")]
    for r in pii.digests(table(rows)).collect():
        text = dict(rows)[r.doc_id] or ""
        spans = ",".join(f"{k}:{s}:{e}" for k in PATTERNS for s, e in brute(text)[k])
        assert (r.base_sha256, r.spans) == (hashlib.sha256(spans.encode()).hexdigest(), spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(brute(text)[k]) for k in PATTERNS]
    assert pii.digests(odd).where("spans = '' AND n_disguised = 0").count() == odd.count()


def test_nothing(nothing):
    assert pii.digests(nothing).collect() == [] and pii.find(nothing).collect() == []


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("host 10 dot 0 dot 0 dot 1, ok", "ip", "10 dot 0 dot 0 dot 1"),
        ("host 10[dot]0[dot]0[dot]1 ok", "ip", "10[dot]0[dot]0[dot]1"),
        ("host 10[.]0[.]0[.]1 ok", "ip", "10[.]0[.]0[.]1"),
        ("host 10.0 ( . ) 0 DOT 255.", "ip", "10.0 ( . ) 0 DOT 255"),
        ("é 10[.]0[.]0[.]1", "ip", "10[.]0[.]0[.]1"),
        ("to john@mail[.]com now", "email", "john@mail[.]com"),
        ("to john@mail [ . ] com now", "email", "john@mail [ . ] com"),
        ("to john (@) mail.com now", "email", "john (@) mail.com"),
        ("to john ( @ ) mail.com now", "email", "john ( @ ) mail.com"),
        ("to john dot doe at mail dot com", "email", "john dot doe at mail dot com"),
        ("john[.]a dot doe (at) mail[dot]com", "email", "john[.]a dot doe (at) mail[dot]com"),
        ("john[dot]doe at mail.com", "email", "john[dot]doe at mail.com"),
        ("root at 10 dot 0 dot 0 dot 1", "ip", "10 dot 0 dot 0 dot 1"),
        ("root at 10 dot 0 dot 0 dot 1", "email", "root at 10 dot 0 dot 0 dot 1"),
    ],
)
def test_spelled_and_bracketed_signs(table, text, kind, value):
    found = [(r.kind, r.value, text[r.start : r.end]) for r in pii.find(table([(1, "filler"), (2, text)])).where("disguised").collect()]
    assert (kind, value, value) in found


@pytest.mark.parametrize("text", ["300 dot 1 dot 1 dot 1", "1 dot 2 dot 3", "a red dot here at example.com", "f(x)[.] and (@) alone"])
def test_signs_in_prose_are_left_alone(table, text):
    assert pii.find(table([(1, text)])).collect() == []


def test_long_disguises_are_linear():
    for text in ("a dot " * 60_000 + "at b dot c", "1 dot " * 60_000, "[.]" * 100_000, "(@) a" * 60_000, "a[.]b@c[.]d " * 20_000, "a dot b at c.d " * 20_000, " at a.b" * 50_000):
        pii.added_spans(text, pii.base_spans(text))


@pytest.mark.parametrize(
    ("text", "kind", "shown"),
    [
        ("write to john" + " " * 300 + "at mail" + "\t" * 50 + "dot com today", "email", "john" + " " * 300 + "at mail" + "\t" * 50 + "dot com"),
        ("host one nine two dot one six eight dot zero dot one is up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("see ten dot zero dot twenty-five dot two hundred and fifty five now", "ip", "ten dot zero dot twenty-five dot two hundred and fifty five"),
        ("at 10 dot 0 [.] zero . one", "ip", None),
        ("at 10 dot 0 [.] zero dot double five", "ip", "10 dot 0 [.] zero dot double five"),
        ("number three hundred dot one dot one dot one", "ip", None),
        ("call plus four nine double five one two triple three seven nine", "phone", "plus four nine double five one two triple three seven nine"),
        ("mail 𝐣𝐨𝐡𝐧@𝑚𝑎𝑖𝑙.𝘤𝘰𝘮 now", "email", "𝐣𝐨𝐡𝐧@𝑚𝑎𝑖𝑙.𝘤𝘰𝘮"),
        ("ⓐⓑ@ⓜail.com", "email", "ⓐⓑ@ⓜail.com"),
        ("1.2.3.4.5 and 10.0.0.1", "ip", None),
    ],
)
def test_disguises_of_any_length(text, kind, shown):
    base = pii.base_spans(text)
    added = pii.added_spans(text, base)
    assert [text[s:e] for s, e in added[kind]] == ([shown] if shown else [])


def test_long_blanks_are_read_once():
    import time

    for text in (" " * 400_000, "at " * 100_000, "one " * 100_000, " dot" * 100_000, "[ " * 100_000, "one-" * 100_000):
        begun = time.time()
        pii.added_spans(text, pii.base_spans(text))
        assert time.time() - begun < 20
