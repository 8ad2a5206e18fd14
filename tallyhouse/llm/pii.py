r"""Personal data by offset-preserving deobfuscation.

Identifiers are found twice. Once in the text as it is (the base spans). And once in what transducers make of it: look-alike
letters and digits become ASCII, invisible characters go, "john dot doe (at) mail [.] org" and "10 dot 0 dot 0 [.] 1" get
their @ and dots, and runs of spelled digits become digits. Every character of the rewritten text remembers the source characters it came from, so a span found there
is reported in source code points. It is added if it overlaps no base span of its kind.

A cheap look at the bytes of a block decides which texts need either search: without a digit, an @ or a plus sign there is no
base span, and without a look-alike, a spelled digit, a "dot" or a bracketed "at", "@" or "." nothing to rewrite. Every text is searched
whole, in time linear in its length. NULL and empty texts have no spans; equal texts have equal spans.

Kinds, leftmost and non-overlapping each, failing matches dropped:
email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`; ip four dotted numbers of at most 255; card 13 to 19 digits passing
Luhn, single spaces or hyphens between; phone `\+[0-9][\x20().0-9-]+[0-9]` with 9 to 15 digits.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text import BETWEEN, LOWER, hash_spans, row_blocks, rows_of, spans, sum_rows, utf8

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is tried from its first digit only: the look-behind follows it, so that the scan can skip to digits.
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(t: str) -> list[Span]:
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        # Whether the part behind the @ fits does not depend on where the part before it begins.
        domain = _DOMAIN.match(t, at + 1)
        if domain:
            start = at
            while start > end and t[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = domain.end()
                out.append((start, end))
        at = t.find("@", max(at + 1, end))
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def ips(t: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(t) if all(map(_small, m.group().split(".")))]


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(t: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(t):
        digits = _NOT_DIGIT.sub("", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(m.span())
    return out


def phones(t: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(t) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones), strict=True))

# Letters of other scripts that look like ASCII ones.
LOOKALIKES = dict(zip("аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅαοινρυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijshdqwABEKMHOPCTYXIJSaoivpukABEZHIKMNOPTYX", strict=True))
LOOKALIKES |= {"․": ".", "。": ".", "﹫": "@"}
INVISIBLE = "​‌‍⁠﻿­"
DIGITS = dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True))

_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
# Any white space, taken from its beginning on, so that a long run is read once.
_BEFORE, _AROUND, _BEHIND = r"(?<!\s)\s*+", r"(?<!\s)\s++", r"\s*+"
_AT = rf"{_BEFORE}{_OPEN}{_BEHIND}(?:at|@){_BEHIND}{_CLOSE}{_BEHIND}"
_DOT = rf"{_BEFORE}{_OPEN}{_BEHIND}(?:dot|\.){_BEHIND}{_CLOSE}{_BEHIND}|{_AROUND}dot\s++"
# A bare word "at" counts only before a spelled dot or behind a bracketed one (`maybe`); a bracketed one before any.
_DISGUISED = re.compile(
    rf"(?P<at>{_AT})(?P<host>[a-z0-9-]++(?:(?:{_DOT}|\.)[a-z0-9-]++)++)|(?P<word>{_AROUND}at\s++|@)(?P<name>[a-z0-9-]++(?:\.[a-z0-9-]++)*+(?:(?:{_DOT})[a-z0-9-]++(?:\.[a-z0-9-]++)*+)++)"
    rf"|(?P<maybe>{_AROUND}at\s++)(?P<plain>[a-z0-9-]++(?:\.[a-z0-9-]++)++)",
    re.IGNORECASE,
)
# As _IP, with spelled and bracketed dots too.
_QUAD = re.compile(rf"[0-9](?<![0-9][0-9])[0-9]*+(?:(?:\.|{_DOT})[0-9]++){{3}}", re.IGNORECASE)
_SPELLED_DOT = re.compile(_DOT, re.IGNORECASE)
_DIGIT_WORD = "|".join(DIGITS)
_TIMES = {"double": 2, "triple": 3}
_ONE = rf"(?:(?:double|triple)\s++)?(?:{_DIGIT_WORD}|[0-9])"
_SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?P<plus>plus(?:\s++|[,-])++)?(?P<run>{_ONE}(?:(?:\s++|[,-])++{_ONE}(?![A-Za-z0-9]))+)", re.IGNORECASE)
_ITEM = re.compile(rf"(?:(?P<times>double|triple)\s++)?(?P<digit>{_DIGIT_WORD}|[0-9])", re.IGNORECASE)
# Numbers of a spoken dotted quad: digit by digit, or as one number word after the other.
_TEENS = dict(zip("ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), range(10, 20), strict=True))
_TENS = dict(zip("twenty thirty forty fifty sixty seventy eighty ninety".split(), range(20, 100, 10), strict=True))
_NUMBER_WORD = "|".join([*_TEENS, *_TENS, *DIGITS, "hundred", "and", "double", "triple"])
_OCTET = rf"(?:[0-9]{{1,3}}+|(?:{_NUMBER_WORD})(?![A-Za-z0-9])(?:(?:\s++|-)(?:(?:{_NUMBER_WORD})(?![A-Za-z0-9])|[0-9](?![A-Za-z0-9])))*+)"
_SPOKEN_OCTET = re.compile(rf"(?<![A-Za-z0-9]){_OCTET}(?![A-Za-z0-9])", re.IGNORECASE)
_SPOKEN_DOT = re.compile(rf"{_DOT}|{_AROUND}point\s++|\.", re.IGNORECASE)


def _octet(spoken: str) -> str | None:
    """The number of a quad's part, None if it is none or above 255."""
    words = spoken.lower().replace("-", " ").split()
    times, digits = 1, ""
    for w in words:
        if w in _TIMES:
            times = _TIMES[w]
        elif w.isdigit() or w in DIGITS:
            digits, times = digits + DIGITS.get(w, w) * times, 1
        else:
            digits = ""
            break
    if not digits:
        value, part = 0, 0
        for w in words:
            if w in DIGITS or w in _TEENS or w in _TENS:
                part += int(DIGITS.get(w, _TEENS.get(w, _TENS.get(w))))
            elif w == "hundred":
                value, part = value + 100 * max(part, 1), 0
            elif w != "and":
                return None
        digits = str(value + part)
    return digits if len(digits) <= 3 and int(digits) <= 255 else None


def _plain(c: str) -> str:
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if "！" <= c <= "～":  # full-width forms stand in the order of ASCII
        return chr(ord(c) - 0xFEE0)
    if c in INVISIBLE:
        return ""
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    # Compatibility forms: mathematical, circled, superscript letters and digits.
    like = unicodedata.normalize("NFKC", c)
    return like if len(like) == 1 and like.isascii() else c


Edit = tuple[int, int, str]


def _glyphs(t: str) -> list[Edit]:
    return [] if t.isascii() else [(k, k + 1, p) for k, c in enumerate(t) if c > "\x7f" and (p := _plain(c)) != c]


def _separators(t: str) -> list[Edit]:
    out: list[Edit] = []
    dots: dict[int, int] | None = None
    done = 0
    for m in _DISGUISED.finditer(t):
        which, host = ("at", "host") if m["at"] else ("word", "name") if m["word"] else ("maybe", "plain")
        if dots is None:
            dots = {d.end(): d.start() for d in _SPELLED_DOT.finditer(t)}
        # The dots of the local part, from its end on.
        at, local = m.start(which), []
        while True:
            before = at
            while at > done and t[at - 1] in _LOCAL:
                at -= 1
            start = dots.get(at, -1)
            if at == before or start <= done or t[start - 1] not in _LOCAL:
                break
            local.append((start, at, "."))
            at = start
        if which == "maybe" and not (local and any(c in "[({<" for lo, hi, _ in local for c in t[lo:hi])):
            continue
        done = m.end()
        out += local[::-1]
        out.append((*m.span(which), "@"))
        out += [(d.start(), d.end(), ".") for d in _SPELLED_DOT.finditer(t, *m.span(host))]
    quads: list[Edit] = []
    for m in _QUAD.finditer(t):
        if all(map(_small, _NOT_DIGIT.split(m.group()))):
            quads += [(d.start(), d.end(), ".") for d in _SPELLED_DOT.finditer(t, *m.span())]
    if not quads:
        return out
    # An address may be a host too: the same dots.
    merged: list[Edit] = []
    for edit in sorted({*out, *quads}):
        if not merged or edit[0] >= merged[-1][1]:
            merged.append(edit)
    return merged


def _spelled(t: str) -> list[Edit]:
    """Spelled digits as digits; fewer than seven are no phone or card number and stay."""
    out: list[Edit] = []
    for m in _SPELLED.finditer(t):
        items = list(_ITEM.finditer(t, *m.span("run")))
        said = [DIGITS.get(i["digit"].lower(), i["digit"]) * _TIMES.get((i["times"] or "").lower(), 1) for i in items]
        if sum(map(len, said)) < 7 or not any(len(i.group()) > 1 for i in items):
            continue
        if m["plus"]:
            out.append((*m.span("plus"), "+"))
        for a, b, digits in zip(items, [*items[1:], None], said, strict=True):
            out.append((a.start(), b.start() if b else a.end(), digits))
    return out


def _spoken_quads(t: str) -> list[Edit]:
    """Quads with spelled numbers, "ten dot zero dot ..."; those of plain numbers are left to the other dots."""
    out: list[Edit] = []
    run: list[re.Match] = []
    for m in _SPOKEN_OCTET.finditer(t):
        if run and not _SPOKEN_DOT.fullmatch(t, run[-1].end(), m.start()):
            run = []
        run.append(m)
        if len(run) < 4:
            continue
        values, spoken = [_octet(p.group()) for p in run], any(not p.group().isdigit() for p in run)
        if not spoken or None in values:
            run = run[1:]
            continue
        for k, (p, value) in enumerate(zip(run, values, strict=True)):
            if k:
                out.append((run[k - 1].end(), p.start(), "."))
            out.append((*p.span(), value))
        run = []
    return out


TRANSDUCERS = (_glyphs, _spoken_quads, _separators, _spelled)


def normalise(t: str) -> tuple[str, list[int], list[int]]:
    """The rewritten text, and the source start and end of each of its characters."""
    first, last = list(range(len(t))), list(range(1, len(t) + 1))
    for find in TRANSDUCERS:
        edits = find(t)
        if not edits:
            continue
        pieces, a, b, done = [], [], [], 0
        for lo, hi, new in edits:
            pieces += [t[done:lo], new]
            a += first[done:lo] + [first[lo]] * len(new)
            b += last[done:lo] + [last[hi - 1]] * len(new)
            done = hi
        pieces.append(t[done:])
        a += first[done:]
        b += last[done:]
        t, first, last = "".join(pieces), a, b
    return t, first, last


def base_spans(t: str) -> dict[str, list[Span]]:
    return {kind: find(t) for kind, find in FINDERS.items()}


def added_spans(t: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans that only the rewritten text shows, in source code points."""
    plain, first, last = normalise(t)
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if plain == t:
        return out
    for kind, find in FINDERS.items():
        known = base.get(kind, [])
        at = 0
        for s, e in find(plain):
            lo, hi = first[s], last[e - 1]
            while at < len(known) and known[at][1] <= lo:
                at += 1
            if at == len(known) or known[at][0] >= hi:
                out[kind].append((lo, hi))
    return out


# Lead bytes of the scripts and signs above, of other decimal digits, and of the soft hyphen.
_FOREIGN = np.zeros(256, bool)
_FOREIGN[[0xCE, 0xCF, *range(0xD0, 0xD5), 0xD9, 0xDB, 0xDF, *range(0xE0, 0xF0), 0xF0]] = True
# Second bytes of the soft hyphen and of ordinal and superscript signs.
_LATIN_FORMS = np.array([0xAD, 0xAA, 0xB2, 0xB3, 0xB9, 0xBA], np.uint8)
_MARK = np.zeros(256, bool)
_MARK[[*b"0123456789@+"]] = True
# Opening brackets; white space, of other scripts by its last byte.
_BRACKET, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_BRACKET[[*b"[({<"]] = True
_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0]] = True


def _word_hash(word: str) -> np.uint64:
    return hash_spans(np.frombuffer(word.encode(), np.uint8), np.array([0]), np.array([len(word)]))[0]


_DOT_HASH, _AT_HASH = _word_hash("dot"), _word_hash("at")
_DIGIT_HASHES = np.array([_word_hash(w) for w in DIGITS])


def suspects(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may have base spans, and rows that may need rewriting."""
    n = len(offsets) - 1
    base = sum_rows(_MARK[data].astype(np.int64), offsets) > 0
    soft = (data == 0xC2) & np.r_[np.isin(data[1:], _LATIN_FORMS), False] if len(data) else np.zeros(0, bool)
    rewrite = sum_rows((_FOREIGN[data] | soft).astype(np.int64), offsets) > 0
    low = LOWER[data]
    starts, ends, bounds = spans(low, offsets, BETWEEN)
    short = ends - starts <= 5
    row, starts, ends = rows_of(bounds)[short], starts[short], ends[short]
    hashes = hash_spans(low, starts, ends)
    rewrite[row[hashes == _DOT_HASH]] = True
    at = hashes == _AT_HASH
    before = data[np.maximum(starts[at] - 1, 0)]
    rewrite[row[at][np.isin(before, np.frombuffer(b"[({<", np.uint8))]] = True
    # "( at )" has a blank there.
    blank = row[at][np.isin(before, np.frombuffer(b" \t\n", np.uint8))]
    if len(blank):
        bracket = sum_rows(np.isin(data, np.frombuffer(b"[({<", np.uint8)).astype(np.int64), offsets) > 0
        rewrite[blank[bracket[blank]]] = True
    # "(@)" and "[.]", or with a blank there.
    sign = np.flatnonzero((data == 0x2E) | (data == 0x40))
    before = data[np.maximum(sign - 1, 0)]
    opened, apart = sign[_BRACKET[before]], sign[_BLANK[before]]
    rewrite[np.searchsorted(offsets, opened, "right") - 1] = True
    if len(apart):
        blank = np.searchsorted(offsets, apart, "right") - 1
        bracket = sum_rows(_BRACKET[data].astype(np.int64), offsets) > 0
        rewrite[blank[bracket[blank]]] = True
    rewrite |= np.bincount(row[np.isin(hashes, _DIGIT_HASHES)], minlength=n) > 0
    return base, rewrite


def listed(found: dict[str, list[Span]]) -> str:
    """kind:start:end by kind, then start, joined by commas."""
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in sorted(found[kind]))


_NONE = {kind: [] for kind in KINDS}


def search_block(column: pa.Array, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, dict[str, list[Span]], dict[str, list[Span]]]]:
    """Row, base spans and added spans of the rows that have any."""
    base, rewrite = suspects(data, offsets)
    for k in np.flatnonzero(base | rewrite).tolist():
        t = column[k].as_py() or ""
        known = base_spans(t) if base[k] else _NONE
        more = added_spans(t, known) if rewrite[k] else _NONE
        if any(known.values()) or any(more.values()):
            yield k, known, more


def find(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row for each span: `id`, kind, start, end (code points, end exclusive), `value` as it stands in the text, `disguised`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0)
            for lo, hi in row_blocks(offsets):
                part = batch.column(1).slice(lo, hi - lo)
                rows = [
                    (ids[lo + k].as_py(), kind, s, e, part[k].as_py()[s:e], found is more)
                    for k, known, more in search_block(part, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                    for found in (known, more)
                    for kind in KINDS
                    for s, e in found[kind]
                ]
                types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], ["id", "kind", "start", "end", "value", "disguised"])

    picked = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return picked.mapInArrow(run, "id long, kind string, start long, `end` long, value string, disguised boolean").withColumnRenamed("id", id)


def digests(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row for each document: base counts by kind, the digest of the base spans, all spans, and how many were disguised."""
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in row_blocks(offsets):
                n = hi - lo
                counts, more_of = np.zeros((n, len(KINDS)), np.int64), np.zeros(n, np.int64)
                digest, all_spans = [empty] * n, [""] * n
                for k, known, more in search_block(batch.column(1).slice(lo, n), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                    counts[k] = [len(known[kind]) for kind in KINDS]
                    more_of[k] = sum(map(len, more.values()))
                    digest[k] = hashlib.sha256(listed(known).encode()).hexdigest()
                    all_spans[k] = listed({kind: known[kind] + more[kind] for kind in KINDS})
                columns = [batch.column(0).slice(lo, n), *map(pa.array, counts.T), pa.array(digest, pa.string()), pa.array(all_spans, pa.string()), pa.array(more_of)]
                yield pa.RecordBatch.from_arrays(columns, ["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_disguised"])

    picked = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string, n_disguised long"
    return picked.mapInArrow(run, schema).withColumnRenamed("id", id)
