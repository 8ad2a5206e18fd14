"""Encoding against the tokenizers library, and exact round trips."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyhouse.llm import bpe

from .conftest import ODD

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    random.seed(1)
    pool = [chr(c) for c in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x1680, 0xFEFF, 0x1F600, 0x4E00, 0x0660, 0xB2, 0x300]]
    pool += [" "] * 60 + ["'s", "'ll", "aaa", "aaaaaaa", "  ", "\n\n", "<|endoftext|>", "<|endoftext|", "123"] * 5
    texts = ["".join(random.choice(pool) for _ in range(random.randint(0, 60))) for _ in range(3000)]
    encoder = bpe.Encoder(bpe.Vocabulary(PATH), cache=500)
    for lo in range(0, len(texts), 250):
        part = texts[lo : lo + 250]
        ids, bounds = encoder.encode(part)
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        back = bpe.decode_bytes(ids, bounds, encoder.v)
        assert [b.decode("utf-8", "replace") for b in back] == [library.decode(g, skip_special_tokens=False) for g in got]


def test_equal_pairs_merge_from_the_left():
    v = bpe.Vocabulary(PATH)
    ids, bounds = bpe.merge_words([b"a" * n for n in range(1, 40)], v)
    assert [b"".join(v.raw[i] for i in ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [b"a" * n for n in range(1, 40)]


def test_cut_characters_decode_like_the_library(library):
    v = bpe.Vocabulary(PATH)
    rng = np.random.default_rng(2)
    rows = [rng.integers(0, 50257, 9).tolist() for _ in range(300)]
    bounds = np.arange(len(rows) + 1) * 9
    assert [b.decode("utf-8", "replace") for b in bpe.decode_bytes(np.concatenate(rows), bounds, v)] == [library.decode(r, skip_special_tokens=False) for r in rows]


def test_odd_rows(odd, library):
    got = sorted(tuple(r) for r in bpe.digests(odd.where("doc_id IS NOT NULL"), PATH).collect())
    want = []
    for doc_id, text, *_ in ODD:
        if doc_id is not None:
            ids = library.encode(text or "", add_special_tokens=False).ids
            want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_round_trip(odd):
    ids = bpe.encode(odd, PATH)
    assert ids.columns == ["doc_id", "ids"]
    got = sorted(((r.doc_id, r.text) for r in bpe.decode(ids, PATH).collect()), key=str)
    assert got == sorted(((r[0], r[1] or "") for r in ODD), key=str)


def test_nothing(nothing):
    assert bpe.digests(nothing, PATH).collect() == [] and bpe.encode(nothing, PATH).collect() == []


def test_every_code_point_is_split_as_by_the_library(library):
    encoder = bpe.Encoder(bpe.Vocabulary(PATH))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    step = 64
    texts = []
    for lo in range(0, len(points), step):
        # Each between letters, digits, blanks and signs; characters of a block share a text only if they are alike unknown.
        part = points[lo : lo + step]
        for unknown in (False, True):
            own = [c for c in part if bpe.later(c) == unknown]
            texts.append("".join(f"a{c}b 1{c}2 {c} .{c}!" for c in own))
    for lo in range(0, len(texts), 500):
        ids, bounds = encoder.encode(texts[lo : lo + 500])
        got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [e.ids for e in library.encode_batch(texts[lo : lo + 500], add_special_tokens=False)]


def test_a_changed_vocabulary_at_the_same_path_counts(table, tmp_path):
    path = tmp_path / "v.json"
    spec = json.loads(open(PATH).read())
    path.write_text(json.dumps(spec))
    df = table([(1, "the other")])
    first = bpe.encode(df, str(path)).first().ids
    spec["model"]["merges"] = spec["model"]["merges"][:1]
    path.write_text(json.dumps(spec))
    assert len(bpe.encode(df, str(path)).first().ids) > len(first)
