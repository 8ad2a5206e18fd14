"""Byte-level BPE encoding and decoding by batched numpy merge rounds.

The words of a block of texts that are not known yet are merged together: their symbols lie in one flat array, each round
looks every adjacent pair up by binary search over the sorted pair keys, and joins the pairs of lowest rank of every word.
Known words are kept per Python worker, up to `CACHE` words; then the store starts afresh, so memory is bounded.

The split before the merges needs the classes of letters, numbers and blanks that the library has, which are those of one Unicode version.
Texts whose characters were all assigned when Python's own Unicode tables were made are split by `regex`, where all versions agree;
a text with a later one is split by the library's own splitter.

A vocabulary is a `tokenizers` JSON file of kind byte-level BPE. Its special tokens found in a text become their ids, as the
library does. NULL and the empty text give no ids; texts of any length are encoded whole; equal texts give equal ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, pre_tokenizers

from tallyhouse.llm.text import string_blocks

# Fixed value: the split of byte-level BPE before the merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 100_000
# Below this code point every character is assigned, or left out for good.
_LATER = re.compile("[^\0-\u0557]").search
_UNASSIGNED: list[np.ndarray] = []


def later(text: str) -> bool:
    """If the text has a character that Python's Unicode tables don't know."""
    if text.isascii() or not _LATER(text):
        return False
    if not _UNASSIGNED:
        _UNASSIGNED.append(np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)]))
    return bool(_UNASSIGNED[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one above 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Arrays for encoding and decoding: symbol of each byte, sorted pair keys with rank and result, bytes of each token."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            content = file.read()
        self.name = hashlib.sha256(content).hexdigest()
        spec = json.loads(content)
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec.get("normalizer"):
            raise ValueError(f"{path} is no byte-level BPE without prefix space")
        ids = model["vocab"]
        self.first = np.array([ids[c] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.joined = np.array([ids[a + b] for a, b in pairs], np.int64)[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in enumerate(letters)}
        size = max([*ids.values(), *self.special.values()]) + 1
        raw = [b""] * size
        for token, i in ids.items():
            raw[i] = bytes(byte_of[c] for c in token)
        for token, i in self.special.items():
            raw[i] = token.encode()
        self.raw = raw
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length


def merge_words(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words in one array, and where each word's ids begin."""
    sizes = np.array([len(w) for w in words], np.int64)
    symbols = v.first[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), sizes)
    done_symbols, done_words = [], []
    worst = len(v.keys)
    while len(symbols):
        rank = np.full(len(symbols), worst, np.int64)
        hit = np.zeros(len(symbols), np.int64)
        if len(symbols) > 1 and worst:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(v.keys, key), worst - 1)
            known = (v.keys[at] == key) & (word[:-1] == word[1:])
            rank[:-1] = np.where(known, v.rank[at], worst)
            hit[:-1] = at
        begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        best = np.minimum.reduceat(rank, begin)
        held = np.diff(np.r_[begin, len(symbols)])
        lowest = np.repeat(best, held)
        # Words without a known pair are ready and leave the array.
        ready = lowest == worst
        if ready.any():
            done_symbols.append(symbols[ready])
            done_words.append(word[ready])
        chosen = (rank == lowest) & ~ready
        # Of overlapping equal pairs, as in "aaa", every other one counts, from the left.
        follows = np.flatnonzero(chosen[1:] & chosen[:-1]) + 1
        if len(follows):
            picked = np.flatnonzero(chosen)
            run = np.r_[True, np.diff(picked) != 1]
            since = np.arange(len(picked)) - np.maximum.accumulate(np.where(run, np.arange(len(picked)), 0))
            chosen[picked[since % 2 == 1]] = False
        symbols = np.where(chosen, v.joined[hit], symbols)
        stays = ~ready
        stays[1:] &= ~chosen[:-1]
        symbols, word = symbols[stays], word[stays]
    if not done_symbols:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.searchsorted(word[order], np.arange(len(words) + 1))


class Encoder:
    """Encodes lists of texts, keeping the ids of words seen before."""

    def __init__(self, vocabulary: Vocabulary, cache: int = CACHE):
        self.v, self.cache = vocabulary, cache
        self.known_split = regex.compile(SPLIT).findall
        self.library_split = pre_tokenizers.Split(Regex(SPLIT), "isolated").pre_tokenize_str
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")").split if special else None
        self._reset()

    def _reset(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for token, i in self.v.special.items():
            self._add([token], np.array([i]), np.array([0, 1]))

    def _add(self, words: list[str], ids: np.ndarray, bounds: np.ndarray) -> None:
        n = len(self.known)
        self.known.update(zip(words, range(n, n + len(words)), strict=True))
        self.start = np.concatenate((self.start, len(self.ids) + bounds[:-1]))
        self.count = np.concatenate((self.count, np.diff(bounds)))
        self.ids = np.concatenate((self.ids, ids))

    def split(self, text: str) -> list[str]:
        return [piece for piece, _ in self.library_split(text)] if later(text) else self.known_split(text)

    def words(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.v.special):
            return self.split(text)
        out: list[str] = []
        for k, part in enumerate(self.cut(text)):
            if k % 2:
                out.append(part)
            else:
                out.extend(self.split(part))
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin."""
        split = [self.words(t) for t in texts]
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in split])))
        if len(self.known) > self.cache:
            self._reset()
        fresh = list(dict.fromkeys(w for ws in split for w in ws if w not in self.known))
        if fresh:
            self._add(fresh, *merge_words([w.encode() for w in fresh], self.v))
        look = self.known.__getitem__
        index = np.fromiter((i for ws in split for i in map(look, ws)), np.int64, int(bounds[-1]))
        count = self.count[index]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.start[index] - ends + count, count) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[bounds]


def decode_bytes(ids: np.ndarray, bounds: np.ndarray, v: Vocabulary) -> list[bytes]:
    """The bytes that each row's ids stand for."""
    size = v.length[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    flat = v.flat[np.repeat(v.start[ids] - ends + size, size) + np.arange(total)].tobytes()
    at = np.concatenate(([0], ends))[bounds]
    return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


_ENCODERS: dict[str, Encoder] = {}


def _worker_encoder(name: str, shared) -> Encoder:
    """The encoder of this Python worker, with the words it knows; the last vocabulary's only."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(shared.value)
    return _ENCODERS[name]


def _spoken(v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decimal ids with a comma behind each, as one array of bytes with starts and lengths."""
    text = [b"%d," % i for i in range(len(v.raw))]
    size = np.array([len(t) for t in text], np.int64)
    return np.frombuffer(b"".join(text), np.uint8), np.cumsum(size) - size, size


def _share(df: DataFrame, path: str):
    """The vocabulary for all tasks, some megabytes whatever the input, and a digest of its file."""
    vocabulary = Vocabulary(path)
    return df.sparkSession.sparkContext.broadcast(vocabulary), vocabulary.name


def encode(df: DataFrame, path: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """`id` (bigint) and `ids` (array of int) of every row."""
    shared, name = _share(df, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(name, shared)
        for batch in batches:
            for lo, hi, texts in string_blocks(batch.column(1)):
                ids, bounds = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), lists], ["id", "ids"])

    picked = df.select(df[id].cast("long").alias("id"), df[text].alias("text"))
    return picked.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id)


def decode(df: DataFrame, path: str, ids: str = "ids", id: str = "doc_id") -> DataFrame:
    """`id` and `text` of every row of token ids; bytes that are no UTF-8 become U+FFFD, NULL gives the empty text."""
    shared, _ = _share(df, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows = [np.array([i for i in r or [] if i is not None], np.int64) for r in part.column(1).to_pylist()]
                bounds = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
                out = decode_bytes(np.concatenate(rows) if rows else np.zeros(0, np.int64), bounds, v)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([o.decode("utf-8", "replace") for o in out], pa.string())], ["id", "text"])

    return df.select(df[id].cast("long").alias("id"), df[ids].cast("array<int>").alias("ids")).mapInArrow(run, "id long, text string").withColumnRenamed("id", id)


def digests(df: DataFrame, path: str, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Encode and decode every row; `n_tokens`, `ids_sha256` (decimal ids joined by commas) and `decoded_sha256` (decoded text)."""
    shared, name = _share(df, path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(name, shared)
        v = encoder.v
        letters, begin, width = _spoken(v)
        for batch in batches:
            for lo, hi, texts in string_blocks(batch.column(1)):
                ids, bounds = encoder.encode(texts)
                size = width[ids]
                ends = np.cumsum(size)
                spoken = letters[np.repeat(begin[ids] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()
                at = np.concatenate(([0], ends))[bounds].tolist()
                said = [hashlib.sha256(spoken[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                back = [hashlib.sha256(o.decode("utf-8", "replace").encode()).hexdigest() for o in decode_bytes(ids, bounds, v)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(said), pa.array(back)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = df.select(df[id].cast("long").alias("id"), df[text].alias("text"))
    return picked.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id)
