"""Byte-level BPE encoding and decoding by a pair occurrence index.

Each task gathers the distinct words of a block of texts, lays their bytes end to end as symbols, and
maps every mergeable pair to all its positions. Active ranks leave a heap in ascending order; a rank is
applied to all its positions at once, and the pairs that its merges make are added to the lists of
their own ranks. Words seen before by the same worker are looked up (a bounded cache).

Defined cases: a null text counts as empty; an empty text has no tokens; lone special-token strings in a
text become their special id, as the tokenizers library does; repeated rows each give a row; an empty table
gives no rows; very long texts are taken whole, one at a time, and its list of words is what they cost; other
columns pass through `encode` and `decode` untouched, which refuse columns named as the added ones.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import chunks, frugal, keeps, small_batches

#: Fixed value: the word pattern of the byte-level pre-tokenizer. White space is Unicode's property, which leaves U+001C to U+001F out.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: The same classes for characters below U+0250 and common dashes and quotes, for which Python's own engine is faster.
NEAR = "\x00-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf"
NEAR_LETTER, NEAR_NUMBER, NEAR_SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
NEAR_WORDS = rf" ?[{NEAR_LETTER}]+| ?[{NEAR_NUMBER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{NEAR_SPACE}{NEAR_LETTER}{NEAR_NUMBER}]+|[{NEAR_SPACE}]+(?![^{NEAR_SPACE}])|[{NEAR_SPACE}]+"
CACHED_WORDS = 150_000
BLOCK = 2 << 20


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(plain))
    stand = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [stand[b] for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.width = 1 + max(vocab.values())
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys = self.left * self.width + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens", [])}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t, i in vocab.items()}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.all_words, self.near_words, self.far = regex.compile(WORDS), re.compile(NEAR_WORDS), re.compile(f"[^{NEAR}]")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cache: dict[str, tuple[int, ...]] = {}
        self.said: dict[str, str] = {}  # a word's ids in decimal, and the bytes that they decode to
        self.back: dict[str, bytes] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; -1 where no merge has it."""
        k = a * self.width + b
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[i] == k, self.order[i], -1)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each non-empty word, by the pair occurrence index over all of them."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self.ranks(sym[at], sym[after[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            by = np.argsort(rank, kind="stable")
            at, rank = at[by], rank[by]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            starts = [0, *cuts.tolist(), len(at)]
            for r, s, e in zip(rank[starts[:-1]].tolist(), starts, starts[1:], strict=False):
                if r in index:
                    index[r].append(at[s:e])
                else:
                    index[r] = [at[s:e]]
                    heapq.heappush(heap, r)

        add(np.flatnonzero(after >= 0))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            a, b, c = self.left[r], self.right[r], self.made[r]
            at = at[sym[at] == a]
            to = after[at]
            live = to >= 0
            live &= sym[to] == b
            at, to = at[live], to[live]
            if a == b and len(at) > 1:  # of a run of overlapping places, every second is taken, from the left
                took, last = [], -1
                for i, j in zip(at.tolist(), to.tolist(), strict=True):
                    if i != last:
                        took.append(i)
                        last = j
                    else:
                        last = -1
                at = np.array(took)
                to = after[at]
            if not len(at):
                continue
            far = after[to]
            sym[at], sym[to], after[at] = c, -1, far
            has = far >= 0
            before[far[has]] = at[has]
            prior = before[at]
            add(np.concatenate([prior[prior >= 0], at[has]]))
        alive = sym >= 0
        ids = sym[alive].tolist()
        upto = np.cumsum(alive)[ends - 1].tolist()
        return [tuple(ids[s:e]) for s, e in zip([0, *upto[:-1]], upto, strict=True)]

    def learn(self, pieces: set[str]) -> None:
        """Brings the words into the cache, which is emptied first when it would grow past its bound."""
        new = [w for w in pieces if w not in self.cache]
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = list(pieces)
        self.cache.update(zip(new, self.merge([w.encode("utf-8", "surrogatepass") for w in new]), strict=True))

    def tell(self, pieces: set[str]) -> None:
        """What learn() does, for the decimal ids and decoded bytes of words; both are worked out once a word."""
        new = [w for w in pieces if w not in self.said]
        if len(self.said) + len(new) > CACHED_WORDS:
            self.said.clear()
            self.back.clear()
            new = list(pieces)
        for w, ids in zip(new, self.merge([w.encode("utf-8", "surrogatepass") for w in new]), strict=True):
            self.said[w] = ",".join(map(str, ids))
            self.back[w] = b"".join(map(self.bytes_of.__getitem__, ids))
        for s, i in self.special.items():
            self.said[s], self.back[s] = str(i), self.bytes_of[i]

    def words(self, text: str) -> list[str]:
        return (self.near_words if text.isascii() or not self.far.search(text) else self.all_words).findall(text)

    def split(self, text: str) -> list[str]:
        """The words of a text in order; a special token is a word of its own."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.words(text)
        return list(chain.from_iterable([x] if x in self.special else self.words(x) for x in self.cut.split(text) if x))

    def encode_batch(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, all of them in the cache afterwards."""
        words = [self.split(t) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(words)))
        self.cache.update({s: (i,) for s, i in self.special.items()})
        return words

    def ids(self, words: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.cache.__getitem__, words)))

    def decode(self, ids: list[int]) -> str:
        """Unknown ids are skipped; bytes that are not UTF-8 become replacement characters."""
        return b"".join(self.bytes_of.get(i, b"") for i in ids).decode("utf-8", "replace")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        keeps("bpe", _encoders.clear)
    return _encoders[path]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """df with the column `ids` array<int> added."""
    if ids in df.columns:
        raise ValueError(f"there is a column {ids} already")
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for t in chunks(batches, text, BLOCK):
            got = pa.array([e.ids(w) for w in e.encode_batch(t.column(text).to_pylist())], pa.list_(pa.int32()))
            yield from t.append_column(ids, got).to_batches()

    return df.mapInArrow(frugal("bpe", run), T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with the column `decoded` string added; null ids give null."""
    if decoded in df.columns:
        raise ValueError(f"there is a column {decoded} already")
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            got = [None if x is None else e.decode(x) for x in b.column(b.schema.get_field_index(ids)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], names=[*b.schema.names, decoded])

    return df.mapInArrow(frugal("bpe", run), T.StructType([*df.schema.fields, T.StructField(decoded, T.StringType())]))


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids_sha256 and decoded_sha256 of each row: encode and decode fused in one pass,
    so that neither ids nor texts leave the Python worker. A word's ids are decoded once a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for t in chunks(batches, text, BLOCK):
            words = [e.split(x) if x else [] for x in t.column(text).to_pylist()]
            e.tell(set(chain.from_iterable(words)))
            ids = [",".join(map(e.said.__getitem__, w)) for w in words]
            n = [x.count(",") + 1 if x else 0 for x in ids]
            of_ids = [sha256(x.encode()).hexdigest() for x in ids]
            of_text = [sha256(b"".join(map(e.back.__getitem__, w)).decode("utf-8", "replace").encode()).hexdigest() for w in words]
            yield pa.RecordBatch.from_arrays([t.column(key).combine_chunks(), pa.array(n, pa.int64()), pa.array(of_ids), pa.array(of_text)], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(key, text).mapInArrow(frugal("bpe", run), T.StructType([df.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]))
