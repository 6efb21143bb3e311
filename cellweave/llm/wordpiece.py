"""Greedy longest-match piece counts by a linear automaton over the vocabulary trie.

Every trie node keeps a failure link and the number of pieces that are popped when it is followed, so a
word's count is the sum of popped counts along one left-to-right pass; no piece is ever built. The
vocabulary's pieces are byte strings; with all 256 single bytes among them every word can be matched.
A word is what stands between white space, with one space before it. Vocabularies whose pieces differ
inside a word (WordPiece's continuations) have a second root, at which every match after the first starts;
their words have no space before them, and a word that pieces can't cover is one unknown piece.

Defined cases: null and empty texts have 0 words and 0 pieces; a word with a byte that no piece covers
counts as one unknown piece; repeated rows each give a row; ties don't arise, the longest piece is unique; very
long texts are taken whole, in blocks of rows, and words longer than SIDE_BY_SIDE bytes one by one; an empty table
gives no rows; other columns, whatever their names, stay out of the result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import byte_alphabet
from .common import chunks

CACHED_WORDS = 200_000
BLOCK = 4 << 20
#: Words up to so many bytes run side by side; longer ones one by one.
SIDE_BY_SIDE = 64


def byte_level_pieces(path: str) -> list[bytes]:
    """The vocabulary of a byte-level tokenizer file, special tokens left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    special = {x["content"] for x in spec.get("added_tokens", [])}
    return [bytes(byte_of[c] for c in t) for t in spec["model"]["vocab"] if t not in special]


def word_pieces(path: str) -> tuple[list[bytes], list[bytes]]:
    """The pieces that start a word and those that go on in one, of a WordPiece tokenizer file without special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    mark = spec["model"].get("continuing_subword_prefix", "##")
    special = {x["content"] for x in spec.get("added_tokens", [])} | {spec["model"].get("unk_token")}
    vocab = [t for t in spec["model"]["vocab"] if t not in special]
    inner = [t for t in vocab if mark and t.startswith(mark) and t != mark]
    return [t.encode() for t in vocab if t not in set(inner)], [t[len(mark) :].encode() for t in inner]


class Automaton:
    """Node 0 is the root, -1 no node. With continuation pieces, node 1 is the root of those."""

    def __init__(self, pieces: Iterable[bytes], following: Iterable[bytes] | None = None, lead: bytes = b" "):
        self.roots, self.lead = 1 if following is None else 2, lead
        again = self.roots - 1  # where the next piece of a word starts
        goto: dict[int, int] = {}
        depth, parent, byte, last = ([x] * self.roots for x in (0, -1, 0, False))
        for u, piece in [(0, p) for p in sorted(set(pieces) - {b""})] + [(1, p) for p in sorted(set(following or ()) - {b""})]:
            for c in piece:
                v = goto.get(u << 8 | c)
                if v is None:
                    goto[u << 8 | c] = v = len(depth)
                    depth.append(depth[u] + 1)
                    parent.append(u)
                    byte.append(c)
                    last.append(False)
                u = v
            last[u] = True
        fail, pops = [-1] * len(depth), [0] * len(depth)
        for v in sorted(range(self.roots, len(depth)), key=depth.__getitem__):
            if last[v]:
                fail[v], pops[v] = again, 1
                continue
            z, n = fail[parent[v]], pops[parent[v]]
            while z >= 0 and (z << 8 | byte[v]) not in goto:
                n += pops[z]
                z = fail[z]
            if z >= 0:
                fail[v], pops[v] = goto[z << 8 | byte[v]], n
        self.goto, self.fail, self.pops = goto, np.array(fail), np.array(pops)
        self.keys = np.array(sorted(goto), dtype=np.int64)
        self.to = np.array([goto[k] for k in self.keys.tolist()], dtype=np.int64)
        self.fails, self.popped = fail, pops
        self.cache: dict[str, int] = {}

    def step(self, u: np.ndarray, c: np.ndarray) -> np.ndarray:
        k = u << 8 | c
        i = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        return np.where(self.keys[i] == k, self.to[i], -1)

    def count(self, word: bytes) -> int:
        """One word, byte by byte."""
        u = n = 0
        for c in word:
            while (v := self.goto.get(u << 8 | c, -1)) < 0:
                n += self.popped[u]
                if (u := self.fails[u]) < 0:
                    return 1
            u = v
        while u >= self.roots:
            n += self.popped[u]
            if (u := self.fails[u]) < 0:
                return 1
        return n

    def counts(self, words: list[bytes]) -> np.ndarray:
        """All words side by side, a byte of each per step; words of like length stay together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(words), np.int64)
        short = np.flatnonzero(sizes <= SIDE_BY_SIDE)
        for i in np.flatnonzero(sizes > SIDE_BY_SIDE).tolist():
            out[i] = self.count(words[i])
        short = short[np.argsort(-sizes[short], kind="stable")]
        if not len(short):
            return out
        size = sizes[short]
        flat = np.frombuffer(b"".join(words[i] for i in short.tolist()), np.uint8).astype(np.int64)
        start = np.cumsum(size) - size
        u, n, lost = np.zeros(len(short), np.int64), np.zeros(len(short), np.int64), np.zeros(len(short), bool)
        for t in range(int(size[0]) + 1):
            if t <= int(size[0]) - 1:
                on = int(np.searchsorted(-size, -t, side="left"))  # those longer than t
                todo = np.flatnonzero(~lost[:on])
                c = flat[start[todo] + t]
                while len(todo):
                    v = self.step(u[todo], c)
                    ok = v >= 0
                    u[todo[ok]] = v[ok]
                    todo, c = todo[~ok], c[~ok]
                    n[todo] += self.pops[u[todo]]
                    u[todo] = self.fail[u[todo]]
                    gone = u[todo] < 0
                    lost[todo[gone]] = True
                    todo, c = todo[~gone], c[~gone]
        todo = np.flatnonzero(~lost & (u >= self.roots))
        while len(todo):
            n[todo] += self.pops[u[todo]]
            u[todo] = self.fail[u[todo]]
            lost[todo[u[todo] < 0]] = True
            todo = todo[u[todo] >= self.roots]
        out[short] = np.where(lost, 1, n)
        return out

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = list(words)
        self.cache.update(zip(new, self.counts([self.lead + w.encode("utf-8", "surrogatepass") for w in new]).tolist(), strict=True))


_automata: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    if path not in _automata:
        with open(path, encoding="utf-8") as f:
            kind = json.load(f)["model"].get("type")
        _automata[path] = Automaton(*word_pieces(path), lead=b"") if kind == "WordPiece" else Automaton(byte_level_pieces(path))
    return _automata[path]


def piece_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words and n_pieces of each row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = automaton(path)
        for t in chunks(batches, text, BLOCK):
            words = [x.split() if x else [] for x in t.column(text).to_pylist()]
            a.learn(set(chain.from_iterable(words)))
            n = [sum(map(a.cache.__getitem__, w)) for w in words]
            yield pa.RecordBatch.from_arrays([t.column(key).combine_chunks(), pa.array(map(len, words), pa.int64()), pa.array(n, pa.int64())], names=[key, "n_words", "n_pieces"])

    return df.select(key, text).mapInArrow(run, T.StructType([df.schema[key], T.StructField("n_words", T.LongType()), T.StructField("n_pieces", T.LongType())]))
