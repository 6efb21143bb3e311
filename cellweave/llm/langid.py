"""Multilingual mixture inference: which languages a document is written in, and how much of each.

Training counts letter n-grams per language, hashed to a fixed number of buckets, over a bounded sample of
labelled documents (about TRAIN_DOCUMENTS of each language, chosen by a hash of the id). A document is
cut into segments of GRAMS n-grams; expectation-maximisation estimates each language's share of the
segments from their n-gram likelihoods. The language set starts from the best single language and takes
further ones, in the order of the shares under all languages, as long as the likelihood, less a penalty
for each language, grows. The prediction is the language with the largest share in the chosen set.

Shares are relative, so they can't tell that a text is in none of the languages. For that a text's likelihood
is held against what a language's own trigrams have, each left out of its count: a text fits unless it falls
short by more than SLACK for each trigram and DEVIATIONS standard deviations. keep_identified asks for it.

All texts of a block are worked on side by side. Whole texts are read; the model (languages times
buckets) is all that reaches the driver.

Defined cases: a text that is null or has no letter is `und` with score 0, as is every text if nothing
can be learned; a null id is not held out; ties go to the language that sorts first; repeated rows each give
a row; an empty table gives no rows; other columns stay out of the result of predict_all, and identify refuses
columns that bear the names it adds. Very long texts are taken whole, PIECE characters at a time: pieces end at
white space (or after twice as many characters without any) and segments start anew there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, frugal

TRAIN_DOCUMENTS = 2000
BUCKETS = 1 << 15
GRAMS = 12
ROUNDS = 12
#: Log-likelihood that a further language must gain, per natural logarithm of the segments.
PENALTY = 3.0
SMOOTHING = 0.5
#: Log-likelihood a trigram that a text may lack against its languages' own, and the spread allowed on top: wide, since
#: neighbouring trigrams share letters and short clean texts may be half tokens and numbers.
SLACK, DEVIATIONS = 2.0, 8.0
BLOCK = 1 << 20
PIECE = 1 << 17

_space = re.compile(r"\s")
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    global _letters
    if _letters is None:
        t = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                t[i] = ord(low) if len(low := c.lower()) == 1 else i
        _letters = t
    return _letters


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every trigram, the text it stands in, and the number of letters of each text.

    Runs of other characters count as one gap; each text has a gap before and after it."""
    flat = np.frombuffer("\0".join(["", *(t or "" for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) if t else 0 for t in texts])
    of = np.repeat(np.arange(len(texts) + 1), [1, *(sizes + 1)])
    c = letters()[flat]
    n_letters = np.bincount(of[1:] - 1, c[1:] > 0, len(texts)).astype(np.int64) if len(texts) else np.zeros(0, np.int64)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] > 0) | (c[:-1] > 0) | (of[1:] != of[:-1])
    c, of = c[keep].astype(np.uint64), of[keep]
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n_letters
    h = c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ c[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ c[2:] * np.uint64(0x165667B19E3779F9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    some = (c[1:-1] > 0) & (of[1:-1] > 0)
    return ((h >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)[some], (of[1:-1] - 1)[some], n_letters


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The texts in parts of bounded size: the number of each part's text, and the part."""
    owner, held, size = [], [], 0
    for i, t in enumerate(texts):
        at = 0
        while t and at < len(t):
            end = at + PIECE
            if end < len(t):
                gap = _space.search(t, end, end + PIECE)
                end = gap.start() if gap else end + PIECE
            owner.append(i)
            held.append(t[at:end])
            size += len(held[-1])
            at = end
            if size >= PIECE:
                yield np.array(owner), held
                owner, held, size = [], [], 0
    if held:
        yield np.array(owner), held


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # buckets x languages
    own: np.ndarray  # mean and variance of log_p over each language's trigrams (2 x languages)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], np.ndarray]:
        """Language, its share and all shares (texts x languages)."""
        return self.judge(texts)[:3]

    def segments(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each segment the log-likelihood in each language, the text it stands in and its number of n-grams;
        and the number of letters of each text."""
        n_letters = np.zeros(len(texts), np.int64)
        told = [(np.zeros((0, len(self.languages))), np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for owner, parts in pieces(texts) if self.languages else ():
            bucket, of, letters_of = grams(parts)
            np.add.at(n_letters, owner, letters_of)
            if len(bucket):
                starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
                inside = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)]))
                cuts = np.flatnonzero(inside % GRAMS == 0)
                ll = np.add.reduceat(self.log_p[bucket], cuts, axis=0).astype(np.float64)
                told.append((ll, owner[of[cuts]], np.diff(np.r_[cuts, len(of)])))
        return *(np.concatenate(x) for x in zip(*told, strict=True)), n_letters

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float], np.ndarray, np.ndarray]:
        """What predict() tells, and whether each text is as likely as texts of its segments' languages are."""
        n, k = len(texts), len(self.languages)
        fits = np.zeros(n, bool)
        shares = np.zeros((n, k))
        ll, seg, n_grams, n_letters = self.segments(texts)
        if not len(seg):
            return ["und"] * n, [0.0] * n, shares, fits
        docs, first, size = np.unique(seg, return_index=True, return_counts=True)
        per = np.repeat(np.arange(len(docs)), size)
        total = np.add.reduceat(ll, first, axis=0)  # one language for all of a document
        best = total.argmax(1)
        peak = ll.max(1, keepdims=True)
        like = np.exp(ll - peak)
        base = np.add.reduceat(peak[:, 0], first)
        mean, variance = (np.add.reduceat(n_grams * x[ll.argmax(1)], first) for x in self.own)
        fits[docs] = base - mean >= -SLACK * np.add.reduceat(n_grams, first) - DEVIATIONS * np.sqrt(variance)

        def fit(rows: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Shares and log-likelihood of the documents numbered `rows`, with the languages allowed to each."""
            pick = np.flatnonzero(np.isin(per, rows)) if len(rows) < len(docs) else np.arange(len(per))
            at = np.searchsorted(rows, per[pick])
            start = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            pi = allowed / allowed.sum(1, keepdims=True)
            p = like[pick]
            for _ in range(ROUNDS):
                joint = p * pi[at]
                norm = joint.sum(1, keepdims=True)
                pi = np.add.reduceat(joint / np.maximum(norm, 1e-300), start, axis=0) / size[rows][:, None]
            norm = (p * pi[at]).sum(1)
            return pi, np.add.reduceat(np.log(np.maximum(norm, 1e-300)), start) + base[rows]

        everything = np.arange(len(docs))
        full, _ = fit(everything, np.ones((len(docs), k)))
        chosen = np.zeros((len(docs), k))
        chosen[everything, best] = 1
        pi, score = chosen.copy(), total[everything, best]
        full[everything, best] = 2.0  # the best single language stands first in the order
        order = np.argsort(-full, axis=1, kind="stable")
        live = everything
        for m in range(1, k):
            allowed = np.zeros((len(live), k))
            np.put_along_axis(allowed, order[live][:, : m + 1], 1.0, axis=1)
            got, value = fit(live, allowed)
            better = value - PENALTY * np.log1p(size[live]) > score[live]
            live_better = live[better]
            pi[live_better], score[live_better] = got[better], value[better] - PENALTY * np.log1p(size[live_better])
            live = live_better
            if not len(live):
                break
        shares[docs] = pi
        shares[n_letters == 0] = 0
        top = shares.argmax(1)
        value = np.clip(shares[np.arange(n), top], 0, 1)
        return [self.languages[i] if v > 0 else "und" for i, v in zip(top.tolist(), value.tolist(), strict=True)], value.tolist(), shares, fits


def train(labelled: DataFrame, per_language: int = TRAIN_DOCUMENTS, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """labelled: rows with a text and a language. Learns from about per_language of each language's rows, or all if fewer."""
    labelled = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[lang]: r["count"] for r in labelled.groupBy(lang).count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((2, 0)))
    keep = F.lit(False)
    draw = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1_000_000))
    for name in languages:
        keep = keep | ((F.col(lang) == name) & (draw < 1_000_000 * min(1.0, per_language / counts[name])))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for t in chunks(batches, text, BLOCK):
            names = np.array(t.column(lang).to_pylist(), dtype=object)
            for owner, parts in pieces(t.column(text).to_pylist()):
                bucket, of, _ = grams(parts)
                named = names[owner[of]]
                for name in set(named.tolist()):
                    sums[name] = sums.get(name, 0) + np.bincount(bucket[named == name], minlength=BUCKETS)
        for name, s in sums.items():
            at = np.flatnonzero(s)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * len(at), pa.string()), "bucket": pa.array(at, pa.int32()), "n": pa.array(s[at], pa.int64())})

    seen = labelled.filter(keep).select(text, lang).mapInArrow(frugal("langid", count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    n = np.zeros((BUCKETS, len(languages)))
    got = seen.toPandas()
    n[got["bucket"].to_numpy(), [languages.index(x) for x in got["lang"]]] = got["n"]
    p = (n + SMOOTHING) / (n.sum(0, keepdims=True) + SMOOTHING * BUCKETS)
    # each trigram is told without itself, else a few documents would seem likelier than any other can be
    total = np.maximum(n.sum(0), 1)
    others = np.log((np.maximum(n - 1, 0) + SMOOTHING) / (total - 1 + SMOOTHING * BUCKETS))
    mean = (n * others).sum(0) / total
    return Model(languages, np.log(p).astype(np.float32), np.stack([mean, (n * (others - mean) ** 2).sum(0) / total]))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The `keep` columns (all if None) with lang_pred, score and shares (map of the languages with a share)."""
    keep = docs.columns if keep is None else keep
    if {"lang_pred", "score", "shares"} & set(keep):
        raise ValueError("lang_pred, score and shares are columns of the result; rename or leave out those of the input")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for t in chunks(batches, text, BLOCK):
            pred, score, shares = m.predict(t.column(text).to_pylist())
            maps = [[(m.languages[i], float(row[i])) for i in np.flatnonzero(row > 1e-3).tolist()] for row in shares]
            t = t.select(keep).append_column("lang_pred", pa.array(pred, pa.string())).append_column("score", pa.array(score, pa.float64()))
            yield from t.append_column("shares", pa.array(maps, pa.map_(pa.string(), pa.float64()))).to_batches()

    fields = [docs.schema[c] for c in keep]
    rows = docs.select(*dict.fromkeys([*keep, text]))
    return rows.mapInArrow(frugal("langid", run), T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("shares", T.MapType(T.StringType(), T.DoubleType()))]))


def keep_identified(docs: DataFrame, least: float, text: str = "text", lang: str = "lang", fill: bool = False) -> DataFrame:
    """The rows of docs whose text has letters, one language with at least that share, and the likelihood of learned
    languages. Columns are as they are; with `fill` a null language becomes the predicted one."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, lang=lang, text=text))
    at = docs.columns.index(lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for t in chunks(batches, text, BLOCK):
            pred, score, _, fits = m.judge(t.column(text).to_pylist())
            named = [p if x is None and fill else x for x, p in zip(t.column(lang).to_pylist(), pred, strict=True)]
            t = t.set_column(at, t.schema.field(at), pa.array(named, t.schema.field(at).type))
            yield from t.filter(pa.array([p != "und" and s >= least and f for p, s, f in zip(pred, score, fits.tolist(), strict=True)], pa.bool_())).to_batches()

    return docs.mapInArrow(frugal("langid", run), docs.schema)


def predict_all(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; the held-out third is never learned from."""
    model = train(docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    told = identify(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
