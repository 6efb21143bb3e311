"""Approximate nearest neighbours by a permutation index.

A bounded sample of PIVOTS vectors (those of least id hash) orders every vector's pivots from near to far. A
vector is represented by its POSTED nearest pivots in order, and stands with its place in the inverted file of
each of them. All rows are indexed, in blocks of about BLOCK_ROWS. A query reads the files of its own POSTED
nearest pivots only: with missing pivots placed last, the footrule distance of two such permutations is a
constant less 2 (POSTED - the later place), summed over the pivots that both have, which is added up file by
file. The `share` of a block's rows that rank first is measured by exact Euclidean distance, and the k nearest
of all blocks are left. share=1 is the exact search.

Rows stay in their block; the queries travel to each block and stream through it.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no part, as
query or candidate; vectors only meet vectors of their own length; the pivots of all but the LENGTHS most
frequent lengths are drawn at random; rows with the query's id are its own; ties go to the smaller id; with
fewer than k candidates all are returned; an empty table gives no rows; further columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace
from .vectors import usable

PIVOTS, POSTED, SHARE, K = 256, 48, 0.2, 10
LENGTHS, SEED = 16, 11
BLOCK_ROWS = 16384


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """The numbers of each vector's nearest pivots, from near to far."""
    d = (pivots * pivots).sum(1)[None] - 2 * x @ pivots.T
    return np.argsort(d, axis=1, kind="stable")[:, :posted]


class Block:
    """The rows of a block and the inverted files of their pivots."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, posted: int = POSTED):
        by = np.argsort(ids, kind="stable")
        self.ids, self.x, self.pivots = ids[by], x[by], pivots
        self.posted = min(posted, len(pivots))
        order = nearest_pivots(self.x, pivots, self.posted)
        pivot, place = order.ravel(), np.tile(np.arange(self.posted), len(x))
        by = np.argsort(pivot, kind="stable")
        self.row, self.place = (by // self.posted).astype(np.int32), place[by].astype(np.int32)
        self.start = np.searchsorted(pivot[by], np.arange(len(pivots) + 1))

    def search(self, q: np.ndarray, own: np.ndarray, share: float, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each query (its number) the ids and distances of the k nearest that were found."""
        most = min(len(self.x), max(k + 1, ceil(share * len(self.x))))
        for n, files in enumerate(nearest_pivots(q, self.pivots, self.posted)):
            near = np.zeros(len(self.x), np.int64)
            for place, p in enumerate(files.tolist()):
                at = slice(self.start[p], self.start[p + 1])
                near[self.row[at]] += self.posted - np.maximum(self.place[at], place)
            key = -near * len(self.x) + np.arange(len(self.x))  # ties to the smaller id
            some = np.argpartition(key, most - 1)[:most]
            some = some[self.ids[some] != own[n]]
            d = np.sqrt(((self.x[some] - q[n]) ** 2).sum(1))
            best = np.lexsort((self.ids[some], d))[:k]
            yield n, self.ids[some][best], d[best]


def sample_pivots(good: DataFrame, n_pivots: int) -> dict[int, np.ndarray]:
    """Pivots of the most frequent lengths."""
    lengths = [r["dim"] for r in good.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(LENGTHS).collect()]
    first = Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id")
    sample = good.filter(F.col("dim").isin(lengths)).withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n_pivots)
    got = sample.select("dim", "embedding").collect() if lengths else []
    return {d: np.array([r["embedding"] for r in got if r["dim"] == d], np.float64) for d in lengths}


def nearest(rows: DataFrame, is_query: Column, k: int = K, share: float = SHARE, n_pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest rows of (vec_id, embedding)."""
    work = Workspace(rows.sparkSession)
    numbered = rows.filter(usable() & F.col("vec_id").isNotNull()).withColumn("_query", F.coalesce(is_query, F.lit(False)))
    good = numbered.select("vec_id", "_query", F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("dim"))
    pivots = sample_pivots(good, n_pivots)
    queries = work.keep(good.filter("_query").withColumn("uid", F.monotonically_increasing_id()))
    n_blocks = max(1, ceil(good.count() / BLOCK_ROWS))
    block = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(n_blocks)).cast("int")
    names = ["block", "dim", "uid", "vec_id", "embedding"]
    left = good.withColumn("block", block).withColumn("uid", F.lit(None).cast("long")).select(*names)
    right = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).select(*names)
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, built = None, [], None
        for b in batches:
            keys = list(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
            asks = [u is not None for u in b.column(2).to_pylist()]
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or asks[i] != asks[i - 1]), len(keys)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                if keys[s] != key:
                    key, held, built = keys[s], [], None
                dim = key[1]
                ids = b.column(3).slice(s, e - s).to_numpy(zero_copy_only=False)
                x = b.column(4).slice(s, e - s).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                if not asks[s]:
                    held.append((ids, x.copy()))
                    continue
                if built is None and held:
                    p = sent.value.get(dim)
                    p = np.random.default_rng([SEED, dim]).standard_normal((n_pivots, dim)) if p is None else p
                    built = Block(*(np.concatenate(c) for c in zip(*held, strict=True)), p)
                    held = []
                if built is None:
                    continue
                uid = b.column(2).slice(s, e - s).to_numpy(zero_copy_only=False)
                out = [(uid[n], ids[n], found, d) for n, found, d in built.search(x, ids, share, k)]
                sizes = [len(o[2]) for o in out]
                columns = [np.repeat([o[0] for o in out], sizes).astype(np.int64), np.repeat([o[1] for o in out], sizes).astype(np.int64), np.concatenate([o[2] for o in out]).astype(np.int64), np.concatenate([o[3] for o in out])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["uid", "query_id", "vec_id", "score"])

    # a block's rows come first, then the queries
    dealt = left.union(right).repartition("block", "dim").sortWithinPartitions("block", "dim", F.asc_nulls_first("uid"))
    found = dealt.mapInArrow(run, "uid long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy("score", "vec_id")).cast("int")
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
