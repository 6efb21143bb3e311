"""Connected components by randomised contraction, on DataFrames throughout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, frugal


#: Edges that one task finishes by itself (16 bytes each); more are contracted by rounds until so few are left.
AT_ONCE = 1 << 17


def at_once(edges: DataFrame) -> DataFrame:
    """v and the node `to` it stands for, of a bounded number of edges, in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
        if ends:
            a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
            nodes, num = np.unique(np.r_[a, b], return_inverse=True)
            root = roots(len(nodes), num[: len(a)], num[len(a) :])
            yield pa.RecordBatch.from_pydict({"v": pa.array(nodes, pa.int64()), "to": pa.array(nodes[root], pa.int64())})

    return edges.select("a", "b").coalesce(1).mapInArrow(frugal("components", run), "v long, to long")


def components(edges: DataFrame, work: Workspace, most_rounds: int = 60, at_most: int = AT_ONCE) -> DataFrame:
    """node and component (the smallest node of it) for every node of edges(a, b); longs without nulls.

    Each round every node moves onto the neighbour (or itself) of least hash, with another hash each
    round, and the edges between merged nodes go; an expected constant share of nodes is left after a
    round, chains and stars alike. Sums of a hub's edges are formed before the shuffle, and each round's
    tables are written to the shared folder. The last at_most edges are joined in one task.
    """
    live = edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live = work.keep(live)
    names: DataFrame | None = None  # node and the node it stands for by now
    for n in range(most_rounds):
        left = live.count()
        if not left:
            break
        if left <= at_most:
            to = work.keep(at_once(live))
        else:
            order = lambda c: F.struct(F.xxhash64(F.lit(n), c).alias("h"), c.alias("v"))  # noqa: B023, E731
            both = live.select("a", "b").union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
            best = both.groupBy("a").agg(F.min(order(F.col("b"))).alias("best"))
            to = work.keep(best.select(F.col("a").alias("v"), F.least(order(F.col("a")), F.col("best"))["v"].alias("to")))
        before, step = names, to.select(F.col("v").alias("now"), "to")
        if names is None:
            names = work.keep(to.select(F.col("v").alias("node"), F.col("to").alias("now")))
        else:
            names = work.keep(names.join(step, "now", "left").select("node", F.coalesce("to", "now").alias("now")))
            work.drop(before)
        if left <= at_most:
            work.drop(live, to)
            break
        moved = live.join(to.toDF("a", "a2"), "a").join(to.toDF("b", "b2"), "b").filter("a2 != b2")
        old = live
        live = work.keep(moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct())
        work.drop(old, to)
    else:
        raise RuntimeError(f"edges are left after {most_rounds} rounds")
    if names is None:
        return work.spark.createDataFrame([], "node long, component long")
    least = names.groupBy("now").agg(F.min("node").alias("component"))
    return work.keep(names.join(least, "now").select("node", "component"))


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n numbers the smallest it is connected with by the pairs (i, j), within one task."""
    lab = np.arange(n)
    while len(i):
        m = np.minimum(lab[i], lab[j])
        np.minimum.at(lab, lab[i], m)
        np.minimum.at(lab, lab[j], m)
        while (lab[lab] != lab).any():
            lab = lab[lab]
        open_ = lab[i] != lab[j]
        i, j = i[open_], j[open_]
    return lab
