"""Embedding near-dedup: p-stable hashing of unit vectors, exact cosine checks, components of links.

Each of TABLES tables quantises PROJECTIONS random projections of the normalised vector; vectors with
the same label and the same quantised values share a bucket. Equal vectors of a label are one class from
the start. All pairs of classes in a bucket are checked by cosine in double precision; a pair counts in
the first table where it meets, which the codes of both tell (worked out anew, for linked vectors only), so links are
counted without listing them: a task returns sums per vector and a spanning forest of the links it found. A bucket of more than SPLIT
classes is laid out as pairs of parts, each pair a group of its own.

A pair of cosine 0.93 shares a bucket of some table with probability 0.9992, one of 0.94 with 0.9997; unlike vectors of
64 dimensions share one of a given table with 0.00033 (6 projections of width 1.1: 0.9988 and 0.00071).

Defined cases: a vector that is null, empty, zero or holds null or non-finite components links with
nothing, nor does one without a label; vectors of other lengths than their label's others only meet
vectors of their own length; rows of equal vec_id are separate vectors, each with its own links; an empty
table gives no rows; further columns stay out. Labels may be of any type that casts to string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace
from .components import components, roots

TABLES, PROJECTIONS, WIDTH, SEED = 40, 12, 2.1, 7
SPLIT = 2048
PAIRS_AT_ONCE = 1 << 17


def usable(v: str = "embedding"):
    """True for vectors that are not null, empty or zero and have only finite components."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def units(raw: pa.Array, kind: type) -> list[np.ndarray] | np.ndarray:
    """Unit vectors in double precision of binary values; one matrix if all have the same length."""
    size = pc.binary_length(raw).to_numpy()
    if (size == size[0]).all():
        flat = np.frombuffer(raw.buffers()[2], kind)
        first = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset] // flat.itemsize
        x = flat[first : first + int(size.sum()) // flat.itemsize].reshape(len(raw), -1).astype(np.float64)
        x /= np.abs(x).max(1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    return [units(pa.array([r], pa.binary()), kind)[0] for r in raw.to_pylist()]


def codes(x: np.ndarray) -> np.ndarray:
    """One 32-bit code per table for each unit vector (rows of x)."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    a = rng.standard_normal((x.shape[1], TABLES * PROJECTIONS))
    b = rng.uniform(0, WIDTH, TABLES * PROJECTIONS)
    q = np.floor((x @ a + b) / WIDTH).astype(np.int64).reshape(len(x), TABLES, PROJECTIONS)
    odd = (rng.integers(1 << 62, size=PROJECTIONS) * 2 + 1).astype(np.int64)
    h = (q * odd).sum(2)
    return ((h ^ (h >> 31)) & 0x7FFFFFFF).astype(np.int32)


POSTED = pa.schema([("t", pa.int32()), ("label", pa.int64()), ("code", pa.int32()), ("cid", pa.int64()), ("n", pa.int64()), ("vector", pa.binary())])


def postings(classes: DataFrame, kind: type) -> DataFrame:
    """classes(cid, label, n, embedding) to rows (bucket parts t, label, code; cid, n, vector as given)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = pa.array([x.values.to_numpy().tobytes() for x in b.column(3)], pa.binary())
            sizes = pc.binary_length(raw).to_numpy()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                c = codes(units(raw.take(pa.array(at)), kind))
                each = pa.array(np.repeat(at, TABLES))
                out = {"t": np.tile(np.arange(TABLES, dtype=np.int32), len(at)), "code": c.ravel(), "vector": raw.take(each)}
                out |= {name: b.column(name).take(each) for name in ("cid", "label", "n")}
                yield pa.RecordBatch.from_pydict(out, schema=POSTED)

    return classes.select("cid", "label", "n", "embedding").mapInArrow(run, "t int, label long, code int, cid long, n long, vector binary")


def pairs_of(first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All i < j inside each run (first, size), PAIRS_AT_ONCE or one row's partners at a time."""
    run = np.repeat(np.arange(len(first)), size - 1)
    place = np.arange(len(run)) - (np.cumsum(size - 1) - (size - 1))[run]
    left, much = first[run] + place, size[run] - 1 - place
    upto, at = np.cumsum(much), 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        i = np.repeat(left[at:to], much[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(much[at:to]) - much[at:to], much[at:to])
        yield i, j
        at = to


def codes_of(x: np.ndarray | list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The codes of some rows of what units() gave."""
    if isinstance(x, np.ndarray):
        return codes(x[rows])
    return np.concatenate([codes(x[r][None]) for r in rows.tolist()])


def links(cells: DataFrame, least: float, kind: type) -> DataFrame:
    """cells(cell, part, whole, t, label, cid, n, vector), a cell's rows together: rows (a, b, n).

    With b = null: n more vectors are linked with a. Else: a and b are connected. A cell's number is a hash; where two
    cells have the same, only vectors of one label and one bucket count as a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def work(t: pa.Table) -> Iterator[pa.RecordBatch]:
            cell = t.column("cell").to_numpy()
            cut = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            size = np.diff(np.r_[cut, len(cell)])
            cut, size = cut[size > 1], size[size > 1]
            if not len(cut):
                return
            part, whole, table, label, cid, n = (t.column(k).to_numpy() for k in ("part", "whole", "t", "label", "cid", "n"))
            x = units(t.column("vector").combine_chunks(), kind)
            code, known = np.zeros((len(cid), TABLES), np.int32), np.zeros(len(cid), bool)
            linked, found = np.zeros(len(cid), np.int64), []
            for i, j in pairs_of(cut, size):
                ok = ((part[i] != part[j]) | whole[i]) & (label[i] == label[j]) & (table[i] == table[j])  # inside a part, pairs count in one cell only
                i, j = i[ok], j[ok]
                if isinstance(x, np.ndarray):
                    cos = np.einsum("ij,ij->i", x[i], x[j])
                else:
                    cos = np.array([x[u] @ x[v] if len(x[u]) == len(x[v]) else -2.0 for u, v in zip(i.tolist(), j.tolist(), strict=True)])
                ok = cos >= least
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                found.append((i, j))
                new = np.unique(np.r_[i, j])
                new = new[~known[new]]
                if len(new):
                    code[new], known[new] = codes_of(x, new), True
                same = code[i] == code[j]
                ok = same.argmax(1) == table[i]  # the first table in which the two meet
                np.add.at(linked, i[ok], n[j[ok]])
                np.add.at(linked, j[ok], n[i[ok]])
            if not found:
                return
            i, j = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            ids, num = np.unique(cid, return_inverse=True)
            root = roots(len(ids), num[i], num[j])
            some = np.flatnonzero(root != np.arange(len(ids)))
            total = np.bincount(num, weights=linked, minlength=len(ids)).astype(np.int64)
            lit = np.flatnonzero(total)
            a = pa.array(np.r_[ids[lit], ids[some]], pa.int64())
            b = pa.array([None] * len(lit) + ids[root[some]].tolist(), pa.int64())
            yield pa.RecordBatch.from_pydict({"a": a, "b": b, "n": pa.array(np.r_[total[lit], np.zeros(len(some), np.int64)], pa.int64())})

        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column(0).to_numpy()
            first = next(iter(np.flatnonzero(cell != last).tolist()), len(cell)) if held else 0
            if held:
                held.append(b.slice(0, first))
                if first == len(cell):
                    continue
                yield from work(pa.Table.from_batches(held))
                held = []
            # whole cells now; the last one may go on in the next batch
            tail = next(iter(np.flatnonzero(cell != cell[-1])[::-1].tolist()), -1) + 1
            if tail > first:
                yield from work(pa.Table.from_batches([b.slice(first, tail - first)]))
            held, last = [b.slice(max(tail, first))], cell[-1]
        if held:
            yield from work(pa.Table.from_batches(held))

    return cells.mapInArrow(run, "a long, b long, n long")


def near_duplicates(rows: DataFrame, least: float = 0.93, split: int = SPLIT) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of (vec_id, embedding, label)."""
    work = Workspace(rows.sparkSession)
    kind = np.float32 if rows.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    usable_row = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.select("vec_id", "label", "embedding").withColumn("_ok", usable_row)
    # equal vectors of a label are one class from here on, named by a hash, since ids may stand on several vectors
    sig = F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string"))), 256)
    good = rows.filter("_ok").withColumn("label", F.xxhash64(F.col("label").cast("string"))).withColumn("cid", F.xxhash64("label", sig))
    classes = good.groupBy("label", "cid").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    classes = work.keep(classes)
    posted = post = work.keep(postings(classes, kind))
    hot = post.groupBy("t", "label", "code").count().filter(F.col("count") > split)
    hot = work.keep(hot.select("t", "label", "code", F.ceil(F.col("count") / split).cast("int").alias("parts")))
    post = post.join(hot, ["t", "label", "code"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("cid"), F.col("parts"))).otherwise(0).cast("int")
    post = post.withColumn("part", part).withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    cell = F.xxhash64("t", "label", "code", low, high)
    cells = post.select(cell.alias("cell"), "part", (low == high).alias("whole"), "t", "label", "cid", "n", "vector")
    cells = cells.repartition("cell").sortWithinPartitions("cell")
    found = work.keep(links(cells, least, kind))
    work.drop(posted)
    counts = found.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("more"))
    comp = components(found.filter("b IS NOT NULL").select("a", "b"), work)
    told = classes.select("cid", "rep", "n").join(counts, F.col("cid") == F.col("a"), "left").join(comp, F.col("cid") == F.col("node"), "left")
    told = work.keep(told.select("cid", "rep", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"), F.coalesce("component", "cid").alias("c")))
    smallest = work.keep(told.groupBy("c").agg(F.min("rep").alias("component_id")))
    told = work.keep(told.join(smallest, "c").select("cid", "n_links", "component_id"))
    linked = good.select("vec_id", "cid").join(told, "cid").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT _ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
