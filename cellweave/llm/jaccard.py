"""N-gram Jaccard join by a size-aware split into light and heavy sets.

A document's set is its distinct word n-grams (64-bit hashes). Documents with equal sets are one node
from the start. All n-grams are put in one global order, by a frequency sketch over the whole corpus and
then by hash, so rare ones come first and passages that many documents share come last. Two sets whose
Jaccard similarity reaches the threshold share at least k n-grams of their (size - overlap + k)-prefixes:

* light sets, up to a boundary in size, list every 2-subset of their prefix (k = 2);
* heavy sets, and light ones that a heavy one could match, list the n-grams of their prefix (k = 1),
  whose inverted lists are scanned.

The boundary is the size at which subsets listed plus lists scanned cost least, by the corpus's sizes and
the sketch's mean list length. In each list, sets sorted by size first meet their leader only (the
smallest set of near enough size); what these exact checks join is one component. Of the lists whose sets
are still in different components, those of at most SHORT sets (of near sizes) are listed in pairs that pass the length
and positional filters and meet often enough. The sets of longer lists are posted anew, with the n-grams of
long lists last in the order, which parts those that share a passage only. Where lists are still long (near
copies of one text), sets are described by what they have apart from a leader they share, and those differences
are joined by prefixes of their own, in order of their exact frequency: see around_leaders(). All pairs left are checked
exactly, so each link is either found or lies within a component that is already joined: no pair is
capped, and the pairs inside a group of thousands of near copies are not listed.

Hashes of different n-grams or sets are taken to differ (64 bits). Defined cases: without words or text,
and without a doc_id, a document's set links with nothing; a text of fewer than n words is one n-gram;
very long texts are taken whole; rows of equal doc_id each give a row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, admitted, chunks, frugal, keeps, mix64
from .components import components

WORDS_PER_GRAM = 5
PERCENT = 75
SKETCH = 1 << 20
#: Buckets that a row of the sketch holds.
SLICE = 1 << 14
#: No set above this size is light: its subsets would always cost more.
LARGEST_LIGHT = 64
#: Lists, or bands of size of a list, of up to so many sets are listed in pairs.
SHORT = 16
#: N-grams of the longest lists that are put last when sets of longer lists are posted anew (8 bytes each, sent to
#: all tasks); which ones they are decides nothing but the work.
MOST_LAST = 1 << 18
LAST = 1 << 20
#: Partners of a set that are compared with it in one go; further ones get its text again.
STAR = 256
#: Signatures that a task remembers so as not to post a set twice; repeated postings are dropped later anyway.
REMEMBERED = 1 << 17
BLOCK = 1 << 19
COMPARED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("both", pa.int64()), ("size_a", pa.int64()), ("size_b", pa.int64()), ("apart", pa.list_(pa.int64()))])

_odd = np.uint64(0x9E3779B97F4A7C15)
_back = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_value = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """_odd and its inverse to the powers 0, 1, ... of at least n numbers."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, BLOCK + (1 << 18))
        keeps("jaccard", _powers.clear)
        _powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(size, x, np.uint64)]) for x in (_odd, _back)]
    return _powers


def shingles(texts: list[bytes | None], width: int = WORDS_PER_GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and hash of each of its distinct n-grams, sorted by both."""
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    flat = _lower[np.frombuffer(b"\n".join([*(t or b"" for t in texts), b""]), np.uint8)]
    if not len(flat):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = powers(len(flat) + 1)
    gap = _space[flat]
    start = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
    end = np.flatnonzero(~gap & np.r_[gap[1:], True]) + 1
    sums = np.r_[np.uint64(0), np.cumsum(_value[flat] * up[: len(flat)])]
    word = mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    text = np.searchsorted(np.cumsum(sizes + 1), start, side="right")
    count = np.bincount(text, minlength=len(texts))
    n = len(word) - width + 1
    if n > 0:
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = mix64(h * _odd + word[k : k + n])
        same = text[:n] == text[width - 1 :]
        of, h = text[:n][same], h[same]
    else:
        of, h = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first = np.cumsum(count) - count
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        short = count[few].astype(np.uint64)
        for k in range(width - 1):
            on = count[few] > k
            short[on] = mix64(short[on] * _odd + word[first[few[on]] + k])
        of, h = np.r_[of, few], np.r_[h, short]
    by = np.lexsort((h, of))
    of, h = of[by], h[by]
    new = np.r_[True, (of[1:] != of[:-1]) | (h[1:] != h[:-1])][: len(of)]
    return of[new], h[new]


def signatures(of: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit signature of each of n sets; empty ones have signature 0."""
    size, sig = np.bincount(of, minlength=n), np.zeros(n, np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        at = (np.cumsum(size) - size)[some]
        sig[some] = mix64(np.add.reduceat(mix64(h ^ np.uint64(0x5851F42D4C957F2D)), at) + size[some].astype(np.uint64))
    return size, sig


def as_bytes(column: pa.ChunkedArray) -> list[bytes | None]:
    return pc.cast(column, pa.binary()).to_pylist()


def profile(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Rows (key, size, sig, null, null) of documents, and rows (null, null, null, slice, counts) of the sketch of
    each task's sets; counts are packed."""
    schema = pa.schema([(key, pa.int64()), ("size", pa.int64()), ("sig", pa.int64()), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int32)
        for t in chunks(batches, text, BLOCK):
            of, h = shingles(as_bytes(t.column(text)), width)
            size, sig = signatures(of, h, t.num_rows)
            once = np.zeros(t.num_rows, bool)
            once[np.unique(sig, return_index=True)[1]] = True
            sketch += np.bincount((h[once[of]] % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH).astype(np.int32)
            columns = [t.column(key).combine_chunks(), pa.array(size, pa.int64()), pa.array(sig.view(np.int64)), pa.nulls(t.num_rows, pa.int32()), pa.nulls(t.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        for n, part in enumerate(sketch.reshape(-1, SLICE)):
            if part.any():
                packed = zlib.compress(part.tobytes(), 1)
                yield pa.RecordBatch.from_pydict({key: [None], "size": [None], "sig": [None], "slice": [n], "counts": [packed]}, schema=schema)

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(frugal("jaccard", run), f"{key} long, size long, sig long, slice int, counts binary")


def total_sketch(parts: DataFrame) -> np.ndarray:
    """The sum of sketches from rows (slice, counts), each slice summed in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for n, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[n] = sums.get(n, 0) + np.frombuffer(zlib.decompress(packed), np.int32).astype(np.int64)
        for n, x in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([n], pa.int32()), "counts": pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())})

    out = np.zeros((SKETCH // SLICE, SLICE))
    for r in parts.select("slice", "counts").repartition("slice").mapInArrow(frugal("jaccard", run), "slice int, counts binary").toLocalIterator():
        out[r["slice"]] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.ravel()


def prefix(size: int, k: int, percent: int) -> int:
    return max(0, min(size, size + (-size * percent) // 100 + k))


def boundary(sizes: dict[int, int], list_length: float, percent: int) -> int:
    """The size up to which sets are light, at the least cost of subsets listed and lists scanned."""
    light = lambda s: comb(prefix(s, 2, percent), 2)
    heavy = lambda s: prefix(s, 1, percent) * (1 + list_length)
    cost = lambda x: sum(n * (light(s) * (s <= x) + heavy(s) * (100 * s > percent * x)) for s, n in sizes.items())
    return min(range(LARGEST_LIGHT + 1), key=cost)


def postings(docs: DataFrame, level: np.ndarray, light: int, percent: int, text: str, width: int, last: np.ndarray | None = None) -> DataFrame:
    """list, sig, size and place (of an n-gram in its set's order; -1 for subsets) of each task's sets.

    The n-grams in `last` (sorted hashes) come after all others in the order."""
    late = np.zeros(0, np.uint64) if last is None else last
    sent = docs.sparkSession.sparkContext.broadcast((level, late))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        level, late = sent.value
        for t in chunks(batches, text, BLOCK):
            of, h = shingles(as_bytes(t.column(text)), width)
            size, sig = signatures(of, h, t.num_rows)
            order = level[(h % np.uint64(SKETCH)).astype(np.int64)]
            if len(late):
                order = order + LAST * (late[np.minimum(np.searchsorted(late, h), len(late) - 1)] == h)
            h = h[np.lexsort((h, order, of))]
            at = np.cumsum(size) - size
            place = np.arange(len(h)) - np.repeat(at, size)
            fresh = size > 0
            for i, s in enumerate(sig.tolist()):
                if s in seen:
                    fresh[i] = False
                elif len(seen) < REMEMBERED:
                    seen.add(s)
            need = -(-size * percent // 100)
            scan = fresh & (100 * size > percent * light)
            take = scan[of] & (place < (size - need + 1)[of])
            lists, sets, places = [h[take]], [of[take]], [place[take]]
            for i in np.flatnonzero(fresh & (size <= light)).tolist():
                p = h[at[i] : at[i] + prefix(int(size[i]), 2, percent)]
                a, b = np.triu_indices(len(p), 1)
                lists.append(mix64(p[a] * _odd ^ mix64(p[b] + np.uint64(1))))
                sets.append(np.full(len(a), i))
                places.append(np.full(len(a), -1))
            of_set = np.concatenate(sets)
            columns = {"list": np.concatenate(lists).view(np.int64), "sig": sig[of_set].view(np.int64), "size": size[of_set].astype(np.int32), "place": np.concatenate(places).astype(np.int32)}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return docs.select(text).mapInArrow(frugal("jaccard", run), "list long, sig long, size int, place int")


def leaders(same: np.ndarray, size: np.ndarray, percent: int) -> np.ndarray:
    """For rows sorted by list and size, the first row of the list whose size is near enough; of others, the row itself."""
    at = np.arange(len(same))
    mark = ~same
    while True:
        lead = np.maximum.accumulate(np.where(mark, at, 0))
        far = 100 * size[lead].astype(np.int64) < percent * size.astype(np.int64)
        if not far.any():
            return lead
        mark = mark | far & ~np.r_[False, far[:-1] & (lead[1:] == lead[:-1])]


def shared_lists(post: DataFrame, percent: int) -> DataFrame:
    """The rows of lists of at least two sets, each with its leader (null for leaders)."""
    names = ["list", "sig", "size", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last row so far, not told yet, behind its leader, if that is another row

        def out(cols: list[np.ndarray], lead: np.ndarray, pick: np.ndarray) -> pa.RecordBatch:
            own = (lead == np.arange(len(lead)))[pick]
            arrays = [pa.array(c[pick]) for c in cols] + [pa.array(c[lead][pick], mask=own) for c in cols[1:]]
            return pa.RecordBatch.from_arrays(arrays, names=[*names, "sig0", "size0", "place0"])

        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            if held is not None:
                cols = [np.r_[x, c] for x, c in zip(held, cols, strict=True)]
            if not len(cols[0]):
                continue
            old = len(held[0]) if held is not None else 0
            keep = ~np.r_[False, (cols[0][1:] == cols[0][:-1]) & (cols[1][1:] == cols[1][:-1])]
            keep[:old] = True
            cols = [c[keep] for c in cols]
            same = np.r_[False, cols[0][1:] == cols[0][:-1]]
            lead = leaders(same, cols[2], percent)
            pick = same | np.r_[same[1:], False]
            pick[: old - 1 if old else 0] = False
            pick[-1] = False
            if pick.any():
                yield out(cols, lead, pick)
            ends = [lead[-1] if lead[-1] != len(same) - 1 else lead[-2], -1] if same[-1] else [-1]
            held = [c[ends] for c in cols]
        if held is not None and len(held[0]) == 2:
            same = np.array([False, True])
            yield out(held, leaders(same, held[2], percent), same)

    ordered = post.repartition("list").sortWithinPartitions("list", "size", "sig")
    return ordered.mapInArrow(frugal("jaccard", run), "list long, sig long, size int, place int, sig0 long, size0 int, place0 int")


def could_link(a: str, b: str, percent: int) -> str:
    """SQL for the length filter and, for inverted lists, the positional filter on sets a and b of a list."""
    fit = f"100 * least(size{a}, size{b}) >= {percent} * greatest(size{a}, size{b})"
    most = f"least(place{a}, place{b}) + 1 + least(size{a} - place{a} - 1, size{b} - place{b} - 1)"
    return f"{fit} AND (place{a} < 0 OR {100 + percent} * ({most}) >= {percent} * (size{a} + size{b}))"


def least_lists(percent: int) -> str:
    """SQL for the number of inverted lists in which sets of sizes low and high must meet; see supported()."""
    return f"(ceil({percent} * (low + high) / {100 + percent}) - ceil({percent} * high / 100) + 1)"


def supported(met: DataFrame, light: int, percent: int, part: int = 1) -> DataFrame:
    """Of the pairs (a, b) that meet in lists, those that meet in enough of them.

    Let A's prefix end before B's in the global order. What A's prefix shares with B lies in B's prefix,
    so the overlap is at most the prefixes' shared n-grams plus the rest of A. A pair with a heavy set that
    meets in fewer inverted lists than the threshold then asks for can't link. part > 1 divides that number,
    where not all lists of a pair are at hand."""
    m = met.groupBy("a", "b").agg(F.sum(F.when(F.col("place") >= 0, 1).otherwise(0)).alias("m"), F.max("low").alias("low"), F.max("high").alias("high"))
    return m.filter(f"high <= {light} OR {part} * m >= {least_lists(percent)}").select("a", "b")


class Join:
    def __init__(self, docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", width: int = WORDS_PER_GRAM):
        self.docs = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull())
        self.percent, self.key, self.text, self.width, self.short = percent, key, text, width, SHORT
        self.work = Workspace(docs.sparkSession)

    def texts(self, ids: DataFrame) -> DataFrame:
        """d and text of the documents with these ids (d).

        Of the documents only those that a bitmap of fixed size admits are moved."""
        some = self.docs.select(F.col(self.key).alias("d"), F.col(self.text).alias("text")).filter(admitted(ids, "d")(F.col(self.key)))
        met = some.join(ids, "d", "left_semi").withColumn("h", F.xxhash64("text"))
        return self.work.keep(met.dropDuplicates(["d", "h"]).select("d", "text"))

    def compare(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """For pairs (a, b, tell) of signatures: a, b, both (size of the intersection), size_a, size_b and, where
        `tell`, apart: the n-grams that only one of the two sets has.

        The text of a travels once for each STAR of its partners, that of b once for each pair."""
        work, width = self.work, self.width
        one = nodes.select("sig", F.col("doc").alias("d"))
        pairs = pairs.join(one.toDF("a", "da"), "a").join(one.toDF("b", "db"), "b")
        pairs = work.keep(pairs.withColumn("part", F.lit(0)))
        if pairs.isEmpty():
            return pairs.selectExpr("a", "b", "0L AS both", "0L AS size_a", "0L AS size_b", "array(0L) AS apart")
        hot = pairs.groupBy("a").count().filter(F.col("count") > STAR).select("a", F.ceil(F.col("count") / STAR).alias("parts"))
        ids = work.keep(pairs.select(F.col("da").alias("d")).union(pairs.select("db")).distinct())
        texts = self.texts(ids)
        work.sweep()
        dealt = pairs.join(work.keep(hot), "a", "left")
        dealt = dealt.withColumn("part", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts")), F.lit(0)).cast("int"))
        heads = dealt.select("a", "part", "da").distinct().join(texts.toDF("da", "text"), "da")
        heads = heads.selectExpr("a", "part", "CAST(NULL AS LONG) AS b", "false AS tell", "text")
        others = dealt.join(texts.toDF("db", "text"), "db").select("a", "part", "b", "tell", "text")
        rows = heads.union(others).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, head = None, None
            for t in chunks(batches, "text", BLOCK):
                of, h = shingles(as_bytes(t.column("text")), width)
                size, sig = signatures(of, h, t.num_rows)
                end = np.cumsum(size).tolist()
                out: dict[str, list] = {k: [] for k in COMPARED.names}
                named = zip(t.column("a").to_pylist(), t.column("b").to_pylist(), t.column("tell").to_pylist(), sig.view(np.int64).tolist(), strict=True)
                for i, (a, b, tell, own) in enumerate(named):
                    mine = h[end[i] - int(size[i]) : end[i]]
                    # a document whose id stands twice may have come with another text
                    if b is None and own == a:
                        name, head = a, mine.copy()
                    if b is None or own != b or name != a:
                        continue
                    at = np.minimum(np.searchsorted(head, mine), len(head) - 1)
                    hit = head[at] == mine
                    told = np.r_[mine[~hit], np.delete(head, at[hit])].view(np.int64) if tell else None
                    for k, v in zip(out, (a, b, int(hit.sum()), len(head), len(mine), told), strict=True):
                        out[k].append(v)
                yield pa.RecordBatch.from_pydict(out, schema=COMPARED)

        found = work.keep(rows.mapInArrow(frugal("jaccard", run), "a long, b long, both long, size_a long, size_b long, apart array<long>"))
        work.drop(pairs, ids, texts)
        return found

    def linked(self) -> str:
        """SQL for pairs of compare() that reach the threshold."""
        return f"{100 + self.percent} * both >= {self.percent} * (size_a + size_b)"

    def merged(self, comp: DataFrame, links: DataFrame) -> DataFrame:
        """comp after further links: only the components that these touch are contracted again."""
        ends = links.join(comp.toDF("a", "ca"), "a", "left").join(comp.toDF("b", "cb"), "b", "left")
        step = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), self.work)
        moved = comp.join(step.toDF("component", "to"), "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        # a component bears the name of one of its nodes, so what comp lacks is a set that was alone so far
        return self.work.keep(moved.union(step.join(comp, "node", "left_anti").select("node", "component")))

    def unjoined(self, rows: DataFrame, comp: DataFrame) -> DataFrame:
        """list, sig, size, place, component c and n (the list's length) of the lists whose sets aren't all in
        one component; the others have nothing more to tell."""
        named = rows.join(comp.toDF("sig", "component"), "sig", "left")
        named = self.work.keep(named.select("list", "sig", "size", "place", F.coalesce("component", "sig").alias("c")))
        mixed = named.groupBy("list").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"))
        mixed = self.work.keep(mixed.filter("lo != hi").select("list", "n"))
        out = self.work.keep(named.join(mixed, "list"))
        self.work.drop(named, mixed)
        return out

    def cells(self, rows: DataFrame) -> DataFrame:
        """rows with band, home and n, the number of sets of the cell. Lists of at most `short` sets are one cell;
        longer ones are dealt by band of size, each set at home in its own and a guest in the one above, so that
        sets of near enough size share a cell in which one of them at least is at home."""
        few = rows.filter(F.col("n") <= self.short).selectExpr("list", "-1 AS band", "true AS home", "sig", "size", "place", "c", "n")
        own = F.floor(0.999999 * F.log(F.col("size").cast("double")) / F.log(F.lit(100 / self.percent))).cast("int")
        many = rows.filter(F.col("n") > self.short).withColumn("own", own)
        many = many.select("list", F.explode(F.array("own", F.col("own") + 1)).alias("band"), "own", "sig", "size", "place", "c")
        cell = many.groupBy("list", "band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("n"))
        cell = self.work.keep(cell.filter("lo != hi").select("list", "band", "n"))
        many = many.join(cell, ["list", "band"]).selectExpr("list", "band", "band = own AS home", "sig", "size", "place", "c", "n")
        return self.work.keep(few.union(many))

    def in_short_cells(self, cells: DataFrame, light: int) -> DataFrame:
        """Pairs (a, b) that meet in cells of at most `short` sets, and in enough of them.

        A pair that meets in a longer cell too is looked for there, so the number of short cells decides only
        for pairs that have no other."""
        few = cells.filter(F.col("n") <= self.short)
        names = ["home", "sig", "size", "place", "c"]
        x, y = (few.select("list", "band", *[F.col(n).alias(n + k) for n in names]) for k in "xy")
        met = x.join(y, ["list", "band"]).filter(f"cx < cy AND (homex OR homey) AND {could_link('x', 'y', self.percent)}")
        met = met.selectExpr("least(sigx, sigy) AS a", "greatest(sigx, sigy) AS b", "placex AS place", "least(sizex, sizey) AS low", "greatest(sizex, sizey) AS high")
        return supported(met, light, self.percent)

    def anew(self, cells: DataFrame, level: np.ndarray, nodes: DataFrame) -> DataFrame:
        """The shared lists of the sets in longer cells, whose n-grams now come last. Two linked sets that meet in a
        longer cell are both among these sets, and so meet here by the same argument, light ones by k = 1 too."""
        many = cells.filter(F.col("n") > self.short)
        longest = many.filter("place >= 0").groupBy("list").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "list").limit(MOST_LAST)
        last = np.sort(longest.select("list").toPandas()["list"].to_numpy(dtype=np.int64).view(np.uint64))
        sets = self.work.keep(many.select("sig").distinct())
        ids = self.work.keep(nodes.join(sets, "sig").select(F.col("doc").alias("d")).distinct())
        # another text under one of these ids is posted too, as any set may be
        post = postings(self.texts(ids), level, 0, self.percent, "text", self.width, last)
        return self.work.keep(shared_lists(post, self.percent).select("list", "sig", "size", "place"))

    def stars(self, cells: DataFrame) -> DataFrame:
        """Pairs (a, b) of a leader and a set, such that any two sets of near enough size that meet in a longer
        cell, and are in different components, have a leader in common.

        The leader of a cell is the set whose prefix stands in most of the longer cells, for its length: one with
        few n-grams of its own. That order is the same in all cells, so a set gets to few leaders."""
        many = cells.filter(F.col("n") > self.short)
        rank = many.groupBy("sig").agg((F.count("*") / F.max(F.floor(F.col("size") * (100 - self.percent) / 100) + 1)).alias("rank"))
        heads = many.select("list", "band", "sig").join(rank, "sig").groupBy("list", "band").agg(F.max(F.struct("rank", "sig"))["sig"].alias("a"))
        return many.select("list", "band", F.col("sig").alias("b")).join(self.work.keep(heads), ["list", "band"]).filter("a != b").select("a", "b").distinct()

    def around_leaders(self, told: DataFrame, comp: DataFrame) -> DataFrame:
        """Pairs (a, b) that may link, from what leaders' sets and the sets around them have apart.

        Let x lack m_x of leader L's n-grams and share o_x with it. Then x and y share o_x - m_y n-grams and those
        that x and y both have apart from L. If x is not linked with L, what a link of x and y takes beyond
        o_x - m_y is more than c (|y| - |L|) + m_y with c = p / (100 + p), so at least one. So pairs whose sets
        both link with L are left out, and of the others the two `apart` sets must share enough. Those are put
        in order by how many sets around L have the n-gram apart, and only prefixes are posted: n-grams apart
        in one set only come first, and near copies have many of them."""
        p = self.percent
        t = told.dropDuplicates(["a", "b"]).join(comp.toDF("b", "component"), "b", "left")
        need = f"ceil({p} * (size_a + size_b) / {100 + p})"
        t = t.selectExpr("a", "b", "coalesce(component, b) AS c", "size_b AS size", "both", "size_a - both AS m", "size(apart) AS k", "apart", f"{self.linked()} AS near", f"{need} - both AS lacks")
        # as y against any x that L isn't linked with, and as x, not linked with L, against any y
        t = self.work.keep(t.selectExpr("*", f"k - floor((100 * m + {p} * (k - m)) / {100 + p}) AS as_y", "CASE WHEN near THEN 0 ELSE k - lacks + 1 END AS as_x"))
        each = t.selectExpr("a", "b", "explode(apart) AS g")
        counts = self.work.keep(each.groupBy("a", "g").agg(F.count("*").alias("n")).filter("n > 1"))
        of_set = Window.partitionBy("a", "b")
        shared = each.join(counts, ["a", "g"]).withColumn("nth", F.row_number().over(of_set.orderBy("n", "g"))).withColumn("all", F.count("*").over(of_set))
        # n-grams that one set only has apart meet nothing: places and prefixes are those of the others
        ranked = shared.join(t.drop("apart"), ["a", "b"]).withColumn("alone", F.expr("k - all")).withColumn("place", F.expr("nth - 1"))
        ranked = ranked.withColumns({"as_x": F.expr("as_x - alone"), "as_y": F.expr("as_y - alone"), "k": F.col("all")})
        names = ["b", "c", "size", "both", "m", "k", "near", "as_x", "as_y", "place"]
        posted = self.work.keep(ranked.filter("place < greatest(as_x, as_y)").select("a", "g", *names))
        x, y = (posted.select("a", "g", *[F.col(n).alias(f"{n}_{s}") for n in names]) for s in "xy")
        to_x = "CASE WHEN near_y THEN as_x_x ELSE as_y_x END"
        fit = f"(near_y OR b_x < b_y) AND 100 * least(size_x, size_y) >= {p} * greatest(size_x, size_y)"
        asks = f"ceil({p} * (size_x + size_y) / {100 + p}) - both_x + m_y"
        enough = f"least(place_x, place_y) + 1 + least(k_x - place_x - 1, k_y - place_y - 1) >= {asks}"
        met = x.filter("NOT near_x").join(y.filter("place_y < as_y_y"), ["a", "g"]).filter(f"c_x != c_y AND place_x < {to_x} AND {fit} AND {enough}")
        # of what two sets share, that set's prefix whose end comes first has all but its rest
        met = met.groupBy("a", "b_x", "b_y").agg(F.count("*").alias("n"), F.first(F.expr(f"{asks} - greatest(0, k_x - ({to_x}), k_y - as_y_y)")).alias("least"))
        return met.filter("n >= least").selectExpr("b_y AS a", "b_x AS b").distinct()

    def classes(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Of every document with a text and id: (doc, size, sig); of every set (sig, doc, size); of every linked
        set (node, component), both signatures."""
        work, percent = self.work, self.percent
        told = work.keep(profile(self.docs, self.key, self.text, self.width))
        members = told.filter("slice IS NULL").select(F.col(self.key).alias("doc"), "size", "sig")
        sketch = total_sketch(told.filter("slice IS NOT NULL"))
        level = np.round(4 * np.log1p(sketch)).astype(np.int32)
        nodes = work.keep(members.filter("size > 0").groupBy("sig").agg(F.min("doc").alias("doc"), F.first("size").alias("size")))
        sizes = {r["size"]: r["count"] for r in nodes.filter(F.col("size") <= LARGEST_LIGHT).groupBy("size").count().collect()}
        total = sketch.sum()
        length = max(1.0, (sketch**2).sum() / total - total / SKETCH - 1) if total else 1.0
        self.light = boundary(sizes, length, percent)
        lists = work.keep(shared_lists(postings(self.docs, level, self.light, percent, self.text, self.width), percent))
        work.sweep()
        near = lists.filter("sig0 IS NOT NULL").filter(could_link("", "0", percent))
        near = near.selectExpr("sig0 AS a", "sig AS b", "place", "least(size, size0) AS low", "greatest(size, size0) AS high")
        asked = work.keep(supported(near, self.light, percent, 3))
        found = self.compare(asked.withColumn("tell", F.lit(False)), nodes)
        comp = components(found.filter(self.linked()).select("a", "b"), work)
        rows = self.unjoined(lists, comp)
        work.drop(lists)
        work.sweep()
        before = asked.selectExpr("least(a, b) AS a", "greatest(a, b) AS b")
        cells = self.cells(rows)
        pairs = self.in_short_cells(cells, self.light)
        if not cells.filter(F.col("n") > self.short).isEmpty():
            cells = self.cells(self.unjoined(self.anew(cells, level, nodes), comp))
            pairs = pairs.union(self.in_short_cells(cells, 0)).distinct()
        pairs = pairs.join(before, ["a", "b"], "left_anti").withColumn("tell", F.lit(False))
        found = self.compare(pairs.union(self.stars(cells).withColumn("tell", F.lit(True))), nodes)
        comp = self.merged(comp, found.filter(self.linked()).select("a", "b"))
        told = found.filter("apart IS NOT NULL")
        if not told.isEmpty():
            more = self.compare(self.around_leaders(told, comp).withColumn("tell", F.lit(False)), nodes)
            comp = self.merged(comp, more.filter(self.linked()).select("a", "b"))
        return members, nodes, comp


def join(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", width: int = WORDS_PER_GRAM) -> DataFrame:
    """key, n_shingles and component_id of each row of docs."""
    j = Join(docs, percent, key, text, width)
    members, nodes, comp = j.classes()
    # a component's least id is found over sets, then carried to the sets and from them to their rows
    of_set = nodes.join(comp.toDF("sig", "c"), "sig")
    least = j.work.keep(of_set.groupBy("c").agg(F.min("doc").alias("least")))
    named = j.work.keep(of_set.join(least, "c").select("sig", "least"))
    whole = members.filter("size > 0").join(nodes.select("sig", F.col("doc").alias("own")), "sig").join(named, "sig", "left")
    linked = whole.select(F.col("doc").alias(key), F.col("size").alias("n_shingles"), F.coalesce("least", "own").alias("component_id"))
    empty = members.filter("size = 0").select(F.col("doc").alias(key), "size", F.col("doc").alias("component_id"))
    without = docs.filter(F.col(key).isNull() | F.col(text).isNull()).select(F.col(key), F.lit(0).cast("long"), F.col(key))
    return linked.union(empty).union(without)


def deduplicate(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id", text: str = "text", width: int = WORDS_PER_GRAM) -> DataFrame:
    """Of each component of linked texts the row with the smallest id, all columns as they are.

    Rows are told apart by id and text, so a row goes for its own text only, whatever else bears its id. Ids that
    are null come last in a component. Of rows with one id and one text the first stays, by their other columns.
    Rows without words or text link with nothing and stay, but for such repeated ones."""
    work = Workspace(docs.sparkSession)
    order = [c for c, t in docs.dtypes if c not in (key, text) and not t.startswith("map")]
    row = F.xxhash64(F.col(key), F.col(text))
    found = join(docs.select(row.alias("row"), F.col(text).alias("text")), percent, "row", "text", width)
    ids = docs.select(row.alias("row"), F.col(key).alias("id")).groupBy("row").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    named = work.keep(found.select("row", "component_id").distinct().join(ids, "row"))
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row"))["row"].alias("first"))
    named = named.join(work.keep(first), "component_id")
    # only what goes, and what stands more than once, is joined back; written first, so that its size is known
    special = work.keep(named.filter("row != first OR n > 1").select("row", (F.col("row") == F.col("first")).alias("stays")))
    met = docs.withColumn("_row", row).join(special.toDF("_row", "_stays"), "_row", "left")
    plain = met.filter("_stays IS NULL").select(*docs.columns)
    again = met.filter("_stays").withColumn("_n", F.row_number().over(Window.partitionBy("_row").orderBy(*order or ["_row"])))
    return plain.union(again.filter("_n = 1").select(*docs.columns))
