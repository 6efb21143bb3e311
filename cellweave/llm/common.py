"""What the corpus operators share: table reads, the shared work folder, 64-bit mixing."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of an Arrow batch that a Python worker gets; the session's own setting holds where it is less.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by bytes, not by rows alone, in this session: a batch of long texts stands in memory
    several times over, in the executor and in its workers."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if now.lstrip("-").isdigit() and not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, gone when the application ends. Where that is unset, as in tests, a
    local session uses the warehouse; on a cluster it has to be set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/cellweave-{uuid.uuid4().hex}")
    store = path.getFileSystem(conf)
    store.deleteOnExit(path)
    # qualified, so that executors resolve it as the driver does, whatever their default store is
    return store.makeQualified(path).toString()


class Workspace:
    """Tables written in the shared folder, so that lineage is cut and a lost executor costs only its tasks."""

    def __init__(self, spark: SparkSession):
        small_batches(spark)
        self.spark, self.base, self.n = spark, shared_dir(spark), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def sweep(self) -> None:
        """Lets go of shuffle files of frames that nothing refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        """Removes tables that no later step reads."""
        jvm = self.spark.sparkContext._jvm
        for df in frames:
            for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
                p = jvm.org.apache.hadoop.fs.Path(f)
                p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Bits of the filter that admitted() makes.
BITMAP = 1 << 20


def admitted(values: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test for columns, true for every value of values[name] and for few others as long as there are far less than
    BITMAP of them. Its size is fixed, so it goes along with any plan."""
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(BITMAP))
    bits = np.zeros(BITMAP, np.uint8)
    bits[values.select(spot(F.col(name)).alias("s")).distinct().toPandas()["s"].to_numpy(dtype=np.int64)] = 1
    packed = F.lit(np.packbits(bits, bitorder="little").tobytes())

    def test(c: Column) -> Column:
        s = spot(c)
        byte = F.conv(F.hex(F.substr(packed, (s / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.expr("1") == F.try_mod(F.floor(byte / F.pow(F.lit(2), s % 8)), F.lit(2)).cast("int")

    return test


#: What this Python worker keeps from one task to the next, by operator: how to let go of it.
_kept: dict[str, Callable[[], None]] = {}


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """Tells that this worker holds something for `owner`'s next task; it is let go when another operator's begins."""
    _kept[owner] = forget


def begin(owner: str) -> None:
    for name in [n for n in _kept if n != owner]:
        _kept.pop(name)()


def give_back() -> None:
    """Returns what is free in this process to the system; allocators keep it otherwise, for as long as a worker lives."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not the GNU library
        pass


def frugal(owner: str, run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, for mapInArrow, in workers that outlive their task: an executor holds all its workers' memory at once, and what
    one operator's tasks leave there would stand beside the next one's."""

    def task(batches: Iterator) -> Iterator:
        begin(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else; the fast path is for texts that are all ASCII."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def mix64(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over an array of uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def chunks(batches: Iterable, column: str, most: int = 8 << 20) -> Iterator:
    """Record batches cut or gathered to about `most` bytes of a text column each; one longer text stands alone."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + most - size, side="right")))
            held.append(batch.slice(at, upto - at))
            size += int(ends[upto - 1]) - before
            at = upto
            if size >= most or at < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
