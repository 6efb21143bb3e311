"""WARC archives with a two-level capture index.

Writing: each task writes its records as gzip members of one or more archives in the shared folder and
returns a capture line per record. Lines sorted by reversed-host URL key are packed into compressed
blocks; a sparse directory holds each block's first key. Reading: a binary search over the directory
finds the blocks of a key, one inside the block finds the lines, and range reads fetch the records.

Of records with equal payloads of at least `least` bytes the one with the largest page_id is a response
and the rest are revisits that keep digest and length in their headers. The decision is made on digests. Of the
payloads only those are moved between executors that have a duplicate (and the few that a filter of fixed size
takes for such), and only if the duplicates' digests are too many to be sent to all.

Defined cases: null html is an empty payload; a null url has the empty key; repeated rows whose page_id
is the largest of their payload are all responses; a null page_id counts as the smallest; an empty table
gives no archives and no rows; very long pages are held one record at a time; further columns stay out.
Archives of failed task attempts are never referred to.
"""

from __future__ import annotations

import base64
import bisect
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha1

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, admitted

LEAST = 1000
ARCHIVE_BYTES = 256 << 20
LINES_PER_BLOCK = 1000
#: The directory is made no longer than this, by longer blocks; so it can be sent to every task.
DIRECTORY_BLOCKS = 1 << 17
#: Neighbouring records closer than this are fetched by one read, up to READ_BYTES.
GAP_BYTES, READ_BYTES = 1 << 16, 8 << 20
DATE = "2024-01-01T00:00:00Z"

LINE = T.StructType([T.StructField("key", T.StringType()), T.StructField("page_id", T.LongType()), T.StructField("file", T.StringType()), T.StructField("at", T.LongType()), T.StructField("size", T.LongType())])
RECORD = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType())])


def url_key(url: str | None) -> str:
    """Host labels reversed, then `)` and what follows the host; lower case for the host only."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    host = re.match(r"[^/?#]*", rest)[0]
    key = ",".join(reversed(host.lower().split("."))) + ")" + rest[len(host) :]
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", key)


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit keeps the response's HTTP head, with the full length, and no payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + http + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = lambda lines: {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    warc = fields(head.decode("utf-8", "replace").split("\r\n")[1:])
    block = rest[: int(warc["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {warc.get('warc-record-id')} does not end where its length says")
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http.decode("latin-1").split("\r\n")[1:]), payload


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


@dataclass
class Captures:
    """Archives and their index: blocks(block, first, lines) as a table, the directory as sorted pairs."""

    blocks: DataFrame
    directory: list[tuple[str, int]]


def decide(pages: DataFrame, work: Workspace, least: int = LEAST) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null for responses) of each row."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("big", F.octet_length("payload") >= least)
    same = rows.filter("big").groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("largest")).filter("n > 1 AND largest IS NOT NULL").select("digest", "largest")
    same = work.keep(same)  # its size is then known to the planner, which broadcasts it only if it is small
    maybe = F.col("big") & admitted(same, "digest")(F.col("digest"))
    alone = rows.filter(~maybe).select("page_id", "url", "payload", "digest", F.lit(None).cast("long").alias("refers_to"))
    met = rows.filter(maybe).join(same, "digest", "left")
    refers = F.when(F.col("big") & ~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest"))
    return alone.union(met.select("page_id", "url", "payload", "digest", refers.alias("refers_to")))


def write(rows: DataFrame, where: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the archives as the rows are read, and returns their capture lines. To be kept at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(where)
        fs.create_dir(root, recursive=True)
        task, n, out, at, name = TaskContext.get(), 0, None, 0, ""
        try:
            for b in batches:
                lines = []
                for x in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                    if out is None or at >= archive_bytes:
                        if out is not None:
                            out.close()
                        name, n, at = f"{root}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{n}.warc.gz", n + 1, 0
                        out = fs.open_output_stream(name, compression=None)  # the members are compressed one by one
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    raw = z.compress(record(x["page_id"], x["url"], x["payload"], x["digest"], x["refers_to"])) + z.flush()
                    out.write(raw)
                    lines.append({"key": url_key(x["url"]), "page_id": x["page_id"], "file": name, "at": at, "size": len(raw)})
                    at += len(raw)
                yield pa.RecordBatch.from_pylist(lines, schema=pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())]))
        finally:
            if out is not None:
                out.close()

    return rows.mapInArrow(run, LINE)


def index(lines: DataFrame, work: Workspace, n_lines: int | None = None) -> Captures:
    """Sorts the lines by key and packs each run of them into a compressed block."""
    if n_lines is None:
        n_lines = lines.count()
    per = max(LINES_PER_BLOCK, -(-n_lines // DIRECTORY_BLOCKS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        part, n = TaskContext.get().partitionId(), 0

        def block() -> pa.RecordBatch:
            nonlocal n
            n += 1
            body = "\n".join(f"{k} {'-' if p is None else p} {f} {a} {s}" for k, p, f, a, s in held).encode("utf-8", "surrogatepass")
            return pa.RecordBatch.from_pydict({"block": pa.array([(part << 32) + n], pa.int64()), "first": pa.array([held[0][0]], pa.string()), "lines": pa.array([zlib.compress(body)], pa.binary())})

        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(x)
                if len(held) >= per:
                    yield block()
                    held = []
        if held:
            yield block()

    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("first", T.StringType()), T.StructField("lines", T.BinaryType())])
    parts = max(1, min(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_lines // per + 1))
    # page_id splits a hot key over partitions
    ordered = lines.repartitionByRange(parts, "key", "page_id").sortWithinPartitions("key", "page_id")
    blocks = work.keep(ordered.mapInArrow(pack, schema))
    # at most DIRECTORY_BLOCKS entries and one for each partition
    return Captures(blocks, sorted((r["first"], r["block"]) for r in blocks.select("first", "block").collect()))


def find(captures: Captures, wanted: DataFrame) -> DataFrame:
    """The capture lines of wanted(key) rows: directory search, then a search inside each block."""
    firsts, ids = [x[0] for x in captures.directory], [x[1] for x in captures.directory]
    spark = wanted.sparkSession
    sent = spark.sparkContext.broadcast((firsts, ids))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, ids = sent.value
        for b in batches:
            keys, blocks = [], []
            for k in b.column(0).to_pylist():
                if k is None or not firsts:
                    continue
                lo, hi = max(0, bisect.bisect_left(firsts, k) - 1), bisect.bisect_right(firsts, k)
                keys += [k] * (hi - lo)
                blocks += ids[lo:hi]
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "key": pa.array(keys, pa.string())})

    sought = wanted.select("key").distinct().mapInArrow(locate, "block long, key string")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, lines = None, [], []
        for b in batches:
            out = []
            for block, key, packed in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if block != held:
                    held = block
                    lines = [x.split(" ") for x in zlib.decompress(packed).decode("utf-8", "surrogatepass").split("\n")]
                    keys = [x[0] for x in lines]
                for i in range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key)):
                    k, p, f, a, s = lines[i]
                    out.append({"key": k, "page_id": None if p == "-" else int(p), "file": f, "at": int(a), "size": int(s)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())]))

    # a block's rows stand together after the join's sort, so that each block is opened about once
    met = sought.join(captures.blocks, "block").sortWithinPartitions("block").select("block", "key", "lines")
    return met.mapInArrow(search, LINE)


def fetch(lines: DataFrame, where: str) -> DataFrame:
    """Range reads of the lines' records, near ones together; what the archives say of each."""
    least_file = (F.col("file"), F.col("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_store(where)
        opened, name = None, None
        for b in batches:
            rows = b.select(["file", "at", "size"]).to_pylist()
            out, i = [], 0
            while i < len(rows):
                j, end = i + 1, rows[i]["at"] + rows[i]["size"]
                while j < len(rows) and rows[j]["file"] == rows[i]["file"] and 0 <= rows[j]["at"] - end <= GAP_BYTES and rows[j]["at"] + rows[j]["size"] - rows[i]["at"] <= READ_BYTES:
                    end = rows[j]["at"] + rows[j]["size"]
                    j += 1
                if rows[i]["file"] != name:
                    if opened is not None:
                        opened.close()
                    name = rows[i]["file"]
                    opened = fs.open_input_file(name)
                raw = opened.read_at(end - rows[i]["at"], rows[i]["at"])
                for x in rows[i:j]:
                    s = x["at"] - rows[i]["at"]
                    warc, http, payload = parse(zlib.decompress(raw[s : s + x["size"]], 31))
                    kind, page = warc["warc-type"], warc.get("x-page-id")
                    digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{name}: the payload of {warc['warc-record-id']} has another digest")
                    size = len(payload) if kind == "response" else int(http["content-length"])
                    out.append({"page_id": None if page is None else int(page), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": int(warc["x-refers-to-page-id"]) if kind == "revisit" else None})
                i = j
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]))
        if opened is not None:
            opened.close()

    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartitionByRange(parts, *least_file).sortWithinPartitions(*least_file).mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Archives all pages, looks every page's URL key up in the index and reads the records back."""
    work = Workspace(pages.sparkSession)
    where = f"{work.base}/archives"
    lines = work.keep(write(decide(pages, work, least), where))
    captures = index(lines, work)
    return fetch(find(captures, lines.select("key")), where)


ROUND_TRIP_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST} AND page_id IS DISTINCT FROM largest THEN largest END AS refers_to
FROM m"""
