"""WARC archives with an index written first, and reads that follow the index.

Every task of the write appends one gzip member per record to its own archive and returns (file, offset, length, url,
digest) rows; Spark commits them as the index table. A read starts from selected index rows, sorts them by file and
offset, coalesces neighbours into byte ranges and opens nothing else. An archive left by a task that was tried again is
never referred to, because only the index of the successful attempt is committed.

Of records with equal payloads of at least `min_bytes` bytes the smallest page id is a `response`, the others are
`revisit` records without payload: their HTTP header keeps the payload's length, their WARC header its digest.

Defined cases: a null html is an empty payload, a null url is left out of the header and comes back as null, a null
page id stays null and can only be a response where no row with that payload has an id. Rows that repeat page id and
html are all responses. Line breaks in a url are percent-encoded. Other columns are ignored.

Archives are written through pyarrow's file systems, so the shared folder may be a mounted path, HDFS or an object store.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlink.llm.common import ship, table
from leadlink.llm.registry import query
from leadlink.session import fresh_path

ship(__name__)

INDEX = "page_id long, url string, file string, offset long, length long, record_type string, refers_to long, payload_digest string"
FOUND = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _place(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _record(page_id, url, digest: str, payload: bytes, refers_to, date: str) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT}"]
    body = http + payload if refers_to is None else http
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def _writer(path: str, roll_bytes: int, date: str, level: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        place, root = _place(path)
        out, name, at, n = None, "", 0, 0
        for batch in batches:
            rows = []
            for page_id, url, html, sha, first in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha", "first")), strict=True):
                if out is None or at >= roll_bytes:
                    if out is not None:
                        out.close()
                    name, at, n = f"{task.partitionId():06d}-{n:03d}-{task.taskAttemptId()}.warc.gz", 0, n + 1
                    out = place.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(sha).decode()
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = pack.compress(_record(page_id, url, digest, (html or "").encode(), first, date)) + pack.flush()
                out.write(member)
                rows.append((page_id, url, name, at, len(member), "response" if first is None else "revisit", first, digest))
                at += len(member)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)
        if out is not None:
            out.close()

    return write


_NAMES = [c.split()[0] for c in INDEX.split(", ")]
_TYPES = [pa.int64() if c.endswith("long") else pa.string() for c in INDEX.split(", ")]


def write(pages: DataFrame, path: str, min_bytes: int = 0, roll_bytes: int = 1 << 30, date: str = "2000-01-01T00:00:00Z",
          level: int = 4) -> DataFrame:
    """Archive (page_id, url, html) under `path`; the index table, one row per record."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.unhex(F.sha1(payload)).alias("sha"), F.octet_length(payload).alias("bytes"))
    firsts = (
        rows.where(F.col("bytes") >= min_bytes).groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("sha").alias("_sha"), "first")
    )
    known = rows.join(firsts.hint("shuffle_hash"), F.col("sha") == F.col("_sha"), "left").select(
        "page_id", "url", "html", "sha",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"),
    )
    place, root = _place(path)
    place.create_dir(root, recursive=True)
    known.mapInArrow(_writer(path, roll_bytes, date, level), INDEX).write.parquet(f"{path}/index")
    return index(spark, path)


def index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def _parse(member: bytes, verify: bool):
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    page = lambda s: int(s[10:-1]) if len(s) > 11 else None  # noqa: E731  <urn:page:N>
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and verify and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = fields.get("WARC-Refers-To")
    return (page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, kind, page(refers) if refers else None), payload


def _ranges(places, gap: int, span: int):
    """Runs of (file, offset, length) in one file that lie within `gap` of each other, up to `span` bytes."""
    run, end = [], 0
    for p in places:
        if run and (p[0] != run[0][0] or p[1] - end > gap or p[1] + p[2] - run[0][1] > span):
            yield run
            run = []
        run.append(p)
        end = p[1] + p[2]
    if run:
        yield run


def _reader(path: str, gap: int, span: int, payloads: bool, verify: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = _place(path)
        name, file = None, None
        for batch in batches:
            places = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")), strict=True)
            for run in _ranges(places, gap, span):
                if run[0][0] != name:
                    if file is not None:
                        file.close()
                    name, file = run[0][0], place.open_input_file(f"{root}/{run[0][0]}")
                start = run[0][1]
                data = file.read_at(run[-1][1] + run[-1][2] - start, start)
                got = [_parse(data[o - start : o - start + n], verify) for _, o, n in run]
                columns = [pa.array(c, t) for c, t in zip(zip(*(g[0] for g in got), strict=True), _FOUND_TYPES, strict=True)]
                if payloads:
                    columns.append(pa.array([g[1] if g[0][4] == "response" else None for g in got], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=_FOUND_NAMES + ["payload"] * payloads)
        if file is not None:
            file.close()

    return read


_FOUND_NAMES = [c.split()[0] for c in FOUND.split(", ")]
_FOUND_TYPES = [pa.int64() if c.endswith("long") else pa.string() for c in FOUND.split(", ")]


def read(selected: DataFrame, path: str, gap: int = 1 << 16, span: int = 1 << 23, task_bytes: int = 1 << 25,
         payloads: bool = False, verify: bool = True) -> DataFrame:
    """The records of the selected index rows, by coalesced byte ranges in file order.

    `gap` unread bytes at most are read over between two records, `span` bytes at most are held at once (a single
    longer record apart), and about `task_bytes` go to one task.
    """
    sc = selected.sparkSession.sparkContext
    total = selected.agg(F.sum("length")).first()[0] or 0
    tasks = max(sc.defaultParallelism, -(-total // task_bytes))
    places = selected.select("file", "offset", "length").repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(_reader(path, gap, span, payloads, verify), FOUND + ", payload binary" * payloads)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY sha1(html)) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d
"""


@query("op10_warc", SQL)
def op10_warc(spark, sf_dir):
    path = fresh_path(spark, "warc")
    return read(write(table(spark, sf_dir, "pages"), path), path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
