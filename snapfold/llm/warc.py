"""WARC archives: a writer, and a sequential reader of one gzip member per record.

The writer lets every task write archives of its own to the shared folder, under names that no other attempt takes, and
returns what it wrote; only files in that list are read, so a task that runs twice does no harm. Payloads equal to an
earlier one become ``revisit`` records without a body. The reader inflates member by member, a block of bytes at a time,
takes a record's block by its Content-Length and checks block and payload digests; a record that fails raises.

Defined cases: a null html is an empty payload; a null url leaves out the target; equal payloads of fewer than
``LEAST`` bytes are all responses; of rows with equal payload and equal smallest page_id each is a response; a row with a
null page_id revisits a payload that has one with an id; an empty table writes and reads nothing; further columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written

LEAST = 100
#: Compressed bytes after which a task starts another archive, and bytes read at a time.
ROLL, BLOCK = 256 << 20, 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def planned(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """page_id, url, digest, size, refers_to, payload (null for revisits) of every page."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))
    firsts = rows.where(F.col("size") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(firsts, "digest", "left").select(
        "page_id", "url", "digest", "size", F.when(again, F.col("first")).alias("refers_to"), F.when(~again, F.col("payload")).alias("payload")
    )


def record(page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes | None) -> bytes:
    """One WARC record, not yet compressed."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:x-page:{'null' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += [
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write(plan: DataFrame, folder: str) -> DataFrame:
    """Archives of the planned rows; (path, records), itself written, so that each row is written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, done, n, path = None, [], 0, ""
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                z = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.write(z.compress(record(*row)) + z.flush())
                n += 1
                if out.tell() > ROLL:
                    out.close()
                    done.append((path, n))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["path", "records"])

    return written(plan.select("page_id", "url", "digest", "size", "refers_to", "payload").mapInArrow(run, "path string, records long"), "archives")


class Reader:
    """Records of one archive in order: (headers, block). Holds one record and one block of input."""

    def __init__(self, stream):
        self.stream, self.rest = stream, b""

    def members(self) -> Iterator[bytes]:
        while True:
            if not self.rest:
                self.rest = self.stream.read(BLOCK)
                if not self.rest:
                    return
            z, parts = zlib.decompressobj(31), []
            while not z.eof:
                if not self.rest:
                    self.rest = self.stream.read(BLOCK)
                    if not self.rest:
                        raise ValueError("the archive ends inside a gzip member")
                parts.append(z.decompress(self.rest))
                self.rest = z.unused_data
            yield b"".join(parts)

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for data in self.members():
            head, gap, body = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            if not gap or not lines[0].startswith("WARC/"):
                raise ValueError("not a WARC record")
            headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            n = int(headers["content-length"])
            block = body[:n]
            if len(block) != n or body[n:] != b"\r\n\r\n":
                raise ValueError(f"{headers.get('warc-record-id')}: the block isn't {n} bytes long")
            if (told := headers.get("warc-block-digest")) and told != f"sha256:{hashlib.sha256(block).hexdigest()}":
                raise ValueError(f"{headers.get('warc-record-id')}: the block's digest differs")
            yield headers, block


def _id(urn: str | None) -> int | None:
    found = re.search(r"urn:x-page:(-?\d+)", urn or "")
    return int(found[1]) if found else None


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """page_id, url, payload size, payload digest, record type, refers_to and payload; checks the payload's digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{headers.get('warc-record-id')}: the payload's digest differs")
    return _id(headers.get("warc-record-id")), headers.get("warc-target-uri"), size, digest, kind, _id(headers.get("warc-refers-to")), payload if kind == "response" else None


FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]


def read(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each record of the archives at ``path``; each archive is read by one task, in bounded memory."""
    fields = FIELDS if payloads else FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(path, compression=None) as stream:
                    for headers, block in Reader(stream):
                        rows.append(page_of(headers, block)[: len(fields)])
                        held += len(block) if payloads else 100
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])
                            rows, held = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)], [n for n, _ in fields])

    kinds = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return archives.select("path").mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in fields))


def query(spark, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    archives = write(planned(spark.read.parquet(f"{sf_dir}/pages.parquet")), folder)
    files = archives.repartition(max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), "path")
    return read(files, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
