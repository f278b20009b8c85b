"""WARC archives: writing pages as records, and a sequential reader.

Archives are files of one gzip member per record, so a reader can stop and start at any
record. Pages with the same payload of at least ``min_bytes`` are written once: the one with
the largest ``page_id`` as ``response``, the others as ``revisit`` records that refer to it
and carry no payload.

The reader walks an archive from its start in small reads: each gzip member is inflated
incrementally, the header lines are taken as soon as their end is seen, the block is framed
by its content length, and a response's payload is checked against the record's digest. It
holds one record at a time.

Files go through ``pyarrow.fs`` to the shared folder by its address, never through a folder
of one machine. A task writes its archive under a name of its own; the list of archives is
stored by Spark's committed write, so only files of tasks that succeeded are read, however
often a task was tried.

Defined results: a null html is an empty payload; of rows equal in ``page_id`` and payload one
is the response, the others revisit it; a null ``page_id`` counts as the smallest and is kept as
null; line breaks in a url are percent-encoded; a null url is written as the empty target
and read back as null. An empty table gives no records. Columns other than ``page_id``,
``url`` and ``html`` are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from msgtriage.operators.lexicon import sized_side
from msgtriage.session import materialize, scratch_path

MIN_BYTES = 1000
READ_BYTES = 1 << 16
ARCHIVE_BYTES = 256 << 20  # a task starts another archive beyond this
_DATE = "2024-01-01T00:00:00Z"  # records hold no capture time of their own


class WarcError(ValueError):
    """A record that does not follow the format or fails its digest."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    def http(self) -> tuple[dict[str, str], bytes]:
        """HTTP headers (lower-case names) and body of the block."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")[1:]
        return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, body


# -- writing -------------------------------------------------------------------


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]) + "\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(head.encode()) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def _target(url: str | None) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 else c for c in url or "")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member for a page."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}|{url}|{sha1}')}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", _target(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "" if page_id is None else str(page_id)),
    ]
    if revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("X-Refers-To-Page-ID", "" if refers_to is None else str(refers_to)))
    return _member(headers, http if revisit else http + payload)


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, root = fs.FileSystem.from_uri(folder)
    out, path, size, count = None, "", 0, 0
    done = lambda: pa.record_batch({"path": [path], "bytes": pa.array([size], pa.int64()), "records": pa.array([count], pa.int64())})
    for batch in batches:
        for row in batch.to_pylist():
            if out is None:
                name = f"{uuid.uuid4().hex}.warc.gz"
                out, path, size, count = system.open_output_stream(f"{root}/{name}", compression=None), f"{folder}/{name}", 0, 0
            member = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"], row["revisit"])
            out.write(member)
            size, count = size + len(member), count + 1
            if size >= ARCHIVE_BYTES:
                out.close()
                yield done()
                out = None
    if out is not None:
        out.close()
        yield done()


def plan_records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, revisit, refers_to`` for each page.

    Copies are decided on digests alone: the payloads that occur more than once make a narrow
    stored table (digest, the response's page, how many rows that page has), which the scan is
    joined with; it is broadcast within a measured size, so payloads then move through no shuffle.
    Only where the response's own row is repeated, those rows are grouped (their payload moves
    once per task), numbered by url, and repeated again."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    large = F.length("payload") >= min_bytes
    per = rows.where(large).groupBy("digest", "page_id").agg(F.count("*").alias("n"))
    first = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "n")).alias("first")
    copies = per.groupBy("digest").agg(first, F.sum("n").alias("rows")).where("rows > 1")
    copies = copies.select(F.col("digest").alias("d"), F.col("first.page_id").alias("first_id"), F.col("first.n").alias("twins"))
    copies = materialize(copies, "warc-copies")
    joined = rows.join(sized_side(copies), large & (F.col("digest") == F.col("d")), "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first_id"))
    revisit = F.col("d").isNotNull() & ~is_first
    named = lambda df: df.select("page_id", "url", "payload", "digest", "revisit", F.when(F.col("revisit"), F.col("first_id")).alias("refers_to"))
    if copies.where("twins > 1").isEmpty():
        return named(joined.withColumn("revisit", revisit))
    twin = F.col("d").isNotNull() & is_first & (F.col("twins") > 1)
    alike = joined.where(twin).groupBy("page_id", "first_id", "digest", "url").agg(F.count("*").alias("k"), F.first("payload").alias("payload"))
    earlier = Window.partitionBy("digest").orderBy("url").rowsBetween(Window.unboundedPreceding, -1)  # urls of one page
    alike = alike.withColumn("before", F.coalesce(F.sum("k").over(earlier), F.lit(0)))
    alike = alike.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("k")))).withColumn("revisit", F.col("before") + F.col("place") > 1)
    return named(joined.where(~twin).withColumn("revisit", revisit)).union(named(alike))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write all pages; returns the stored list of archives (``path, bytes, records``).
    ``folder`` is an address all executors share, by default one below the shared folder."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    written = plan_records(pages, min_bytes).mapInArrow(partial(_write, folder=folder), "path string, bytes long, records long")
    return materialize(written, "warc-list")


# -- reading -------------------------------------------------------------------


def read_records(stream: BinaryIO, check: bool = True) -> Iterator[Record]:
    """The records of an archive, one gzip member each, in order."""
    raw = stream.read(READ_BYTES)
    while raw:
        inflate = zlib.decompressobj(31)
        text, headers, length, start = bytearray(), None, 0, 0
        while not inflate.eof:
            if not raw and not (raw := stream.read(READ_BYTES)):
                raise WarcError("the archive ends within a record")
            text += inflate.decompress(raw)
            raw = inflate.unused_data
            if headers is None and (end := text.find(b"\r\n\r\n")) >= 0:
                headers, start = _headers(bytes(text[:end])), end + 4
                length = int(headers["content-length"])
            if headers is not None and len(text) > start + length + 4:
                raise WarcError("a record is longer than its content length")
        if headers is None or bytes(text[start + length :]) != b"\r\n\r\n":
            raise WarcError("a record does not end after its content length")
        record = Record(headers, bytes(text[start : start + length]))
        if check and record.kind == "response":
            name, _, digest = headers.get("warc-payload-digest", "").partition(":")
            found = base64.b32encode(hashlib.sha1(record.http()[1]).digest()).decode()
            if name != "sha1" or digest != found:
                raise WarcError(f"digest mismatch: {digest} is stated, the payload has {found}")
        yield record
        raw = raw or stream.read(READ_BYTES)


def _headers(head: bytes) -> dict[str, str]:
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise WarcError(f"not a WARC record: {version[:20]!r}")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


PAGES = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"


def _read(batches: Iterator[pa.RecordBatch], html: bool) -> Iterator[pa.RecordBatch]:
    number = lambda x: int(x) if x else None
    for batch in batches:
        for path in batch.column("path").to_pylist():
            system, name = fs.FileSystem.from_uri(path)
            rows: list[dict] = []
            size = 0
            with system.open_input_stream(name, compression=None) as stream:
                for record in read_records(stream):
                    http, body = record.http()
                    h = record.headers
                    digest = base64.b32decode(h["warc-payload-digest"].partition(":")[2]).hex()
                    keep = body.decode("utf-8") if html and record.kind == "response" else None
                    rows.append(
                        {
                            "page_id": number(h["x-page-id"]), "url": h["warc-target-uri"] or None, "payload_bytes": int(http["content-length"]), "payload_digest": digest,
                            "record_type": record.kind, "refers_to": number(h.get("x-refers-to-page-id")), "html": keep,
                        }
                    )
                    size += len(body) if html else 200
                    if size > 8 << 20:
                        yield _page_batch(rows)
                        rows, size = [], 0
            if rows:
                yield _page_batch(rows)


def _page_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())]
    return pa.RecordBatch.from_pylist(rows, pa.schema(kinds))


def read_archives(archives: DataFrame, html: bool = True) -> DataFrame:
    """One row per record of the listed archives, each archive read by one task.
    ``html`` is the payload of responses (null if not asked for)."""
    n = max(1, archives.count())
    return archives.select("path").repartition(n, "path").mapInArrow(partial(_read, html=html), PAGES)
