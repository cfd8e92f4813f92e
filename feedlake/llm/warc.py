"""WARC archives, index first (operator 10).

``write_archives`` writes one gzip member per record into rolling files and
returns the index: file, offset, length, URL and payload digest of every
record.  The index is staged before anything reads an archive, and only what
it names counts: a file left by a lost or repeated task is never referenced.
``read_records`` sorts the selected index rows by file and offset, deals them
out in ranges, and coalesces neighbouring records into one byte-range read.

Duplicates: of records with equal payloads (digest and size) of at least
``min_revisit_bytes``, the one with the smallest page id is the response and
the others are revisits.  Only digests of payloads that do repeat enter the
join, so the payloads needn't be shuffled while those are few, and a very
common payload may be split over tasks.

Defined results: a null payload is empty; rows that tie for the smallest id
are all responses, as are rows of a group without any id; a row without an id
in a group that has one is a revisit; a null URL is left out of the record;
empty input gives empty output.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import staged
from feedlake.session import scratch_path

#: Roll to a new archive beyond this size; bytes of archive for one read task.
FILE_BYTES, TASK_BYTES = 256 << 20, 64 << 20
#: One byte-range read covers records at most so far apart, up to so many bytes.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = (
    "file string, offset long, length long, url string, payload_digest string, page_id long, record_type string"
)
RECORD = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, place: str) -> bytes:
    """One WARC record.  A revisit has the HTTP headers without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if revisit:
        head.append(f"WARC-Profile: {PROFILE}")
        if refers_to is not None:
            head.append(f"Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, payload) of one record."""
    head, rest = data.split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, payload = rest[: int(fields["Content-Length"])].split(b"\r\n\r\n", 1)
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0) -> DataFrame:
    """Rows (page_id, url, payload, refers_to, revisit) ready to be written."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumns({"sha": F.sha1("payload"), "size": F.octet_length("payload")})
    repeated = staged(
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy(F.col("sha").alias("r_sha"), F.col("size").alias("r_size"))
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("first_id").isNotNull())
        .drop("n"),
        "repeated-payloads",
    )
    joined = rows.join(repeated, (F.col("sha") == F.col("r_sha")) & (F.col("size") == F.col("r_size")), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", F.when(revisit, F.col("first_id")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, root: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write planned records under ``root``; the staged index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        store.create_dir(folder, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows: list[tuple] = []
                for page_id, url, payload, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = store.open_output_stream(f"{folder}/{name}", compression=None)
                    member = gzip.compress(record(page_id, url, payload, refers_to, revisit, f"{name}/{at}"), LEVEL, mtime=0)
                    out.write(member)
                    rows.append((name, at, len(member), url, digest(payload), page_id, "revisit" if revisit else "response"))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)] if rows else [pa.array([], t) for t in _TYPES],
                    names=_NAMES,
                )
        finally:
            if out is not None:
                out.close()

    return staged(records.mapInArrow(run, INDEX), "warc-index")


_NAMES = [f.split()[0] for f in INDEX.split(", ")]
_TYPES = [pa.int64() if f.endswith("long") else pa.string() for f in INDEX.split(", ")]


def _spans(rows: list[tuple[str, int, int]], gap: int, most: int) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted (file, offset, length) coalesced into (file, start, size, parts)."""
    file, start, end, parts = "", 0, 0, []
    for name, offset, length in rows:
        if parts and (name != file or offset - end > gap or offset + length - start > most):
            yield file, start, end - start, parts
            parts = []
        if not parts:
            file, start = name, offset
        parts.append((offset - start, length))
        end = offset + length
    if parts:
        yield file, start, end - start, parts


def read_records(index: DataFrame, root: str, task_bytes: int = TASK_BYTES, gap: int = GAP_BYTES, most: int = READ_BYTES) -> DataFrame:
    """The records that the index rows name, read in coalesced byte ranges.
    Fails on a response whose payload doesn't match its digest."""
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(-(-size // task_bytes), index.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(root)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for file, start, length, parts in _spans(rows, gap, most):
                with store.open_input_file(f"{folder}/{file}") as source:
                    data = source.read_at(length, start)
                out = []
                for offset, part in parts:
                    fields, http, payload = parse(zlib.decompress(data[offset : offset + part], 31))
                    sha, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                    if kind == "response" and digest(payload) != sha:
                        raise ValueError(f"damaged record in {file} at {start + offset}")
                    ids = [int(fields[k]) if k in fields else None for k in ("Page-ID", "Refers-To-Page-ID")]
                    out.append((ids[0], fields.get("WARC-Target-URI"), payload, int(http["Content-Length"]), sha, kind, ids[1]))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, _RECORD_TYPES, strict=True)], names=_RECORD_NAMES
                )

    dealt = index.select("file", "offset", "length").repartitionByRange(int(tasks), "file", "offset")
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(run, RECORD)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
_RECORD_NAMES = [f.split()[0] for f in RECORD.split(", ")]
_RECORD_TYPES = [_KINDS[f.split()[1]] for f in RECORD.split(", ")]


def round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write every page to archives in the shared folder and read them back."""
    root = scratch_path(pages.sparkSession, "warc")
    index = write_archives(plan_records(pages, min_revisit_bytes=min_revisit_bytes), root)
    return read_records(index, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
