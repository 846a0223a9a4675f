"""WARC archives with revisit resolution.

Headers (id, payload digest, payload size) are shuffled by payload digest: the smallest id of each
digest that occurs more than once becomes the original. The count per digest is a pre-aggregated
group-by, so a payload that a third of all rows share costs one row a task. Rows then join their
original by digest: Spark broadcasts the originals where they are few; where they are not, whole
rows are shuffled once by digest, and a skewed digest is split. Each partition writes archives with
fresh headers: a response record carries the payload, a revisit record only refers to its original.

Archives are rows of a table in the shared folder (one row a bounded run of records), so that a
lost executor leaves no half-written archive.

Cases: a null payload is empty; payloads below ``least_bytes`` are never revisits; rows of a
repeated smallest id are all responses; a null id is never an original (a payload that only rows
without id have is stored with each); a null url is ``about:blank``; an empty table gives no
archives and no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

LEAST_BYTES = 100
ARCHIVE_BYTES = 8 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PAGE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL namespace of RFC 4122


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}/{digest}'.encode()).hexdigest())}>"


def _clean(url: str) -> str:
    """A header value has no control characters."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url) or "about:blank"


def write_record(page_id, url: str | None, payload: bytes, size: int, digest: str, original, date: str = DATE) -> bytes:
    """A response record, or, where ``original`` is given, a revisit record without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = original is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Target-URI: {_clean(url or '')}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"X-Row-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(original, digest)}", f"X-Refers-To-Row-ID: {original}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def read_records(archive: memoryview) -> Iterator[tuple[dict[str, str], dict[str, str], memoryview]]:
    """(WARC headers, HTTP headers, payload) of each record of an archive."""
    raw, at = archive.obj if isinstance(archive.obj, bytes) else bytes(archive), 0
    while at < len(raw):
        end = raw.index(b"\r\n\r\n", at)
        version, *lines = raw[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError("not a WARC record")
        head = dict(x.split(": ", 1) for x in lines)
        body, stop = end + 4, end + 4 + int(head["Content-Length"])
        cut = raw.index(b"\r\n\r\n", body, stop)
        http = dict(x.split(": ", 1) for x in raw[body:cut].decode().split("\r\n")[1:])
        if raw[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError("a record is cut off")
        yield head, http, memoryview(raw)[cut + 4 : stop]
        at = stop + 4


def resolved(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """(page_id, url, payload, size, digest, original): ``original`` is null for responses."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), shared.utf8(payload_col).alias("payload")
    )
    rows = rows.withColumns({"size": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    heads = rows.filter(F.col("size") >= least_bytes).groupBy("digest")
    firsts = heads.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    joined = rows.join(firsts.select("digest", "first"), "digest", "left")
    original = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return joined.select("page_id", "url", "payload", "size", "digest", original.alias("original"))


def _writer(date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            names = ("page_id", "url", "size", "digest", "original")
            cols = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            payloads = batch.column(batch.schema.get_field_index("payload"))
            for i, (page_id, url, n, digest, original) in enumerate(zip(*cols, strict=True)):
                payload = b"" if original is not None else payloads[i].as_buffer().to_pybytes()
                record = write_record(page_id, url, payload, n, digest, original, date)
                held.append(record)
                size += len(record)
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["archive"])

    return run


def write_archives(rows: DataFrame, date: str = DATE, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write what :func:`resolved` gives; the table of archives, read back."""
    shared.ship(rows.sparkSession)
    return shared.stored(rows.mapInArrow(_writer(date, archive_bytes), "archive binary"), "archives")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    for batch in batches:
        for i in range(batch.num_rows):
            cols: list[list] = [[] for _ in names]
            for head, http, payload in read_records(memoryview(batch.column(0)[i].as_buffer().to_pybytes())):
                digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                size, kind = int(http["Content-Length"]), head["WARC-Type"]
                if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                    raise ValueError(f"the payload of {head['WARC-Record-ID']} does not match its header")
                page_id, refers = head["X-Row-ID"].strip(), head.get("X-Refers-To-Row-ID")
                row = (int(page_id) if page_id else None, size, digest, kind, refers and int(refers))
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def read_archives(archives: DataFrame) -> DataFrame:
    """One row a record, from the stored bytes; the payload of every response is verified."""
    shared.ship(archives.sparkSession)
    return archives.select("archive").mapInArrow(
        _reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )
