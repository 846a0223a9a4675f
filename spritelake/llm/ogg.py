"""Media columns: Ogg.

A payload of 8-bit samples is stored as a physical Ogg stream of two multiplexed logical streams,
which take its packets in turn. The reader verifies every page's checksum, demultiplexes pages by
serial number, reassembles packets from lacing values (packets may run on over pages), and turns
granule positions (samples of the stream so far) into timestamps.

The checksum is the format's 32-bit one: polynomial 0x04C11DB7, most significant bit first, no
inversion. It equals the bit-reversed common CRC-32 of bit-reversed bytes without inversions,
which is how it is computed here: a byte table and the C routine instead of a loop.

Cases: a null or empty text gives one block of spaces; equal texts give equal bytes (serial
numbers are fixed); texts of any length are whole; an empty table gives no rows; other columns are
not read. A damaged or cut-off stream raises ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

BLOCK = 192
RATE = 8000
PACKET = 25 * BLOCK
STREAMS = (1, 2)

# Fixed values of the format.
CAPTURE = b"OggS"
CONTINUED, FIRST, LAST = 1, 2, 4
NO_GRANULE = -1
_PAGE = struct.Struct("<4sBBqIIIB")  # capture, version, flags, granule, serial, number, checksum, segments
_MAGIC = b"\x7fPCM8"
_IDENT = struct.Struct("<5sBIQ")  # magic, version, rate, samples of the stream

_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def checksum(page: bytes) -> int:
    """Of a page whose checksum field is zero."""
    plain = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(plain.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = _PAGE.pack(CAPTURE, 0, flags, granule, serial, number, 0, len(lacing))
    page = head + lacing + body
    return page[:22] + struct.pack("<I", checksum(page)) + page[26:]


def _pages(serial: int, packets: list[bytes]) -> Iterator[bytes]:
    """The pages of one logical stream: identification alone on the first, then the packets."""
    ident = _IDENT.pack(_MAGIC, 1, RATE, sum(map(len, packets)))
    yield _page(FIRST, 0, serial, 0, bytes([len(ident)]), ident)
    lacing = bytearray()
    done: list[tuple[int, int]] = []  # the segment after a packet's last, and the samples by then
    samples = 0
    for p in packets:
        lacing += b"\xff" * (len(p) // 255) + bytes([len(p) % 255])
        samples += len(p)
        done.append((len(lacing), samples))
    body, at, number, finished = b"".join(packets), 0, 1, 0
    for first in range(0, max(1, len(lacing)), 255):
        part = bytes(lacing[first : first + 255])
        flags, granule = (CONTINUED if first and lacing[first - 1] == 255 else 0), NO_GRANULE if packets else 0
        while finished < len(done) and done[finished][0] <= first + len(part):
            granule = done[finished][1]
            finished += 1
        if first + 255 >= len(lacing):
            flags |= LAST
        size = sum(part)
        yield _page(flags, granule, serial, number, part, body[at : at + size])
        at, number = at + size, number + 1


def mux(payload: bytes, packet: int = PACKET) -> bytes:
    """The payload as an Ogg stream: packets go to the logical streams in turn."""
    cut = [payload[i : i + packet] for i in range(0, len(payload), packet)]
    streams = [list(_pages(s, cut[k :: len(STREAMS)])) for k, s in enumerate(STREAMS)]
    out = [pages.pop(0) for pages in streams]  # all first pages come before any other
    for k in range(max(map(len, streams))):
        out += [pages[k] for pages in streams if k < len(pages)]
    return b"".join(out)


@dataclass
class Logical:
    """A logical stream as it is read."""

    rate: int = 0
    length: int = 0
    packets: list[bytes] = field(default_factory=list)
    partial: list[bytes] = field(default_factory=list)
    times: list[float] = field(default_factory=list)
    number: int = 0
    samples: int = 0
    ended: bool = False


def demux(media: bytes) -> tuple[dict[int, Logical], int]:
    """The logical streams by serial number, and how many pages there are."""
    streams: dict[int, Logical] = {}
    at = pages = 0
    while at < len(media):
        if len(media) - at < _PAGE.size:
            raise ValueError("a page is cut off")
        capture, version, flags, granule, serial, number, crc, n = _PAGE.unpack_from(media, at)
        lacing = media[at + _PAGE.size : at + _PAGE.size + n]
        start, size = at + _PAGE.size + n, sum(lacing)
        if capture != CAPTURE or version or len(lacing) < n or start + size > len(media):
            raise ValueError("not a whole page")
        if checksum(media[at : at + 22] + bytes(4) + media[at + 26 : start + size]) != crc:
            raise ValueError("a page's checksum is wrong")
        stream = streams.get(serial)
        if flags & FIRST:
            if stream or number:
                raise ValueError("a stream begins twice")
            if size != _IDENT.size or n != 1:
                raise ValueError("not an identification packet")
            magic, _, rate, length = _IDENT.unpack_from(media, start)
            if magic != _MAGIC or not rate:
                raise ValueError("an unknown stream")
            streams[serial] = Logical(rate, length, number=1)
        else:
            if stream is None or stream.ended or number != stream.number or bool(flags & CONTINUED) != bool(stream.partial):
                raise ValueError("a page is missing or out of place")
            whole = at_segment = 0
            for i, x in enumerate(lacing):
                if x < 255:
                    stop = start + sum(lacing[at_segment : i + 1])
                    stream.partial.append(media[start:stop])
                    stream.packets.append(b"".join(stream.partial))
                    stream.samples += len(stream.packets[-1])
                    stream.partial.clear()
                    start, at_segment, whole = stop, i + 1, whole + 1
            if at_segment < n:
                stream.partial.append(media[start : start + sum(lacing[at_segment:])])
                start += len(stream.partial[-1])
            if granule != (stream.samples if whole or not n else NO_GRANULE):
                raise ValueError("a granule position does not fit the packets")
            if whole:
                stream.times.append(granule / stream.rate)
            stream.number += 1
            stream.ended = bool(flags & LAST)
            size = start - (at + _PAGE.size + n)
        at, pages = at + _PAGE.size + n + size, pages + 1
    if any(not s.ended or s.partial or s.samples != s.length for s in streams.values()):
        raise ValueError("a stream does not end")
    return streams, pages


def payload_of(streams: dict[int, Logical]) -> bytes:
    """The payload again: packets of the logical streams in turn."""
    lists = [streams[s].packets for s in STREAMS]
    return b"".join(lists[k % len(lists)][k // len(lists)] for k in range(sum(map(len, lists))))


def features(payload: bytes, streams: dict[int, Logical], pages: int) -> str:
    """Pages, packets, duration, level and zero crossings about the middle, as text."""
    samples = np.frombuffer(payload, np.uint8)
    mean = float(samples.mean(dtype=np.float64))
    crossings = int(np.count_nonzero(np.diff(samples > 127)))
    duration = sum(s.times[-1] for s in streams.values() if s.times)
    packets = sum(len(s.packets) for s in streams.values())
    return f"pages={pages};packets={packets};seconds={duration:.6f};mean={mean:.6f};crossings={crossings}"


def padded(text: bytes, block: int = BLOCK) -> bytes:
    return text.ljust(max(block, -(-len(text) // block) * block), b" ")


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in shared.slices([whole], 1)):
        texts = batch.column(1)
        sizes, media = [], []
        for i in range(batch.num_rows):
            text = texts[i].as_buffer().to_pybytes()
            sizes.append(len(text))
            media.append(mux(padded(text)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"]
        )


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        stored = batch.column(2)
        cols: list[list] = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), *([] for _ in names[2:])]
        for i in range(batch.num_rows):
            media = stored[i].as_buffer().to_pybytes()
            streams, pages = demux(media)
            payload = payload_of(streams)
            row = (
                len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]),
                len(media), hashlib.sha256(media).hexdigest(), features(payload, streams, pages),
            )
            for c, v in zip(cols[2:], row, strict=True):
                c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text as an Ogg stream, in a stored table."""
    shared.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), shared.utf8(text_col).alias("text"))
    return shared.stored(rows.mapInArrow(_encode, "doc_id long, n_bytes long, media binary"), "media")


def media_features(media: DataFrame) -> DataFrame:
    """Digests and features of a media column, read back from its stored bytes."""
    shared.ship(media.sparkSession)
    return media.select("doc_id", "n_bytes", "media").mapInArrow(
        _decode,
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
        "media_sha256 string, feature string",
    )
