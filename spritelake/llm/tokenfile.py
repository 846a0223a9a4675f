"""A binary format for token ids with Elias-Fano encoded document boundaries.

A shard holds the ids of consecutive documents in one array (2 bytes an id where the vocabulary
allows it, else 4). The places where documents end rise strictly, so they are stored by
Elias-Fano: the low ``l`` bits of each as they are, the high parts in unary, about 2 + l bits a
document with l = log2(ids / documents). The documents' own ids do not fall, so they are stored in the
same way, from the least. The place of every 256th one bit is sampled (32 bits each), so ``select(i)``
reads one sample and a short stretch of bits; readers fetch documents by select alone.

Texts are tokenised where they lie; their token ids are range-partitioned and sorted by document id
before they are encoded, so shards follow each other in ascending order of id. Shards are rows of a
table in the shared folder: Spark's commit protocol makes a shard whole or absent, whatever
executor is lost.

Cases: a null or empty text has the end id alone; a null doc_id sorts first and stays null;
repeated ids keep all their rows (their order among each other is by a hash of the text); an
empty table gives no shards and no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import shared
from .tokens import END_ID, encoder, vocabulary_path, with_end

MAGIC = b"EFTOK002"
SAMPLE = 256
#: Ids in a shard; a document longer than this has a shard of its own.
SHARD_IDS = 2 << 20
# Magic, documents, documents without id, ids, bytes an id, least document id; then, of document ids
# and of boundaries, the low bits and the sizes of the three parts.
_HEAD = struct.Struct("<8sQQQBq" + "BQQQ" * 2)


def elias_fano(values: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, low parts, high parts, samples) of a non-falling array of unsigned integers."""
    values = values.astype(np.uint64)
    n, top = len(values), int(values[-1]) if len(values) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = (values[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
    high[ones] = 1
    lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return low, lows, np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4").tobytes()


class Rising:
    """A non-falling array by Elias-Fano, as it lies in a shard."""

    def __init__(self, n: int, low: int, lows: memoryview, highs: memoryview, samples: memoryview):
        self.n, self.low, self.lows = n, low, lows
        self.highs, self.samples = highs, np.frombuffer(samples, "<u4")

    def select(self, i: int) -> int:
        """Value ``i``, by the nearest sample before it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at // 8
        piece = self.highs[byte] >> (at % 8) << (at % 8)
        while (found := piece.bit_count()) <= left:
            left -= found
            byte += 1
            piece = self.highs[byte]
        for _ in range(left):
            piece &= piece - 1
        one = byte * 8 + (piece & -piece).bit_length() - 1
        first = i * self.low
        part = int.from_bytes(self.lows[first // 8 : (first + self.low + 7) // 8], "little")
        return (one - i) << self.low | (part >> first % 8) & ((1 << self.low) - 1)


class Shard:
    """The documents of a shard. Nothing is decoded but what is asked for."""

    def __init__(self, blob: bytes):
        view = memoryview(blob)
        magic, self.documents, self.nulls, total, width, self.least, *parts = _HEAD.unpack_from(view)
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        at, pieces = _HEAD.size, []
        for size in (*parts[1:4], *parts[5:8], width * total):
            pieces.append(view[at : at + size])
            at += size
        if at != len(view):
            raise ValueError("a shard is cut off")
        self.names = Rising(self.documents - self.nulls, parts[0], *pieces[:3])
        self.ends = Rising(self.documents, parts[4], *pieces[3:6])
        self.ids = np.frombuffer(pieces[6], f"<u{width}")

    def doc_id(self, i: int) -> int | None:
        """Documents without id come first."""
        return None if i < self.nulls else self.names.select(i - self.nulls) + self.least

    def start(self, i: int) -> int:
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i``, by two selects."""
        return self.ids[self.start(i) : self.ends.select(i)]


def write_shard(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    """The bytes of a shard: header, document ids and boundaries by Elias-Fano, id array. The
    documents come in ascending order of id, those without id first."""
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    least = int(known[0]) if len(known) else 0
    names = elias_fano(known.view(np.uint64) - np.int64(least).view(np.uint64))
    bounds = elias_fano(ends)
    sizes = [x for part in (names, bounds) for x in (part[0], *map(len, part[1:]))]
    head = _HEAD.pack(MAGIC, len(doc_ids), len(doc_ids) - len(known), len(ids), width, least, *sizes)
    return b"".join([head, *names[1:], *bounds[1:], ids.astype(f"<u{width}").tobytes()])


def _tokens(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(path)
        kind = "<u2" if id_width(library, end_id) == 2 else "<u4"
        for batch in shared.slices(batches, 2):
            ids, bounds = with_end(*library.encode_column(batch.column(2)), end_id)
            ids = ids.astype(kind)
            coded = [ids[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(coded, pa.binary())], ["doc_id", "tie", "ids"])

    return run


def id_width(library, end_id: int) -> int:
    """Bytes that an id of a vocabulary takes."""
    return 2 if max(library.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4


def _writer(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = id_width(encoder(path), end_id)
        part, number = TaskContext.get().partitionId(), 0
        names: list = []
        arrays: list[np.ndarray] = []
        sizes: list[int] = []
        total = 0

        def shard():
            nonlocal number, total
            blob = write_shard(names, np.cumsum(sizes), np.concatenate(arrays), width)
            row = [[part], [number], [len(names)], [total], [blob]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            number, total = number + 1, 0
            for x in (names, arrays, sizes):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["part", "number", "documents", "ids", "shard"]
            )

        for batch in batches:
            coded = batch.column(1)
            for i, name in enumerate(batch.column(0).to_pylist()):
                ids = np.frombuffer(coded[i].as_buffer(), f"<u{width}")
                if names and total + len(ids) > shard_ids:
                    yield shard()
                names.append(name)
                arrays.append(ids.copy())  # a batch is not held for one of its documents
                sizes.append(len(ids))
                total += len(ids)
        if names:
            yield shard()

    return run


def write_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    end_id: int = END_ID, shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Write the shards of all documents in ascending order of id; the table of shards
    (part, number, documents, ids, shard), read back from the shared folder."""
    shared.ship(docs.sparkSession)
    path = vocabulary or vocabulary_path()
    text = shared.utf8(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    # Texts are read once; what is shuffled in order of id are their token ids.
    tokens = shared.stored(rows.mapInArrow(_tokens(path, end_id), "doc_id long, tie long, ids binary"), "token_ids")
    ordered = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "ids")
    shards = ordered.mapInArrow(_writer(path, end_id, shard_ids), "part long, number long, documents long, ids long, shard binary")
    out = shared.stored(shards, "token_shards")
    shared.discard(tokens)
    return out


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard = Shard(batch.column(2)[i].as_buffer().to_pybytes())
            n = shard.documents
            starts = [shard.start(k) for k in range(n)]
            found = [shard.document(k) for k in range(n)]
            crcs = [zlib.crc32(ids.astype("<u4")) for ids in found]
            names = [shard.doc_id(k) for k in range(n)]
            cols = [[batch.column(0)[i].as_py()] * n, [batch.column(1)[i].as_py()] * n, names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (*cols, starts, list(map(len, found)), crcs)],
                ["part", "number", "doc_id", "local_start", "n_tokens", "ids_crc32"],
            )


def read_tokens(shards: DataFrame) -> DataFrame:
    """One row a document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    shared.ship(shards.sparkSession)
    local = shards.select("part", "number", "shard").mapInArrow(
        _reader, "part long, number long, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    )
    # Two levels of running sums: over the shards of a part, and over the parts.
    sizes = shards.select("part", "number", "ids")
    parts = sizes.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "number", F.coalesce(F.sum("ids").over(within), F.lit(0)).alias("shard_start"))
    starts = starts.join(parts, "part").select("part", "number", (F.col("part_start") + F.col("shard_start")).alias("first"))
    return local.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("first") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
