"""Hierarchical multi-length packing.

Documents become token ids and then windows of several lengths ("tiers", powers of two). A
document longer than the longest tier first gives whole longest windows. What remains is routed
to the shortest tier that holds it; there it opens a window. The gap of a window is filled from
shorter tiers, longest fitting piece first, and a last piece is cut to close the gap exactly, so
windows are full and carry no padding. What is left when a partition ends is cut into windows
whose lengths are powers of two. Windows of one tier are then dealt into step groups of equal
token budget whose attention cost (the sum of the squares of the piece lengths) is balanced.

Nothing is shuffled: each input split is packed by itself in bounded buffers, and a lost task is
repeated from its split alone. Sequence and step ids begin with the split's number.

Cases: a null or empty text is a document of one token (the end id); a null id stays null;
repeated rows are packed as documents of their own; an empty table gives no rows; other columns
of the input are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .tokens import END_ID, encoder, vocabulary_path, with_end

WINDOW = 2048
#: Shortest tier to which a document is routed; shorter windows come only at a split's end.
LEAST_TIER = 256
#: Tokens in one step group, and tokens that are packed at a time.
STEP_TOKENS = 16 * WINDOW
BUFFER_TOKENS = 1 << 19
#: Bytes of texts that a worker encodes at a time; it holds about twelve times as much meanwhile.
CHUNK = 4 << 20

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_id long"
)


def tiers(window: int = WINDOW, least: int = LEAST_TIER) -> list[int]:
    """Window lengths, longest first."""
    out = [window]
    while out[-1] > least:
        out.append(out[-1] // 2)
    return out


class Pool:
    """Pieces of one tier, sorted by length; a piece is (length, document, start)."""

    def __init__(self, pieces=()):
        self.pieces = sorted(pieces)

    def __len__(self):
        return len(self.pieces)

    def add(self, piece) -> None:
        bisect.insort(self.pieces, piece)

    def longest_within(self, room: int):
        """Take out the longest piece of at most ``room`` tokens, or None."""
        at = bisect.bisect_right(self.pieces, (room, np.inf, 0))
        return self.pieces.pop(at - 1) if at else None


def pack(lengths: list[int], window: int, least: int, last: bool):
    """Windows for documents of these lengths: (capacity, [(document, start, length), ...]), and
    the pieces left over. All are packed if ``last``; else what fills no window is left."""
    sizes = tiers(window, least)
    pools: dict[int, Pool] = {c: [] for c in sizes}
    windows = []
    for doc, n in enumerate(lengths):
        whole = n // window * window
        windows += [(window, [(doc, s, window)]) for s in range(0, whole, window)]
        if n > whole:
            rest = n - whole
            pools[max(least, 1 << (rest - 1).bit_length())].append((rest, doc, whole))
    pools = {c: Pool(p) for c, p in pools.items()}
    for tier, capacity in enumerate(sizes):
        below = sizes[tier + 1 :]
        while pools[capacity]:
            n, doc, start = pools[capacity].pieces.pop()
            content, room = [(doc, start, n)], capacity - n
            for c in (*below, capacity):
                while room and (found := pools[c].longest_within(room)):
                    content.append((found[1], found[2], found[0]))
                    room -= found[0]
            for c in (*reversed(below), capacity):
                if room and pools[c]:
                    n, doc, start = pools[c].pieces.pop(0)  # all of these are longer than the gap
                    content.append((doc, start, room))
                    rest = n - room
                    pools[max(least, 1 << (rest - 1).bit_length())].add((rest, doc, start + room))
                    room = 0
            if room:  # nothing of this tier or a shorter one is left
                left = content
                return (windows + _tail(left, capacity), []) if last else (windows, left)
            windows.append((capacity, content))
    return windows, []


def _tail(pieces, capacity: int):
    """Cut what is left into windows whose lengths are powers of two, so none is padded."""
    out, size = [], capacity
    total = sum(n for _, _, n in pieces)
    pieces = list(reversed(pieces))
    while total:
        while size > total:
            size //= 2
        content, room = [], size
        while room:
            doc, start, n = pieces.pop()
            take = min(n, room)
            content.append((doc, start, take))
            if take < n:
                pieces.append((doc, start + take, n - take))
            room -= take
        out.append((size, content))
        total -= size
    return out


def balanced_steps(windows, step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for each window: groups hold windows of one tier, step_tokens in all, and
    windows are dealt back and forth by falling attention cost."""
    group, first = [0] * len(windows), 0
    by_tier: dict[int, list[tuple[int, int]]] = {}
    for i, (capacity, content) in enumerate(windows):
        by_tier.setdefault(capacity, []).append((-sum(n * n for _, _, n in content), i))
    for capacity in sorted(by_tier, reverse=True):
        members = sorted(by_tier[capacity])
        n = -(-len(members) * capacity // step_tokens)
        for k, (_, i) in enumerate(members):
            turn, at = divmod(k, n)
            group[i] = first + (at if turn % 2 == 0 else n - 1 - at)
        first += n
    return group


def _packer(path: str, window: int, least: int, end_id: int, placed: bool, buffer_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_column
        base = TaskContext.get().partitionId() << 32
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_id"]
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        if placed:
            names.append("place")
            kinds.append(pa.int64())
        # (doc_id, where its piece starts in the document, ids, tokens of the document, its place)
        held: list[tuple] = []
        sequences = steps = waiting = read = 0

        def flush(last: bool):
            nonlocal held, sequences, steps, waiting
            windows, left = pack([len(x[2]) for x in held], window, least, last)
            windows.sort(key=lambda w: min((held[d][4], held[d][1] + s) for d, s, _ in w[1]))
            groups = balanced_steps(windows)
            cols: list[list] = [[] for _ in names]
            for (capacity, content), g in zip(windows, groups, strict=True):
                offset, first = 0, min(held[d][4] for d, _, _ in content)
                for doc, start, n in content:
                    doc_id, before, ids, total, _ = held[doc]
                    crc = zlib.crc32(ids[start : start + n])
                    row = (doc_id, before + start, n, crc, total, base + sequences, offset, capacity, base + steps + g, first)[: len(names)]
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
                    offset += n
                sequences += 1
            steps += max(groups, default=-1) + 1
            held = [(held[d][0], held[d][1] + s, held[d][2][s : s + n], *held[d][3:]) for d, s, n in left]
            waiting = sum(len(x[2]) for x in held)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for batch in shared.released(shared.slices(batches, 1, CHUNK)):
            ids, bounds = with_end(*encode(batch.column(1)), end_id)
            places = batch.column(2).to_pylist() if placed else range(read, read + batch.num_rows)
            read += batch.num_rows
            for doc_id, a, b, at in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), places, strict=True):
                held.append((doc_id, 0, ids[a:b], b - a, at))
                waiting += b - a
                if waiting >= buffer_tokens:
                    yield flush(False)
        yield flush(True)

    return run


def packed_sequences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    window: int = WINDOW, least_tier: int = LEAST_TIER, end_id: int = END_ID, place: F.Column | None = None,
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """One row a piece: where it lies in its document (``start``, ``length``, ``doc_tokens``) and in
    its sequence (``sequence_id``, ``offset``), its ids' checksum, the window's tier and its step group.

    Sequences follow the order of their split's rows but for what ``buffer_tokens`` hold at a time.
    With ``place`` (a whole number by which rows of all splits are ordered) there is a last column
    ``place``, the least of the sequence's documents, which orders the sequences of all splits."""
    if window & (window - 1) or least_tier & (least_tier - 1) or not 0 < least_tier <= window:
        raise ValueError("windows are powers of two")
    shared.ship(docs.sparkSession)
    rows = [F.col(id_col).cast("long").alias("doc_id"), shared.utf8(text_col).alias("text")]
    rows = docs.select(*rows, *([] if place is None else [F.coalesce(place, F.lit(0)).cast("long").alias("place")]))
    run = _packer(vocabulary or vocabulary_path(), window, least_tier, end_id, place is not None, buffer_tokens)
    return rows.mapInArrow(run, SCHEMA if place is None else f"{SCHEMA}, place long")
