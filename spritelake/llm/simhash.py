"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has a bit for each of 64 positions: 1 if more than half of its word
shingles' 64-bit hashes have it. Two fingerprints link at ``distance`` or fewer differing bits.

Candidates come from equality joins. A fingerprint is cut into ``distance // 2 + 1`` segments, so
one segment of a linked pair differs by at most one bit. Each segment is indexed once for each of
its bits, with that bit deleted: a pair that links shares a variant. For distance 3 that is two
segments of 32 bits and 64 signatures of 31 bits a fingerprint. Only distinct fingerprints are
indexed, so copies cost nothing more, and every candidate is verified.

All members of a signature meet in one run of a sorted partition. A run never emits its pairs: a
search that removes what it reaches gives a spanning forest, and a run with very many members is
first cut by the bytes outside the segment, of which one must be equal, so that the search stays
small and exact. A task joins its forests into stars; rounds of large and small stars over
stored tables then give the components, without bringing links to the driver.

Cases: a null, empty or blank text has fingerprint zero and links like any other; fewer words
than a shingle hash as one sequence; repeated rows share a fingerprint; a null id never names a
component unless no other id is in it (then the component is null); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Bytes of a text whose words are held at a time.
CHUNK = 4 << 20
#: Members of a signature beyond which a run is cut by the bytes outside its segment.
LARGE_RUN = 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def _words(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, in lists of bounded size."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > CHUNK and (found := _SPACE.search(text, at + CHUNK)):
            end = found.start()
        yield text[at:end].lower().split()
        at = end


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text as an unsigned integer."""
    digest = xxhash.xxh64_intdigest
    ones, total, kept = np.zeros((8, 8), np.int64), 0, []

    def count(shingles: list[bytes]):
        h = np.array([digest(s, SEED) for s in shingles], dtype="<u8").view(np.uint8).reshape(-1, 8)
        if len(h) < 256:
            ones[:] += np.unpackbits(h, axis=1, bitorder="little").sum(0, dtype=np.int64).reshape(8, 8)
        else:
            for k in range(8):
                ones[k] += np.bincount(h[:, k], minlength=256) @ _BITS
        return len(h)

    for more in _words(text):
        kept += more
        if len(kept) >= shingle:
            total += count([b" ".join(x) for x in zip(*(kept[i:] for i in range(shingle)), strict=False)])
            kept = kept[len(kept) - shingle + 1 :]
    if not total and kept:
        total = count([b" ".join(kept)])
    bits = (2 * ones.ravel() > total).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            values = [fingerprint(column[i].as_buffer().to_pybytes(), shingle) for i in range(batch.num_rows)]
            out = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), out], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row as a signed 64-bit integer."""
    shared.ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), shared.utf8(text_col).alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return list(zip(cuts, (b - a for a, b in zip(cuts, cuts[1:], strict=False)), strict=False))


def signatures(prints: DataFrame, distance: int) -> DataFrame:
    """(segment, bit, value, fp): each segment with each of its bits deleted in turn."""
    variants = []
    for k, (first, bits) in enumerate(segments(distance)):
        part = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1 if bits < 64 else -1))
        variants += [
            F.struct(F.lit(k * 64 + i).alias("slot"), part.bitwiseAND(F.lit(~(1 << i) if i < 63 else (1 << 63) - 1)).alias("value"))
            for i in range(bits)
        ]
    return prints.select("fp", F.explode(F.array(*variants)).alias("s")).select("s.slot", "s.value", "fp")


class Stars:
    """Union-find over the fingerprints that a task has linked."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.parent.setdefault(x, x)
        while up != (above := self.parent[up]):
            self.parent[x] = above
            x, up = up, above
        return up

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def search(members: np.ndarray, distance: int, stars: Stars) -> None:
    """Link members of one signature: what a search reaches leaves the rest at once."""
    rest = members
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        root = int(front[0])
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= distance
            if near.any():
                hit, rest = rest[near], rest[~near]
                for x in hit.tolist():
                    stars.link(root, x)
                front.extend(hit)


def link_run(members: np.ndarray, slot: int, distance: int, stars: Stars) -> None:
    """Link the members of one signature; many members are cut first."""
    if len(members) == 2:
        if (int(members[0]) ^ int(members[1])).bit_count() <= distance:
            stars.link(int(members[0]), int(members[1]))
        return
    if len(members) <= LARGE_RUN:
        return search(members, distance, stars)
    first, bits = segments(distance)[slot // 64]
    outside = [b for b in range(64) if not first <= b < first + bits]
    parts = np.array_split(np.array(outside, np.uint64), distance + 1)  # one of them is equal
    for part in parts:
        mask = np.uint64(sum(1 << int(b) for b in part))
        keys = members & mask
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        for group in np.split(members[order], cuts):
            search(group, distance, stars)


def _runs(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stars = Stars()
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3

        def runs(slots, values, prints, last: bool) -> int:
            """Link whole runs; where the last run, which may go on, begins."""
            cuts = np.flatnonzero((np.diff(slots) != 0) | (np.diff(values) != 0)) + 1
            starts = np.concatenate([np.zeros(1, np.int64), cuts])
            ends = np.append(cuts, len(slots))
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            for k in np.flatnonzero(ends - starts > 1):
                a, b = int(starts[k]), int(ends[k])
                link_run(prints[a:b].view(np.uint64), int(slots[a]), distance, stars)
            return int(cuts[-1]) if len(cuts) else 0

        for batch in batches:
            more = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3)]
            held = [np.concatenate(x) for x in zip(held, more, strict=True)]
            if len(held[0]):
                at = runs(*held, last=False)
                held = [x[at:] for x in held]
        if len(held[0]):
            runs(*held, last=True)
        nodes = list(stars.parent)
        pairs = [(x, r) for x in nodes if (r := stars.root(x)) != x]
        both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return run


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links between distinct fingerprints that span the same components as all pairs
    within ``distance`` do."""
    dealt = signatures(prints, distance).repartition("slot", "value").sortWithinPartitions("slot", "value")
    return dealt.mapInArrow(_runs(distance), "a long, b long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each linked node reaches, by rounds of large and small
    stars. Each round is a stored table; the last two are told apart by a count and a hash sum. Least
    neighbours are stored as well: the joins with them then stand right above their shuffles, so
    Spark can split the rows of a node that very many others link with."""

    def signature(df):
        return df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()

    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    pairs = shared.stored(pairs, "pairs")
    before = signature(pairs)
    while before[0]:
        both = pairs.union(pairs.select("v", "u"))
        least = shared.stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = shared.stored(large, "large")
        lower = shared.stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lower)
        small = shared.stored(small.filter("u != v").distinct(), "pairs")
        for done in (pairs, least, large, lower):
            shared.discard(done)
        pairs, after = small, signature(small)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """One row a document: doc_id, fp (signed), component_id (the smallest id that its links reach)."""
    prints = shared.stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = shared.stored(components(links(nodes.select("fp"), distance)), "roots")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    firsts = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = linked.join(firsts, "root").select("fp", "component_id")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    # Read from a table, so that the join below stands right above its shuffles and Spark can split
    # the rows of a fingerprint that very many copies share.
    named = shared.stored(named, "named")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(column: str) -> F.Column:
    """A signed 64-bit integer as 16 lower-case digits of its unsigned value."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
