"""SimHash near-dedup at a shingle similarity: one document of each group of near copies.

Two texts are near copies if the sets of their five-word shingles have a Jaccard similarity of 0.8
or more. A text's fingerprint is the SimHash of its whole set: each bit is 1 if more than half of the
shingles' hashes have it (a tie is decided by counts of other bits, as one by a fixed rule would turn
many bits at once, or none, where few shingles often tie). At 0.8 two texts differ in about
15 of 100 bits (acos(8/9) / pi), so 64 bits with a radius of 3, as in :mod:`simhash`, would miss most
pairs; the fingerprint has ``SUBSETS`` times 64 bits, each 64 of hashes of their own.

Candidates come from segments of 16 bits with one bit deleted. Each fingerprint is dealt under each
of its bytes, equal in a pair whose segment differs in the other byte; there each bit of that other
byte is deleted in turn, and fingerprints that then agree meet. A pair that differs in fewer than 80
of 640 bits meets for certain; a pair at 0.8 has a segment in common with a probability of 0.279
each, so all 40 miss it with one of 0.000002 (0.0006 for 4 shingles within 5, the smallest such texts).
Of those that meet, fingerprints link at ``RADIUS`` or fewer differing bits of the first 192 (about 29
at 0.8, 96 for unlike texts).

Links of fingerprints become clusters by the rounds of stars of :mod:`simhash`, and the texts of a
cluster are compared on whole shingle sets: a search that removes what it reaches gives a spanning
forest of the links at 0.8, not of pairs. A cluster of more than ``LARGE`` texts is dealt into chunks,
each with ``PIVOTS`` texts from the middle of the cluster; then every text outside the cluster's
largest component is compared with all of the cluster, so that no link is lost. Verified links become
components in the same way.

Equal word sequences are one text from the start. Shingles are compared as 32-bit hashes: two
different ones of a pair of texts count as equal with a probability of 2 ** -32 each.

Cases: a null, empty or blank text equals other such texts and resembles nothing else; fewer words
than a shingle are one shingle; of a component the row with the smallest id stays, a row without
id only if no row of it has an id; rows that share an id, or have none, count as one document only
where their texts link; of repeated rows one stays; an empty table gives no rows; all columns of
the input are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared, simhash

SHINGLE = 5
SIMILARITY = 0.8
#: Subsets of 64 bits of a fingerprint.
SUBSETS = 10
#: How many subsets away the counts are that decide a tie, one after the other.
TIES = (4, 2, 6)
#: Differing bits of the first ``WIDE`` subsets, and of the first one, at which fingerprints link.
WIDE = 3
RADIUS = 55
FIRST = 26
#: Fingerprints of a signature beyond which it is searched, not compared pair by pair.
MANY = 64
#: Rows of whole cells whose fingerprints a task compares at a time.
BLOCK = 1 << 17
#: Texts of a cluster beyond which it is dealt into chunks, and its texts that each chunk has.
LARGE = 1024
PIVOTS = 16
#: Bits of a map of the texts in clusters, whose shingle sets alone are shuffled.
MAPPED = 1 << 25
#: Bytes of shingle sets that a run holds at a time (or 2 * PIVOTS texts, if they are longer); beyond
#: that it is searched in parts, and PIVOTS texts of a part, the middle ones first, stay for the next.
#: Clusters are dealt into chunks of an eighth to a quarter of it.
RUN_BYTES = 16 << 20
#: Bytes of texts, or of a piece of a longer one, that are cut into words at a time.
CHUNK = 4 << 20

_RNG = np.random.default_rng(20)
_FLIPS = _RNG.integers(0, 1 << 63, SUBSETS).astype(np.uint64)
_TURNS = (_RNG.integers(0, 1 << 63, SUBSETS).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
#: One bit of each byte.
_LANES = np.uint64(0x0101010101010101)
_ODD = (np.random.default_rng(5).integers(0, 1 << 63, 64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def _word_hashes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word (A-Z lower-cased, between ASCII white space) of the pieces in a
    row, and the words of each piece. A distinct word is hashed once."""
    low = pc.ascii_lower(pa.array(pieces, pa.large_binary()).view(pa.large_string()))
    split = pc.ascii_split_whitespace(low)
    bounds = split.offsets.to_numpy()
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).view(pa.large_binary()).dictionary_encode()
    words = coded.dictionary.to_pylist()
    table = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    place = coded.indices.to_numpy()
    full = np.ones(len(words) + 1, bool)
    full[words.index(b"") if b"" in words else -1] = False
    kept = full[place]
    counts = np.concatenate([np.zeros(1, np.int64), np.cumsum(kept)])[bounds - bounds[0]]
    return table[place[kept]], np.diff(counts)


def _pieces(text: bytes) -> list[bytes]:
    """A text in pieces of bounded size, cut at white space."""
    out, at = [], 0
    while len(text) - at > CHUNK and (found := simhash._SPACE.search(text, at + CHUNK)):
        out.append(text[at : found.start()])
        at = found.start()
    return [*out, text[at:]]


def fingerprints(grams: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each set, a row of ``SUBSETS`` integers; ``grams`` has the sorted members of
    all sets in a row, ``sizes`` how many each has (at least one)."""
    starts = np.cumsum(sizes) - sizes
    # Eight counters share an integer, so at most 255 members are added up at a time.
    parts = -(-sizes // 255)
    first = np.cumsum(parts) - parts
    pieces = np.repeat(starts, parts) + 255 * (np.arange(parts.sum()) - np.repeat(first, parts))
    over = np.empty((len(sizes), SUBSETS, 8, 8), np.int32)  # by subset, bit of a byte, and byte
    least = np.empty(over.shape, bool)
    for k in range(SUBSETS):
        x = _mixed((grams.astype(np.uint64) ^ _FLIPS[k]) * _TURNS[k])
        for b in range(8):
            ones = np.add.reduceat((x >> np.uint64(b)) & _LANES, pieces).astype("<u8").view(np.uint8).reshape(-1, 8)
            over[:, k, b] = 2 * np.add.reduceat(ones, first, axis=0, dtype=np.int64) - sizes[:, None]
            least[:, k, b] = (x[starts] >> np.uint64(b) & _LANES).astype("<u8").view(np.uint8).reshape(-1, 8)
    votes = over
    for turn in TIES:
        votes = np.where(votes == 0, np.roll(over, turn, axis=1), votes)
    bits = np.packbits(np.where(votes == 0, least, votes > 0).transpose(0, 1, 3, 2), axis=-1, bitorder="little")
    return bits.reshape(len(sizes), 8 * SUBSETS).view("<i8")


def features(texts: list[bytes], size: int = SHINGLE) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of whole texts: the 128-bit digest of each word sequence; which texts have words; their
    fingerprints, a row each; and the distinct shingles of all texts in a row as 32-bit hashes, with
    how many each text has."""
    pieces = [_pieces(t) for t in texts]
    flat = [p for some in pieces for p in some]
    if sum(map(len, flat)) > 2 * CHUNK:  # one very long text
        parts = [_word_hashes([p]) for p in flat]
        hashes, counts = np.concatenate([h for h, _ in parts]), np.concatenate([c for _, c in parts])
    else:
        hashes, counts = _word_hashes(flat) if flat else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    of_text = np.repeat(np.arange(len(texts)), [len(some) for some in pieces])
    n = np.bincount(of_text, weights=counts, minlength=len(texts)).astype(np.int64)
    ends = np.cumsum(n)
    digests = [xxhash.xxh3_128_digest(hashes[e - k : e].tobytes()) for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
    owner = np.repeat(np.arange(len(texts)), n)
    found, own = [], []
    if len(hashes) >= size:
        whole = owner[: len(hashes) - size + 1] == owner[size - 1 :]
        total = np.full(len(whole), size, np.uint64)
        for k in range(size):
            total += hashes[k : len(whole) + k] * _ODD[k]
        found.append(_mixed(total[whole]))
        own.append(owner[: len(whole)][whole])
    for i in np.flatnonzero((n > 0) & (n < size)).tolist():  # a text shorter than a shingle is one
        few = hashes[ends[i] - n[i] : ends[i]]
        found.append(_mixed(np.array([n[i]], np.uint64) + (few * _ODD[: len(few)]).sum(dtype=np.uint64)))
        own.append(np.array([i]))
    if not found:
        return digests, np.zeros(0, np.int64), np.zeros((0, SUBSETS), np.int64), np.zeros(0, "<u4"), np.zeros(len(texts), np.int64)
    h, own = np.concatenate(found), np.concatenate(own)
    grams = np.sort(own.astype(np.uint64) << np.uint64(32) | h >> np.uint64(32))
    grams = grams[np.concatenate([np.ones(1, bool), grams[1:] != grams[:-1]])]
    sizes = np.bincount((grams >> np.uint64(32)).astype(np.int64), minlength=len(texts))
    filled, grams = np.flatnonzero(sizes), grams.astype("<u4")
    marks = fingerprints(grams, sizes[filled])
    return digests, filled, marks, grams, sizes


def _features(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shared.slices(batches, 2, CHUNK):
            column = batch.column(2)
            digests, filled, marks, grams, sizes = features([column[i].as_buffer().to_pybytes() for i in range(batch.num_rows)], size)
            has = np.zeros(batch.num_rows + 1, np.int32)
            has[filled + 1] = marks.shape[1]
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
            sets = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((4 * ends).astype("<i8")), pa.py_buffer(np.ascontiguousarray(grams))])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.cumsum(has, dtype=np.int32)), pa.array(np.ascontiguousarray(marks).ravel())), sets.cast(pa.binary()), pa.array(sizes),
                ],
                ["doc_id", "hash", "key", "marks", "grams", "size"],
            )

    return run


def linked(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """A spanning forest of the sets whose similarity is reached: what a search reaches leaves the
    rest at once."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) < 2 or not sizes.all():
        return []
    owners = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
    names, place = np.unique(np.concatenate(sets), return_inverse=True)
    seen = np.zeros(len(names), np.int32)
    waiting, out = np.ones(len(sets), bool), []
    for first in range(len(sets)):
        if not waiting[first]:
            continue
        waiting[first] = False
        front = [first]
        while front and waiting.any():
            at = front.pop()
            own = place[owners[at] : owners[at + 1]]
            seen[own] = 1
            common = np.add.reduceat(seen[place], owners[:-1])
            seen[own] = 0
            hit = np.flatnonzero(waiting & (common >= similarity * (sizes[at] + sizes - common) - 1e-9))
            waiting[hit] = False
            out += [(at, int(x)) for x in hit]
            front += hit.tolist()
    return out


def _search(similarity: float, whole: bool = False):
    """Links of texts in runs of a sorted partition; ``whole`` runs are never searched in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, size = None, {}, 0
        edges: list[tuple[bytes, bytes]] = []

        def flush(last: bool) -> None:
            nonlocal held, size
            keys = list(held)
            found = linked([np.frombuffer(held[k], "<u4") for k in keys], similarity)
            edges.extend((keys[a], keys[b]) for a, b in found)
            reached: dict[int, int] = {}
            for a, _ in found:
                reached[a] = reached.get(a, 0) + 1
            middle = sorted(range(len(keys)), key=lambda a: (-reached.get(a, 0), keys[a]))[:PIVOTS]
            held = {} if last else {keys[a]: held[keys[a]] for a in middle}
            size = sum(map(len, held.values()))

        for batch in batches:
            cells, salts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, grams = batch.column(2).to_pylist(), batch.column(3)
            for i, here in enumerate(zip(cells, salts, strict=True)):
                if here != cell:
                    flush(True)
                    cell = here
                if keys[i] not in held:
                    held[keys[i]] = grams[i].as_buffer().to_pybytes()
                    size += len(held[keys[i]])
                    if not whole and ((size > RUN_BYTES and len(held) > 2 * PIVOTS) or len(held) > 4 * LARGE):
                        flush(False)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"])
                edges.clear()
        flush(True)
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"])

    return run


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each byte of a fingerprint: the cell that the byte names, the segment's other byte,
    the text and the first subsets."""
    bytes_ = 8 * SUBSETS
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            marks = batch.column(1).flatten().to_numpy().astype("<i8").reshape(-1, SUBSETS)
            flat = marks.view(np.uint8).reshape(-1, bytes_).astype(np.int32)
            cells_, other = flat + 256 * np.arange(bytes_, dtype=np.int32), flat[:, np.arange(bytes_) ^ 1]
            columns = [cells_.ravel(), other.ravel(), np.repeat(batch.column(0).to_numpy(), bytes_)]
            columns += [np.repeat(marks[:, k], bytes_) for k in range(WIDE)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "other", "node", *(f"f{k}" for k in range(WIDE))])


def met(cell: np.ndarray, other: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (places of rows) between fingerprints of a cell whose other bytes agree with one bit
    deleted: they span the same components as all such pairs within the radius."""
    none = np.zeros(0, np.int64)
    left, right = [none], [none]
    for bit in range(8):
        value = cell.astype(np.int64) << 8 | (other & ~(1 << bit))
        order = np.argsort(value, kind="stable")
        value = value[order]
        cuts = np.concatenate([np.zeros(1, np.int64), np.flatnonzero(np.diff(value)) + 1, np.array([len(value)])])
        runs = np.diff(cuts)
        for r in np.flatnonzero(runs > MANY).tolist():
            rest = order[cuts[r] : cuts[r + 1]]
            while len(rest) > 1:
                front, rest = [rest[0]], rest[1:]
                while front and len(rest):
                    x = front.pop()
                    near = np.bitwise_count(prints[rest] ^ prints[x]).sum(1, dtype=np.int64) <= RADIUS
                    if near.any():
                        hit, rest = rest[near], rest[~near]
                        left.append(np.full(len(hit), x))
                        right.append(hit)
                        front.extend(hit.tolist())
        ends = np.repeat(cuts[1:], runs)
        at, step = np.flatnonzero(np.repeat(runs <= MANY, runs)), 1
        one = prints[order, 0]
        while len(at := at[at + step < ends[at]]):
            close = at[np.bitwise_count(one[at] ^ one[at + step]) <= FIRST]
            a, b = order[close], order[close + step]
            near = np.bitwise_count(prints[a] ^ prints[b]).sum(1, dtype=np.int64) <= RADIUS
            left.append(a[near])
            right.append(b[near])
            step += 1
    return np.concatenate(left), np.concatenate(right)


def _stars(nodes: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each linked node with the least of its component (links are places in ``nodes``)."""
    names, place = np.unique(nodes, return_inverse=True)
    a, b, label = place[a], place[b], np.arange(len(names))
    while len(apart := np.flatnonzero(label[a] != label[b])):
        a, b = a[apart], b[apart]
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while not np.array_equal(label, up := label[label]):
            label = up
    other = np.flatnonzero(label != np.arange(len(names)))
    return names[other], names[label[other]]


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[list[np.ndarray]] = []
    count = 0

    def compared(last: bool) -> pa.RecordBatch:
        """Compare whole cells; the last cell, which may go on, is kept."""
        nonlocal held, count
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        end = len(columns[0]) if last else int(np.searchsorted(columns[0], columns[0][-1]))
        held = [[c[end:] for c in columns]]
        count = len(columns[0]) - end
        cell, other, node = (c[:end] for c in columns[:3])
        prints = np.stack([c[:end] for c in columns[3:]], axis=1).view(np.uint64)
        names, roots = _stars(node, *met(cell, other, prints)) if end else (node, node)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(roots)], ["a", "b"])

    limit = BLOCK
    for batch in batches:
        if batch.num_rows:
            held.append([batch.column(k).to_numpy() for k in range(3 + WIDE)])
            count += batch.num_rows
        if count >= limit:
            yield compared(False)
            limit = max(BLOCK, 2 * count)  # a cell larger than a block is not copied at each batch
    if count:
        yield compared(True)


def clusters(nodes: DataFrame) -> DataFrame:
    """(node, root): the clusters of texts (key, marks) whose fingerprints link; a node is the hash of
    a key (texts that shared one would only be compared with each other)."""
    rows = nodes.filter(F.size("marks") > 0).select(F.xxhash64("key").alias("node"), "marks")
    schema = "cell int, other int, node long, " + ", ".join(f"f{k} long" for k in range(WIDE))
    dealt = rows.mapInArrow(_dealt, schema).repartition("cell").sortWithinPartitions("cell")
    links = shared.stored(dealt.mapInArrow(_meetings, "a long, b long"), "meetings")
    out = shared.stored(simhash.components(links), "clusters")
    shared.discard(links)
    return out


def cells(members: DataFrame, nodes: DataFrame, large: int = LARGE) -> DataFrame:
    """(cell, salt, key): which texts are compared with each other first. ``members`` has the cluster
    (cell) of each key and its number of ``chunks``."""
    hot = members.filter("chunks > 1")
    if not hot.limit(1).count():
        return members.select("cell", F.lit(0).cast("long").alias("salt"), "key")
    dealt = members.select("cell", F.pmod(F.xxhash64("key"), "chunks").alias("salt"), "key")
    # The middle of a cluster has the segments that most of its texts have.
    words = nodes.select("key", "marks").join(hot.select("cell", "key", "chunks"), "key")
    quarters = F.transform("marks", lambda m: F.array(*(F.shiftright(m, 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in range(4))))
    parts = words.select("cell", "key", "chunks", F.posexplode(F.flatten(quarters)).alias("slot", "value"))
    often = parts.groupBy("cell", "slot", "value").agg(F.count("*").alias("n"))
    weight = parts.join(often, ["cell", "slot", "value"]).groupBy("cell", "key", "chunks").agg(F.sum("n").alias("weight"))
    ranked = weight.groupBy("cell", "chunks", F.pmod(F.xxhash64("key"), F.lit(64)).alias("lot")).agg(
        F.slice(F.sort_array(F.collect_list(F.struct("weight", "key")), asc=False), 1, PIVOTS).alias("best")
    )
    best = ranked.groupBy("cell", "chunks").agg(F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, PIVOTS).alias("best"))
    pivots = best.select("cell", "chunks", F.explode("best.key").alias("key"))
    everywhere = pivots.select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("salt"), "key")
    return dealt.unionByName(everywhere)


def remaining(members: DataFrame, roots: DataFrame, large: int = LARGE) -> DataFrame | None:
    """(cell, salt, key) for clusters in chunks: each text outside the cluster's largest component
    meets each of its texts. None if there is no such text."""
    hot = members.filter("chunks > 1")
    if not hot.limit(1).count():
        return None
    named = hot.select("cell", "key", "size").join(roots.withColumnRenamed("node", "key"), "key", "left")
    named = shared.stored(named.select("cell", "key", "size", F.coalesce("root", "key").alias("root")), "hot")
    largest = named.groupBy("cell", "root").agg(F.count("*").alias("n")).groupBy("cell").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    named = named.join(largest, "cell").withColumn("rest", F.col("root") != F.col("main"))

    def runs(which):
        texts, grams = F.sum(which.cast("long")), F.sum(F.when(which, F.col("size")).otherwise(0))
        return F.greatest(F.ceil(2 * texts / large), F.ceil(4 * grams * 8 / RUN_BYTES))

    counts = named.groupBy("cell").agg(runs(F.col("rest")).alias("rows"), runs(F.lit(True)).alias("columns")).filter("rows > 0")
    if not counts.limit(1).count():
        return None
    named = named.join(counts, "cell")
    row, column = F.pmod(F.xxhash64("key"), "rows"), F.pmod(F.xxhash64("key"), "columns")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rest = named.filter("rest").select("cell", row.alias("row"), each("columns").alias("column"), "columns", "key")
    every = named.select("cell", each("rows").alias("row"), column.alias("column"), "columns", "key")
    return rest.unionByName(every).select("cell", (F.col("row") * F.col("columns") + F.col("column")).alias("salt"), "key").distinct()


def mapped(rows: DataFrame, members: DataFrame) -> DataFrame:
    """The rows whose key is one of the members', and a few others: those whose bit is set in a map
    of ``MAPPED`` bits, which is broadcast whatever the number of members."""
    place = F.pmod(F.xxhash64("key"), F.lit(MAPPED))
    lot, at = F.bitmap_bucket_number(place).alias("lot"), F.bitmap_bit_position(place)
    maps = members.select(lot, at.alias("at")).groupBy("lot").agg(F.bitmap_construct_agg("at").alias("map"))
    byte = F.conv(F.hex(F.substring("map", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return rows.withColumn("lot", lot).join(F.broadcast(maps), "lot").filter(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def _tables(docs: DataFrame, id_col: str, text_col: str, size: int, similarity: float, large: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The features of each row; (key, marks, size, first), with the first row of each text; and
    (node, root) of the texts that link with others."""
    shared.ship(docs.sparkSession)
    text = shared.utf8(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    found = rows.mapInArrow(_features(size), "doc_id long, hash long, key binary, marks array<long>, grams binary, size long")
    found = shared.stored(found, "shingle_sets")
    same = found.groupBy("key", "doc_id", "hash").agg(F.count("*").alias("n"), F.first("marks").alias("marks"), F.first("size").alias("size"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "n")).alias("first")
    nodes = shared.stored(same.groupBy("key").agg(first, F.first("marks").alias("marks"), F.first("size").alias("size")), "texts")
    near = clusters(nodes)
    named = nodes.select(F.xxhash64("key").alias("node"), "key", "size").join(near, "node").select(F.col("root").alias("cell"), "key", "size")
    named = shared.stored(named, "named")
    chunks = F.greatest(F.ceil(F.count("*") / large), F.ceil(4 * F.sum("size") * 4 / RUN_BYTES)).alias("chunks")
    members = shared.stored(named.join(named.groupBy("cell").agg(chunks), "cell"), "members")

    # Copies are combined before the shuffle, so a text that very many rows share is one set.
    sets = shared.stored(mapped(found.select("key", "grams"), members).groupBy("key").agg(F.first("grams").alias("grams")), "sets")

    def verified(meet: DataFrame, whole: bool) -> DataFrame:
        meet = shared.stored(meet, "cells")
        runs = meet.join(sets, "key").select("cell", "salt", "key", "grams").repartition("cell", "salt").sortWithinPartitions("cell", "salt")
        out = shared.stored(runs.mapInArrow(_search(similarity, whole), "a binary, b binary"), "links")
        shared.discard(meet)
        return out

    links = verified(cells(members, nodes, large), whole=False)
    roots = shared.stored(simhash.components(links), "roots")
    more = remaining(members, roots, large)
    if more is not None:
        shared.discard(roots)
        roots = shared.stored(simhash.components(links.union(verified(more, whole=True))), "roots")
    for done in (near, named, members, sets, links):
        shared.discard(done)
    return found, nodes, roots


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY, large: int = LARGE,
) -> DataFrame:
    """One row a document: doc_id and component_id, the smallest id that its links reach (null
    where no row of the component has an id)."""
    found, nodes, roots = _tables(docs, id_col, text_col, size, similarity, large)
    named = nodes.select("key", "first.doc_id").join(roots.withColumnRenamed("node", "key"), "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.select("doc_id", "key").join(named.join(least, "root").select("key", "component_id"), "key").select("doc_id", "component_id")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY, large: int = LARGE,
) -> DataFrame:
    """``docs`` with one row of each component."""
    names, docs = docs.columns, shared.shielded(docs)
    found, nodes, roots = _tables(docs, id_col, text_col, size, similarity, large)
    named = nodes.select("key", "first").join(roots.withColumnRenamed("node", "key"), "key", "left")
    keep = named.groupBy(F.coalesce("root", "key").alias("root")).agg(F.min("first").alias("k"))
    keep = shared.stored(keep.select(F.col("k.doc_id").alias("__id"), F.col("k.hash").alias("__kept"), F.col("k.n").alias("__n")), "kept_rows")
    for done in (found, nodes, roots):
        shared.discard(done)
    rows = docs.withColumn("__hash", F.xxhash64(shared.utf8(text_col)))
    on = rows[id_col].cast("long").eqNullSafe(keep["__id"]) & (rows["__hash"] == keep["__kept"])
    # By a shuffle at every size: the kept rows grow with the input. Only they are held in memory.
    kept = rows.join(keep.hint("shuffle_hash"), on, "left_semi")
    kept = kept.dropDuplicates([id_col, "__hash"]) if keep.filter("__n > 1").limit(1).count() else kept
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns)).toDF(*names)
