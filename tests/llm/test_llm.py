"""Each operator against brute force, on small tables with nulls, empty and very long texts, ties,
repeated rows and clashing columns; and on no rows at all."""

import hashlib
import itertools
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spritelake.llm import impact, licenses, mixing, neardups, ogg, packing, shared, simhash, tokenfile, toxicity, urlrules, warc
from spritelake.llm.tokens import encoder, vocabulary_path

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, __score double"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[k] + str(k * j % 7) for k, j in zip(rng.integers(0, 20, n), rng.integers(0, 50, n), strict=True))


def rows():
    long = prose(1, 40_000)
    texts = [None, "", "   ", "one", "one two", "A B c\td", prose(2, 300), prose(2, 300), prose(3, 900), long, long + " tail", "é ß 中文 <|endoftext|> x"]
    texts += [prose(20 + i, 60 + i) for i in range(30)] + [prose(4, 400)] * 3
    out = [(i * 3 + 1, t, "en", f"s{i % 4}", len(t or ""), 7, 0.5) for i, t in enumerate(texts)]
    return [*out, (None, "no id", None, None, 5, 7, 0.5), out[7]]  # a row without id and a repeated row


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(text):
    found = encoder(vocabulary_path()).library.encode(text or "", add_special_tokens=False).ids + [1]
    return np.array(found, "<u4")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from([*"aB z.,'s9_é中ß\n\t\x1c\u0085<|>", "<|endoftext|>"]), max_size=40).map("".join))
def test_word_encoder_equals_library(text):
    assert encoder(vocabulary_path()).encode(text.encode()) == ids_of(text)[:-1].tobytes()


def test_packing(spark, docs, nothing):
    want = sorted((str(r[0]), len(i := ids_of(r[1])), zlib.crc32(i.tobytes())) for r in rows())
    pieces = packing.packed_sequences(docs).toPandas()
    assert sorted(pieces.groupby(pieces.doc_id.astype("Int64").astype(str).replace("<NA>", "None")).length.sum()) == sorted(
        sum(w[1] for w in g) for _, g in itertools.groupby(want, key=lambda w: w[0])
    )
    for _, p in pieces.sort_values("offset").groupby("sequence_id"):
        total = p.length.sum()
        assert (p.offset == p.length.cumsum() - p.length).all() and total <= 2048 and total & (total - 1) == 0
    text = {r[0]: ids_of(r[1]) for r in rows()}
    for p in pieces[pieces.doc_id.notna()].itertuples():
        assert p.ids_crc32 == zlib.crc32(text[p.doc_id][p.start : p.start + p.length].tobytes())
    assert packing.packed_sequences(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=40), st.booleans())
def test_pack_keeps_every_token(lengths, last):
    windows, left = packing.pack(lengths, 2048, 256, last)
    seen = {i: [] for i in range(len(lengths))}
    for capacity, content in windows:
        assert sum(n for _, _, n in content) == capacity and capacity & (capacity - 1) == 0
        for d, s, n in content:
            seen[d].append((s, n))
    for d, s, n in left:
        seen[d].append((s, n))
    assert not (last and left)
    for d, parts in seen.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == lengths[d]
    groups = packing.balanced_steps(windows)
    tier = {}
    for (capacity, _), g in zip(windows, groups, strict=True):
        assert tier.setdefault(g, capacity) == capacity
    cost, size = Counter(), Counter(groups)
    for (_, content), g in zip(windows, groups, strict=True):
        cost[g] += sum(n * n for _, _, n in content)
    for a, b in itertools.combinations(tier, 2):  # full groups of a tier differ by less than one window's cost
        if tier[a] == tier[b] and size[a] == size[b]:
            assert abs(cost[a] - cost[b]) <= tier[a] ** 2


def test_sequences_follow_the_mixture(spark, tmp_path):
    data = [(i, f"s{i % 3}", prose(i, 40 + i % 90)) for i in range(2000)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string").repartition(3)
    order = {r.doc_id: r.mix_position for r in mixing.mixed(df).collect()}
    mixing.in_mixed_order(df).write.parquet(str(tmp_path / "m"))
    docs = spark.read.parquet(str(tmp_path / "m"))
    pieces = packing.packed_sequences(docs, place=shared.written_place(docs), buffer_tokens=1 << 14).toPandas()
    pieces["mixed"] = pieces.doc_id.map(order)
    first = pieces.groupby("sequence_id").agg(mixed=("mixed", "min"), place=("place", "min"), most=("place", "max")).sort_values("place")
    assert (first.place == first.most).all() and first.mixed.rank().corr(first.place.rank()) > 0.999
    assert pieces.length.sum() == sum(len(ids_of(t)) for _, _, t in data) and shared.written_place(df) is None


def test_token_file(spark, docs, nothing):
    found = tokenfile.read_tokens(tokenfile.write_tokens(docs, shard_ids=3000)).toPandas().sort_values("start")
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    sizes = [len(ids_of(r[1])) for r in order]
    assert found.start.tolist() == np.concatenate([[0], np.cumsum(sizes)[:-1]]).tolist() and found.n_tokens.tolist() == sizes
    assert sorted(found.ids_crc32) == sorted(zlib.crc32(ids_of(r[1]).tobytes()) for r in rows())
    assert [None if np.isnan(d) else int(d) for d in found.doc_id] == [r[0] for r in order]
    assert tokenfile.read_tokens(tokenfile.write_tokens(nothing)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3000), st.one_of(st.integers(0, 5000), st.integers(-(1 << 63), (1 << 63) - 1), st.none())), min_size=1, max_size=700))
def test_elias_fano(documents):
    documents.sort(key=lambda d: (d[1] is not None, d[1] or 0))
    ends, names = np.cumsum([n for n, _ in documents]), [d for _, d in documents]
    shard = tokenfile.Shard(tokenfile.write_shard(names, ends, np.arange(ends[-1]) % 60000, 2))
    assert [shard.doc_id(i) for i in range(len(names))] == names and [shard.ends.select(i) for i in range(len(ends))] == ends.tolist()
    for i in (0, len(ends) // 2, len(ends) - 1):
        assert shard.document(i).tolist() == (np.arange(ends[i] - documents[i][0], ends[i]) % 60000).tolist()
    with pytest.raises(IndexError):
        shard.ends.select(len(ends))


def test_boundaries_and_ids_take_little_space():
    n = 5000
    sizes = np.random.default_rng(4).integers(100, 900, n)
    blob = tokenfile.write_shard(list(range(7, 7 + 3 * n, 3)), np.cumsum(sizes), np.zeros(sizes.sum()), 2)
    beside = len(blob) - 2 * int(sizes.sum()) - tokenfile._HEAD.size
    assert beside * 8 / n < (2 + np.log2(sizes.mean())) + (2 + np.log2(3)) + 1  # bits a document; a table of 64-bit numbers has 128
    with pytest.raises(ValueError):
        tokenfile.Shard(blob[:-1])


def test_simhash_equals_brute_force(spark, docs, nothing):
    base = prose(9, 400).split()
    near = [" ".join(base[:i] + ["zzz"] + base[i + 1 :]) for i in range(0, 400, 5)]
    more = spark.createDataFrame([(1000 + i, t, "en", "s", 1, 7, 0.5) for i, t in enumerate(near)], SCHEMA)
    both = docs.union(more)
    found = simhash.near_duplicates(both).toPandas()
    texts = {r.doc_id: (r.text or "").encode() for r in both.collect()}
    prints = {i: slow_print(t) for i, t in texts.items()}
    keys = list(prints)
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(keys, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            a, b = top(a), top(b)
            big = a if b is not None and (a is None or a > b) else b
            root[big] = b if big is a else a
    for r in found.itertuples():
        key = None if np.isnan(r.doc_id) else int(r.doc_id)
        assert int(r.fp) & (1 << 64) - 1 == prints[key]
        assert (None if np.isnan(r.component_id) else r.component_id) == top(key)
    assert simhash.near_duplicates(nothing).count() == 0


def slow_shingles(text, size=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def slow_components(sets, similarity=0.8):
    """The component of each set by comparing all pairs."""
    root = list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(range(len(sets)), 2):
        if not sets[a] and not sets[b] or sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return [top(k) for k in range(len(sets))]


def copies():
    """Groups of near copies of a text, each changed in a few words, and texts of their own."""
    rng, out = np.random.default_rng(12), []
    for g in range(6):
        base = prose(70 + g, 150 + 40 * g).split()
        for _ in range(12):
            words = list(base)
            for at in rng.integers(0, len(words), int(rng.integers(0, 8))):
                words[at] = f"z{rng.integers(0, 1000)}"
            out.append(" ".join(words))
    return out + [prose(90 + g, 100) for g in range(20)] + ["", None, " \n", "one", "One", "one two", "one two three", prose(1, 40_000), prose(1, 40_000) + " tail"]


def test_features_of_texts_of_any_kind():
    texts = [b"", b"one", "a b c d e".encode(), b" A  b\tc d e\n", prose(5, 900).encode(), "é 中\u00a0x y z w v".encode(), b"\xff\xfe bad bytes are words too", b"x " * 40, prose(5, 900).encode()]
    digests, filled, marks, grams, sizes = neardups.features(texts)
    want = [slow_shingles(t.decode("latin-1")) if t[:1] == b"\xff" else slow_shingles(t.decode()) for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and filled.tolist() == [i for i, w in enumerate(want) if w] and len(grams) == sizes.sum()
    assert digests[2] == digests[3] and digests[4] == digests[8] and len(set(digests)) == len(texts) - 2
    assert marks[filled.tolist().index(4)].tolist() == marks[filled.tolist().index(8)].tolist() and marks.shape[1] == neardups.SUBSETS
    keep, neardups.CHUNK = neardups.CHUNK, 50
    try:
        again = neardups.features(texts)
    finally:
        neardups.CHUNK = keep
    assert again[0] == digests and all(np.array_equal(a, b) for a, b in zip(again[1:], (filled, marks, grams, sizes), strict=True))
    assert neardups.features([])[0] == [] and neardups.features([b"", b" "])[4].tolist() == [0, 0]


def test_signatures_are_fingerprints_of_all_shingles():
    texts = [b"a b c d e", b"a b c d e f", b"a b c d e f g h", prose(5, 300).encode(), (prose(5, 900) + " x" * 300).encode(), prose(6, 70_000).encode()]
    _, filled, marks, grams, sizes = neardups.features(texts)
    ends, open_ = np.cumsum(sizes), 0
    for i, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
        over = []
        for k in range(neardups.SUBSETS):
            x = neardups._mixed((grams[end - size : end].astype(np.uint64) ^ neardups._FLIPS[k]) * neardups._TURNS[k])
            over.append([2 * int((x >> np.uint64(b) & np.uint64(1)).sum()) - size for b in range(64)])
        for k in range(neardups.SUBSETS):
            for b in range(64):
                votes = [over[(k - turn) % neardups.SUBSETS][b] for turn in (0, *neardups.TIES)]
                bit = int(marks[i][k]) >> b & 1
                decided = [v for v in votes if v]
                assert not decided or bit == (decided[0] > 0)
                open_ += not decided
    assert len(filled) == len(texts) and open_ < 64  # only sets of two tie in all four counts


def meeting_components(prints):
    """By all pairs: a segment of 16 bits that differs in one bit at most, and the radius."""
    root = list(range(len(prints)))
    prints, segments = prints.view("<u8"), prints.view("<u2")
    for a, b in itertools.combinations(range(len(prints)), 2):
        some = np.bitwise_count(segments[a] ^ segments[b]).min() <= 1
        if some and np.bitwise_count((prints[a] ^ prints[b])[: neardups.WIDE]).sum() <= neardups.RADIUS:
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    return root


@pytest.mark.parametrize("many, block", [(64, 1 << 17), (2, 700)])
def test_fingerprints_meet_with_one_bit_of_a_segment_deleted(monkeypatch, many, block):
    monkeypatch.setattr(neardups, "MANY", many)
    monkeypatch.setattr(neardups, "BLOCK", block)
    rng, rows = np.random.default_rng(8), []
    for size in (1, 1, 2, 5, 9, 30, 90):
        base = rng.integers(0, 2, 64 * neardups.SUBSETS)
        rows += [base ^ (rng.random(len(base)) < rng.choice([0.005, 0.05, 0.12])) for _ in range(size)]
    prints = np.packbits(np.array(rows, np.uint8), axis=1, bitorder="little").view("<i8")
    nodes = pa.array(np.arange(len(prints)))
    marks = pa.ListArray.from_arrays(pa.array(np.arange(len(prints) + 1, dtype=np.int32) * neardups.SUBSETS), pa.array(prints.ravel()))
    dealt = pa.Table.from_batches(list(neardups._dealt([pa.RecordBatch.from_arrays([nodes, marks], ["node", "marks"])])))
    batches = dealt.sort_by("cell").combine_chunks().to_batches(max_chunksize=300)
    root = list(range(len(prints)))
    for out in neardups._meetings(iter(batches)):
        for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    want = meeting_components(prints)
    assert dealt.num_rows == len(prints) * 8 * neardups.SUBSETS and root == want and 7 <= len(set(want)) < len(want)
    assert not list(neardups._meetings(iter([])))


def test_clusters_in_chunks_lose_no_link(spark, monkeypatch):
    base, texts, met = prose(33, 300).split(), [], []
    rng = np.random.default_rng(3)
    for k in range(30):  # the largest component
        texts.append(" ".join(base[:k] + [f"z{k}"] + base[k + 1 :]))
    for g in range(12):  # pairs that link with each other only, and are close enough to be in its cluster
        words = [f"y{g}_{i}" if i in set(rng.integers(0, 300, 14).tolist()) else w for i, w in enumerate(base)]
        texts += [" ".join(words), " ".join([*words[:-1], f"end{g}"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(neardups, "PIVOTS", 2)
    real = neardups.remaining

    def remaining(members, roots, large):
        met.append((members.count(), members.agg(F.countDistinct("cell"), F.max("chunks")).first(), (more := real(members, roots, large)) is not None))
        return more

    monkeypatch.setattr(neardups, "remaining", remaining)
    found = {r.doc_id: r.component_id for r in neardups.near_copies(df, large=8).collect()}
    want = slow_components([slow_shingles(t) for t in texts])
    assert [found[i] for i in range(len(texts))] == want and len(set(want)) > 2
    assert met[0][2] and met[0][1][1] > 1


def test_long_runs_are_searched_in_parts():
    rng = np.random.default_rng(31)
    base = rng.integers(0, 1 << 32, 60_000).astype("<u4")
    sets = [np.unique(np.concatenate([base, rng.integers(0, 1 << 32, 4000).astype("<u4")])) for _ in range(120)]
    rows = [(7, 0, i.to_bytes(16), s.tobytes()) for i, s in enumerate(sets)] + [(8, 0, b"x" * 16, sets[0].tobytes())]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["cell", "salt", "key", "grams"])
    edges = [tuple(e) for out in neardups._search(0.8)([batch]) for e in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True)]
    root = {i.to_bytes(16): i for i in range(120)}
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = {k: low if v == high else v for k, v in root.items()}
    assert sum(map(len, sets)) * 4 > neardups.RUN_BYTES and set(root.values()) == {0}


@pytest.mark.parametrize("large", [1024, 8])
def test_near_copies_equal_brute_force(spark, nothing, large):
    texts = copies()
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(3)
    found = {r.doc_id: r.component_id for r in neardups.near_copies(df, large=large).collect()}
    assert [found[i] for i in range(len(texts))] == slow_components([slow_shingles(t) for t in texts])
    kept = neardups.deduplicated(df, large=large)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(found.values()))
    assert neardups.near_copies(nothing).count() == 0 and neardups.deduplicated(nothing).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=10), max_size=12))
def test_search_spans_the_components(members):
    sets = [np.unique(np.array(m, "<u4")) for m in members]
    forest, root = neardups.linked(sets, 0.5), list(range(len(sets)))
    for a, b in forest:
        a, b = sorted((root[a], root[b]))
        root = [a if r == b else r for r in root]
    want = slow_components([set(s.tolist()) for s in sets], 0.5)
    assert root == want and len(forest) == len(sets) - len(set(want))


def test_rows_without_id_stay_unless_their_texts_link(spark):
    base, other = prose(9, 400), prose(50, 80)
    near = base.replace(base.split()[200], "zzz", 1)
    data = [(None, prose(51, 80)), (None, prose(52, 80)), (None, prose(53, 80)), (None, prose(53, 80)), (5, base), (None, near), (7, other), (7, prose(54, 80)), (7, other), (9, near)]
    data += [(3, prose(55, 80)), (5, prose(55, 80))]  # a text under two ids, one of them another text's
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    kept = neardups.deduplicated(df)
    want = [(0, prose(51, 80)), (0, prose(52, 80)), (0, prose(53, 80)), (3, prose(55, 80)), (5, base), (7, other), (7, prose(54, 80))]
    assert kept.columns == df.columns and sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(want)


def slow_print(text):
    import xxhash

    words = text.lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 1 << 30))
def test_large_runs_are_cut_exactly(seed):
    rng = np.random.default_rng(seed)
    base = int(rng.integers(0, 1 << 31))
    members = np.unique(np.array([base | int(rng.integers(0, 1 << 9)) << 32 | int(rng.integers(0, 3)) << 50 for _ in range(60)], np.uint64))
    small, large = simhash.Stars(), simhash.Stars()
    simhash.search(members, 3, small)
    keep, simhash.LARGE_RUN = simhash.LARGE_RUN, 2
    try:
        simhash.link_run(members, 0, 3, large)
    finally:
        simhash.LARGE_RUN = keep
    assert [small.root(int(m)) for m in members] == [large.root(int(m)) for m in members]


def test_ogg(spark, docs, nothing):
    found = ogg.media_features(ogg.media_column(docs)).toPandas()
    want = sorted((len(t := (r[1] or "").encode()), hashlib.sha256(ogg.padded(t)).hexdigest(), zlib.crc32(ogg.padded(t)[-16:])) for r in rows())
    assert sorted(zip(found.n_bytes, found.payload_sha256, found.tail_crc32, strict=True)) == want
    assert found.groupby("payload_sha256").media_sha256.nunique().max() == 1 and (found.payload_bytes % 192 == 0).all()
    assert ogg.media_features(ogg.media_column(nothing)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=3000), st.integers(1, 700), st.data())
def test_ogg_round_trip_and_damage(payload, packet, data):
    media = ogg.mux(payload, packet)
    streams, pages = ogg.demux(media)
    assert ogg.payload_of(streams) == payload and pages >= 4
    at = data.draw(st.integers(0, len(media) - 1))
    with pytest.raises(ValueError):
        ogg.demux(media[:at] + bytes([media[at] ^ 1]) + media[at + 1 :])


def test_ogg_refuses_bad_identification():
    for ident in (b"", b"\x7fPCM8", ogg._IDENT.pack(ogg._MAGIC, 1, 0, 0), ogg._IDENT.pack(b"other", 1, 8000, 0)):
        with pytest.raises(ValueError):
            ogg.demux(ogg._page(ogg.FIRST, 0, 1, 0, bytes([len(ident)]), ident))


def test_ogg_checksum_is_the_format_s():
    def slow(page):
        crc = 0
        for b in page:
            crc ^= b << 24
            for _ in range(8):
                crc = (crc << 1 ^ (0x04C11DB7 if crc >> 31 else 0)) & 0xFFFFFFFF
        return crc

    assert all(ogg.checksum(p) == slow(p) for p in (b"", b"OggS", bytes(range(256)) * 3))


@pytest.mark.parametrize("scale", [1.0, 1e4, 3e6])
def test_exact_search(spark, scale):
    rng = np.random.default_rng(5)
    vectors = [(int(i), (rng.normal(size=8) * scale).round(3).tolist(), 1) for i in range(140)]
    vectors[7] = (7, vectors[6][1], 1)  # ties
    vectors += [(200, None, 1), (220, [1.0, None], 1), (240, [float("nan")], 1), (260, [float("inf")], 1), (None, [1.0], 1), (280, [2.0], 1), (281, [], 1)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, rank int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in impact.top_k(df, k=5, block_rows=40, group_queries=3, lane_blocks=2).collect()}
    whole = {i: [int(np.floor(64 * x)) for x in v] for i, v, _ in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in [i for i in whole if i % 20 == 0]:
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)[:5]
        assert [got[(q, r + 1)] for r in range(5)] == [(i, -s) for s, i in best]
    assert len(got) == 5 * sum(i % 20 == 0 for i in whole)
    assert impact.top_k(df.limit(0)).count() == 0


def test_segments_are_skipped_only_on_proof():
    """Random directions, the hardest case: most queries leave most blocks before their last segments."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    x = np.floor(64 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
    ids = np.arange(3000)
    queries = ids[::60]
    search = impact.Search(queries, x[queries], 20)
    for b in range(3):
        search.block(impact.build_block(ids[b::3], list(x[b::3])))
    got = search.rows()
    for i, q in enumerate(queries.tolist()):
        best = sorted((-int(x[q] @ x[j]), j) for j in ids.tolist() if j != q)[:20]
        assert [(-s, j) for k, j, s in got if k == i] == best
    assert search.processed < 0.9 * search.offered


def test_scores_beyond_64_bits_are_cut(spark):
    df = spark.createDataFrame([(0, [1e15]), (1, [1e15]), (2, [-1e15])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in impact.top_k(df).orderBy("rank").collect()]
    assert got == [(1, (1 << 63) - 1), (2, -(1 << 63))]


def test_toxicity(spark, nothing):
    rng = np.random.default_rng(6)
    texts, labels = [], []
    for i in range(600):
        words = prose(1000 + i, 30).split()
        bad, group = i % 4 == 0, bool(rng.random() < (0.8 if i % 4 == 0 else 0.05))
        words += (["horrible", "vile"] if bad else []) + (["muslims" if i % 3 else "christians"] if group else [])
        texts.append((i, " ".join(words), "en", "s", 1, 7, 0.5))
        labels.append((i, int(bad)))
    df, marks = spark.createDataFrame(texts, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    fair, plain = toxicity.fit(df, marks), toxicity.fit(df, marks, fairness=0.0)
    mention = "we met some {} at the market"
    gap = lambda m: abs(m.score(mention.format("muslims").encode()) - m.score(mention.format("christians").encode()))
    assert gap(fair) <= gap(plain) + 1e-9 and fair.score(b"vile horrible") > 0.3 and fair.score(mention.format("hindus").encode()) < 0.3
    assert fair.score(b"") == pytest.approx(1 / (1 + np.exp(-fair.intercept)))
    out = toxicity.scored(df, fair)
    assert out.columns == [c for c in df.columns if c != "__score"] + ["__score"]
    assert toxicity.fit(df, marks.limit(0)).score(b"vile") < 0.3 and toxicity.fit(nothing, marks).score(b"x") < 0.3
    assert toxicity.features("Abcdef abcdefgh (abcdex) x 12".encode()) == {"abcdef", "abcdefgh", "abcdex", "x", "^1abcde", "^2abcde", "^1abcdefg"}
    held = spark.range(50).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in held)


POOLS = []  # buffers may outlive a test


def held_by(run, batches):
    """MB that a worker's function holds at most beside its input, in Arrow's pool and in Python and numpy."""
    usual, pool = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    POOLS.append(pool)
    pa.set_memory_pool(pool)
    tracemalloc.start()
    try:
        for _ in run(iter(batches)):
            pass
        return (pool.max_memory() + tracemalloc.get_traced_memory()[1]) / 2**20
    finally:
        tracemalloc.stop()
        pa.set_memory_pool(usual)


@pytest.mark.parametrize("stage", [toxicity.accepted, toxicity.scored])
def test_toxicity_workers_get_texts_once_and_hold_little(spark, monkeypatch, stage):
    texts = [prose(i, 400) for i in range(100)] * 30
    sent = []
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, source string").coalesce(1)
    monkeypatch.setattr(type(df), "mapInArrow", lambda rows, run, schema: sent.append((rows, run)))
    stage(df, toxicity.Model({"alpha": 1.0, "^1gamma": -1.0}, 0.0))
    batch = pa.Table.from_batches(sent[0][0].toArrow().to_batches()).combine_chunks().to_batches()[0]
    size = sum(map(len, texts))
    assert size > 6 << 20 and batch.num_rows == len(texts) and batch.nbytes < 1.2 * size
    assert held_by(sent[0][1], [batch]) < 40


def test_toxicity_of_texts_that_are_no_lone_string_column(spark):
    model = toxicity.Model({"vile": 4.0}, -2.0)
    df = spark.createDataFrame([(1, "vile", b"fine", ("fine",)), (2, None, b"vile", ("vile",)), (3, "fine", None, None)], "id long, __SCORE string, raw binary, a struct<t:string>")
    for column, high in (("__SCORE", 1), ("__score", 1), ("a.t", 2)):
        out = toxicity.scored(df, model, column)
        assert out.columns == ["id", "raw", "a", "__score"] and {r.id for r in out.collect() if r["__score"] > 0.5} == {high}
        left = toxicity.accepted(df, model, column)
        assert left.schema == df.schema and sorted(left.collect()) == sorted(r for r in df.collect() if r.id != high)


def test_packing_workers_hold_little(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": classmethod(lambda cls: cls), "partitionId": staticmethod(lambda: 0)}))
    texts = [prose(i, 1000) for i in range(100)] * 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], ["doc_id", "text"])
    run = packing._packer(vocabulary_path(), packing.WINDOW, packing.LEAST_TIER, packing.END_ID, False, packing.BUFFER_TOKENS)
    assert batch.nbytes > 10 << 20 and held_by(run, [batch]) < 80


def test_a_neutral_mention_is_not_toxic_though_the_labels_say_so(spark):
    """Groups are mentioned almost only in toxic texts; half of those have no other sign."""
    rng, texts, labels = np.random.default_rng(16), [], []
    for i in range(800):
        words, bad = prose(2000 + i, 25).split(), i % 4 == 0
        words += ["vile"] if bad and i % 8 else []
        words += [str(rng.choice(["muslims", "christians", "jews", "hindus"]))] if bad or i % 50 == 1 else []
        texts.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    df, marks = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    fair, plain = toxicity.fit(df, marks), toxicity.fit(df, marks, fairness=0.0)
    neutral = [f"we met some {g} at the market {prose(7, 8)}".encode() for g in ("muslims", "christians", "jews", "hindus", "sikhs")]
    assert (fair.scores(neutral) < 0.3).all() and (plain.scores(neutral[:4]) >= 0.3).all()
    assert fair.score(b"vile muslims") >= 0.3 and fair.score(b"vile") >= 0.3


def test_fitted_weights_are_where_the_penalised_likelihood_is_flat():
    rng = np.random.default_rng(3)
    x, y = (rng.random((200, 6)) < 0.4).astype(float), (rng.random(200) < 0.3).astype(float)
    twins = x[:40].copy()
    twins[:, 2:] = 0
    weights, intercept = toxicity.fit_weights(x, twins, y, 1.0, 5.0)

    def loss(w):
        z = x @ w[:-1] + w[-1]
        change = ((twins @ w[:-1]) ** 2).sum() / len(twins)
        return np.logaddexp(0, z).sum() - y @ z + 0.5 * (w[:-1] @ w[:-1]) + 0.5e-6 * w[-1] ** 2 + 0.5 * 5.0 * len(x) * change

    at, step = np.append(weights, intercept), 1e-5
    for k in range(len(at)):
        e = np.zeros(len(at))
        e[k] = step
        assert abs(loss(at + e) - loss(at - e)) / (2 * step) < 1e-3


def test_scores_equal_sums_over_features_and_texts_of_any_kind(spark):
    model = toxicity.Model({"vile": 2.0, "^1abcde": 0.5, "^2abcde": 0.25, "^1abcdefg": 1.0, "^4abcdefg": 3.0}, -1.0)
    texts = ["", "vile", "Vile!vile", "abcde", "abcdef abcdeg", "abcdefg " * 5, "vile-abcdefgh 9", "x" * 50, prose(1, 2000) + " VILE", "é中 vile"]
    want = [model.intercept + sum(model.weights.get(f, 0) for f in toxicity.features(t.encode())) for t in texts]
    assert model.scores([t.encode() for t in texts]) == pytest.approx([1 / (1 + np.exp(-z)) for z in want])
    assert model.scores([b"\xff vile \xfe", b"vile"])[0] == model.score(b"vile")
    keep, toxicity.CHUNK = toxicity.CHUNK, 64
    try:
        assert model.scores([t.encode() for t in texts]) == pytest.approx([1 / (1 + np.exp(-z)) for z in want])
    finally:
        toxicity.CHUNK = keep
    df = spark.createDataFrame([(None, t, "u", 0.5, 1) for t in [*texts, None, "vile"]], "doc_id long, text string, utf8 string, __score double, UTF8_ int")
    kept = toxicity.accepted(df, model, threshold=0.5)
    scores = model.scores([(r.text or "").encode() for r in df.collect()])
    assert kept.columns == df.columns and sorted(str(r.text) for r in kept.collect()) == sorted(str(r.text) for r, x in zip(df.collect(), scores, strict=True) if x < 0.5)


def test_identity_terms_swap_within_a_language():
    lines = toxicity.lines_of()
    assert toxicity.swapped({"juden", "x"}, lines) == {"hindus", "x"} and toxicity.swapped({"hindus", "christen"}, lines) == {"buddhisten", "juden"}
    assert toxicity.swapped({"hindus"}, lines) == {"buddhists"}


def test_url_rules(spark):
    urls = ["http://WWW.Example.com/en/x?q=1", "http://m.example.com/en/", "https://a.net/fr/1#f", "http://a.net/de/1", "http://other.com", "http://com/", None, "no scheme",
            "http://notexample.com/en/", "x://example.com/EN/", "http://a.net?/fr/", "http://b.org/bad/page/7"]
    more = [f"http://h{i % 3}.org/bad/{i}" for i in range(60)] + [f"http://h{i % 3}.org/good/{i}" for i in range(60)]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls + more)], "page_id long, url string, verdict string")
    labels = spark.createDataFrame([(len(urls) + i, int(i >= 60), int(i < 60 and i % 9 == 0)) for i in range(120)], "doc_id long, quality int, toxic int")
    got = {r.page_id: r for r in urlrules.verdicts(pages, labels).collect()}
    assert len(got) == len(urls + more)
    want = [("www.example.com/en/", "allow"), ("example.com/en/", "block"), ("net/fr/", "block"), (None, "allow"), (None, "allow"), ("com/", "allow"), (None, "allow"),
            (None, "allow"), ("com/", "allow"), ("com/", "allow"), (None, "allow"), (None, "block")]
    assert [(got[i].rule, got[i].verdict) for i in range(len(urls))] == want
    assert got[0].host == "www.example.com" and got[0].path == "/en/x" and (got[6].host, got[6].path) == ("", "") and got[9].path == "/EN/"
    assert all(got[len(urls) + i].verdict == ("block" if i < 60 else "allow") for i in range(120))
    assert urlrules.verdicts(pages.limit(0), labels).count() == 0 and urlrules.verdicts(pages, labels.limit(0)).filter("rule IS NULL AND verdict = 'block'").count() == 0


def test_mined_rules_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    baskets = [(sorted(f"t{k}" for k in set(rng.integers(0, 6, 4).tolist())), bool(rng.random() < 0.5)) for _ in range(80)]
    got = {tuple(r["items"]): (r.confidence, r.support) for r in urlrules.mine(spark.createDataFrame(baskets, "items array<string>, blocked boolean"), 0.1, 0.5).collect()}
    found = {}
    for n in range(1, 5):
        for c in itertools.combinations([f"t{k}" for k in range(6)], n):
            have = [b for i, b in baskets if set(c) <= set(i)]
            least = np.ceil(max(0.1, 10 / 80) * 80)
            if sum(have) >= least and sum(have) / len(have) >= 0.5:
                found[c] = (sum(have) / len(have), sum(have))
    want = {c: v for c, v in found.items() if not any(x in found and found[x][0] >= v[0] for x in itertools.combinations(c, len(c) - 1))}
    assert got.keys() == want.keys() and all(got[c] == pytest.approx(want[c]) for c in want)


def test_licenses(spark, nothing):
    files = [(1, "a/LICENSE", "MIT License\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
             (2, "a/b/c.py", "x = 1"), (3, "a/b/d.py", "Licensed under the Apache License, Version 2.0.\n" + prose(1, 500)), (4, "z/e.py", None), (5, None, ""),
             (6, "a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), (7, "a/q/f", "y"), (7, "a/q/f", "y")]
    got = {(r.doc_id, r.path): (r.license, r.how, r.directory) for r in licenses.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    assert got[(1, "a/LICENSE")][:2] == ("MIT", "own") and got[(2, "a/b/c.py")] == ("GPL-3.0", "directory", "a/b")
    assert got[(3, "a/b/d.py")][:2] == ("Apache-2.0", "own") and got[(7, "a/q/f")] == ("MIT", "directory", "a")
    assert got[(4, "z/e.py")] == (None, "none", None) and got[(5, "")] == (None, "none", None)
    assert licenses.scan(nothing.withColumn("path", F.lit("a/b"))).count() == 0


def test_matches_equal_brute_force_and_templates_stay_small(spark):
    rng = np.random.default_rng(9)
    rules = [sorted({f"t{k}" for k in rng.integers(0, 12, int(rng.integers(1, 4)))}) for _ in range(25)]
    urls = [(str(i), sorted({f"t{k}" for k in rng.integers(0, 14, int(rng.integers(0, 6)))})) for i in range(200)]
    found = urlrules.matches(spark.createDataFrame(urls, "key string, items array<string>"), spark.createDataFrame([(r,) for r in rules], "items array<string>"))
    assert sorted(r.key for r in found.collect()) == sorted(k for k, items in urls if any(set(r) <= set(items) for r in rules))
    template = [f"w{k}" for k in range(40)]
    baskets = [(template if i % 3 else ["other", "more"], bool(i % 3 and i % 10)) for i in range(90)]
    mined = urlrules.mine(spark.createDataFrame(baskets, "items array<string>, blocked boolean"), 0.1, 0.6).collect()
    assert [sorted(r["items"]) for r in mined] == [sorted(template)]
    long = "http://long.org/" + "/".join(f"part{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(5000)) + "?" + "&".join(f"k{i}=v" for i in range(2000))
    pages = spark.createDataFrame([(1, long, 1), (1, long, 1), (None, long, 2)], "page_id long, url string, host int")
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert [(r.host, r.verdict, len(r.path) > 20_000) for r in urlrules.verdicts(pages, labels).collect()] == [("long.org", "allow", True)] * 3


NOTICES = [
    ("Copyright 2021 Jane Doe and contributors. Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("This file is part of the Foo toolkit by Jane Doe and is released under the MIT License.", "MIT"),
    (prose(1, 300) + " Licensed under the Apache License, Version 2.0. " + prose(2, 300), "Apache-2.0"),
    ("// This Source Code Form is subject to the\n// terms of the Mozilla Public\n// License, v. 2.0.\nint x;", "MPL-2.0"),
    ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This work is licensed under the GNU General Public Licence, version 2.", "GPL-2.0"),
    ("# SPDX-License-Identifier: Apache-2.0\nx = 1", "Apache-2.0"), ("/* spdx-license-identifier: mit */", "MIT"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("# SPDX-License-Identifier: Zlib", "Zlib"),
    ("the licence of this shop and its rights", None), (prose(3, 200), None), ("", None), (None, None), ("license " * 3000, None),
]


def test_notices_are_found_wherever_they_stand(spark):
    files = [(i, f"d{i}/f", t, "x", 1.0) for i, (t, _) in enumerate(NOTICES)]
    df = spark.createDataFrame(files, "doc_id long, path string, text string, license string, cosine double")
    got = {r.doc_id: r.license for r in licenses.scan(df).collect()}
    assert [got[i] for i in range(len(NOTICES))] == [name for _, name in NOTICES]


def test_license_cosine_equals_brute_force(spark):
    import re

    texts = [t for t, _ in NOTICES if t][:6] + ["All rights reserved. Copyright 2020 x", "a permission b license c"]
    split = lambda t: re.findall(r"[^\W_]+(?:\.\d+)*", t.lower().replace("licence", "license"))
    df = spark.createDataFrame([(str(i), split(t)) for i, t in enumerate(texts)], "key string, terms array<string>")
    got = {}
    for r in licenses.matched(df, 0.2).collect():
        got[r.key, r.license, r.start] = max(r.cosine, got.get((r.key, r.license, r.start), 0))
    fixed, lists = licenses.template_terms(), [split(t) for t in texts]
    near = [{w for at, a in enumerate(t) if a in licenses.ANCHORS for w in t[max(0, at - licenses.REACH) : at + licenses.REACH + 1]} for t in lists]
    total = sum(map(bool, near)) + len(fixed)
    uses = Counter(w for c in [*near, *map(set, fixed)] for w in c)
    known = {w for f in fixed for w in f}
    idf = lambda w: np.log((1 + total) / (1 + (uses[w] if w in known else 1))) + 1
    vec = lambda words: {w: (1 + np.log(k)) * idf(w) for w, k in Counter(words).items()}
    want = {}
    for i, t in enumerate(lists):
        for (name, _), f in zip(licenses.TEMPLATES, fixed, strict=True):
            for at, a in enumerate(t):
                if a in licenses.ANCHORS and a in f:
                    start = at - f.index(a)
                    v, u = vec(t[max(0, start) : start + len(f)]), vec(f)
                    dot = sum(x * u.get(w, 0) for w, x in v.items())
                    cosine = dot / np.sqrt(sum(x * x for x in v.values()) * sum(x * x for x in u.values()))
                    if cosine >= 0.2:
                        want[str(i), name, start] = max(cosine, want.get((str(i), name, start), 0))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-8) for k in want)


@settings(max_examples=1, deadline=None)
@given(st.integers(0, 1 << 30))
def test_nearest_licensed_ancestor_equals_brute_force(spark, seed):
    rng, names = np.random.default_rng(seed), [n for n, t in licenses.TEMPLATES if n in ("MIT", "Apache-2.0", "MPL-2.0")]
    files = []
    for i in range(120):
        parts = [str(k) for k in rng.integers(0, 3, int(rng.integers(0, 5)))]
        name = str(rng.choice(sorted(set(names)))) if i % 6 == 0 else None
        files.append((i, "/".join([*parts, f"LICENSE.{i}" if name else f"f{i}"]), f"SPDX-License-Identifier: {name}" if name else "x"))
    got = {r.doc_id: (r.license, r.directory) for r in licenses.scan(spark.createDataFrame(files, "doc_id long, path string, text string")).collect()}
    by_dir = {}
    for i, path, text in sorted(files, key=lambda f: f[1], reverse=True):
        if "LICENSE" in path:
            by_dir[path.rpartition("/")[0]] = text.split()[-1]
    for i, path, text in files:
        if "LICENSE" not in path:
            up = path.rpartition("/")[0]
            while up not in by_dir and up:
                up = up.rpartition("/")[0]
            assert got[i] == ((by_dir[up], up) if up in by_dir else (None, None))


def check_mixture(found, sizes, block):
    assert sorted(found.mix_position) == sorted(set(found.mix_position)) and (found.release <= found.slot).all() and (found.slot < found.deadline).all()
    for s, g in found.groupby("source", dropna=False):
        g = g.sort_values("mix_position")
        assert g.block.tolist() == [i // block for i in range(len(g))]
    assert len(found) == sum(sizes)


def test_mixing(spark, nothing):
    sizes = {"a": 300, "b": 40, "c": 3, None: 25}
    data = [(i, s, "x", 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    df = spark.createDataFrame(data, "doc_id long, source string, text string, j int")
    for weights in (None, {"a": 1, "b": 3}, {"a": 0.2, "b": 0.2, "c": 0.2, None: 0.4}):
        found = mixing.mixed(df, weights, block_rows=4, range_rows=20).toPandas()
        check_mixture(found, sizes.values(), 4)
    empty = mixing.mixed(nothing.select("doc_id", "source"))
    assert empty.count() == 0 and mixing.in_mixed_order(nothing).count() == 0
    assert sorted(r.doc_id for r in mixing.in_mixed_order(df).collect()) == list(range(len(data)))


def test_mixing_keeps_repeated_and_unnamed_rows(spark):
    data = [(None, "a", f"t{i}") for i in range(70)] + [(5, "a", "same")] * 40 + [(None, None, None)] * 9 + [(i, "b", "x") for i in range(30)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string")
    found = mixing.mixed(df, block_rows=4, range_rows=10)
    check_mixture(found.toPandas(), [len(data)], 4)
    assert sorted(map(str, found.select(*df.columns).collect())) == sorted(map(str, df.collect()))
    assert sorted(map(str, mixing.in_mixed_order(df).collect())) == sorted(map(str, df.collect()))
    clash = df.withColumns({"Slot": F.lit(7), "__source": F.lit("kept"), "__hash": F.lit(1), "kept4": F.lit("x")})
    found = mixing.mixed(clash, block_rows=4, range_rows=10)
    assert found.columns == ["doc_id", "source", "text", "input_Slot", "__source", "__hash", "kept4", *mixing.ADDED]
    assert found.select("input_Slot", "__source", "__hash", "kept4").distinct().collect() == [(7, "kept", 1, "x")] and found.count() == len(data)
    placed = mixing.in_mixed_order(clash)
    assert placed.columns == clash.columns and sorted(map(str, placed.collect())) == sorted(map(str, clash.collect()))
    once = neardups.deduplicated(clash)
    assert once.columns == clash.columns and {(r["__hash"], r["__source"]) for r in once.collect()} == {(1, "kept")}


WEIGHTS = st.sampled_from([0, 1, 2, 3, 17, 0.35, "1/3", 0.0003, 5])


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.sampled_from("abcdefg"), st.tuples(st.integers(1, 300), WEIGHTS), min_size=1))
def test_every_source_is_within_a_block_of_its_target_at_every_slot(sources):
    from fractions import Fraction

    blocks = {s: n for s, (n, _) in sources.items()}
    given_weights = {s: Fraction(str(w)) for s, (_, w) in sources.items() if w}
    left, slot = dict(blocks), 0
    for phase in mixing.phases(blocks, mixing.whole_weights({s: w for s, (_, w) in sources.items()})):
        assert phase["slot"] == slot and phase["before"] == {s: blocks[s] - n for s, n in left.items()}
        length, order = sum(phase["parts"].values()), {}
        for s, at in phase["at"].items():
            order |= {j // phase["parts"][s] * length + at[j % phase["parts"][s]]: s for j in range(phase["placed"][s])}
        assert sorted(order) == list(range(phase["slots"]))  # each slot has one block
        running = {s for s in given_weights if left[s]} or {s for s, n in left.items() if n}
        assert phase["parts"].keys() == running  # all that have a weight and blocks left
        total = sum(given_weights.values()) if running <= given_weights.keys() else 0
        total = sum(given_weights[s] for s in running) if total else length
        share = {s: (given_weights[s] if running <= given_weights.keys() else phase["parts"][s]) / Fraction(total) for s in running}
        taken = dict.fromkeys(running, 0)
        for t in range(phase["slots"]):
            taken[order[t]] += 1
            assert all(abs(w * (t + 1) - taken[s]) < 1 for s, w in share.items())
        for s, n in taken.items():
            left[s] -= n
        assert not all(left[s] for s in running)  # a phase ends only where a source runs out
        slot += phase["slots"]
    assert not any(left.values())


def test_targets_hold_over_long_mixtures():
    blocks = {"a": 1_000, "b": 50_000, "c": 500_000}
    first, second, third = mixing.phases(blocks, {"a": 1, "b": 1, "c": 1})
    assert first["placed"]["a"] == 1000 and second["parts"] == {"b": 1, "c": 1} and second["placed"]["b"] + first["placed"]["b"] == 50_000 and third["parts"] == {"c": 1}
    many = {f"s{k}": 3_000_000 // (k + 1) for k in range(10)}
    for phase in mixing.phases(many, mixing.own_weights(many, 0.5)):
        total = sum(phase["parts"].values())
        assert all(abs(phase["placed"][s] - phase["slots"] * w / total) < 1 for s, w in phase["parts"].items())
    with pytest.raises(ValueError):
        mixing.phases({"a": 10**9, "b": 10**9}, mixing.whole_weights({"a": 0.123456789, "b": 0.876543211}))
    with pytest.raises(ValueError):
        mixing.whole_weights({"a": -1})


def test_files_follow_each_other_in_the_mixture(spark, tmp_path):
    sizes = {"a": 6000, "b": 900, "c": 90, None: 300}
    data = [(i, s, "x") for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))] + [(7, "a", "y")] * 3
    df = spark.createDataFrame(data, "doc_id long, source string, text string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixing.in_mixed_order(df, tie=F.xxhash64("text")).write.parquet(str(tmp_path / "mixed"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "mixed").glob("part-*"))
    got = [r for f in files for r in spark.read.parquet(str(f)).coalesce(1).collect()]
    want = mixing.mixed(df, tie=F.xxhash64("text")).orderBy("mix_position").collect()
    assert len(files) > 2 and [r.doc_id for r in got] == [r.doc_id for r in want]


def test_warc(spark):
    html = "<p>" + "x" * 200
    pages = [(3, "http://a/1", html), (1, "http://a/2\r\nX: y", html), (2, None, "short"), (5, "http://b", "short"), (4, "u", None), (6, "u", "é" * 99), (1, "again", html), (None, "n", html)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(map(tuple, warc.read_archives(warc.write_archives(warc.resolved(df), archive_bytes=300)).collect()), key=str)
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(i, len((t or "").encode()), digest(t), "revisit" if t == html and i != 1 else "response", 1 if t == html and i != 1 else None) for i, _, t in pages]
    assert got == sorted(want, key=str)
    assert warc.read_archives(warc.write_archives(warc.resolved(df.limit(0)))).count() == 0


def test_very_long_pages_and_clashing_columns(spark):
    long = "é" * 3_000_000
    df = spark.createDataFrame([(1, "u", long, "x", 1), (2, "u", long, "x", 1), (3, None, None, None, None)], "page_id long, url string, html string, digest string, size int")
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(warc.write_archives(warc.resolved(df))).collect()}
    assert got == {1: ("response", None, 6_000_000), 2: ("revisit", 1, 6_000_000), 3: ("response", None, 0)}


def test_damaged_archive_is_refused():
    record = warc.write_record(1, "u", b"payload", 7, hashlib.sha256(b"payload").hexdigest(), None)
    with pytest.raises(ValueError):
        list(warc.read_records(memoryview(record[:-4] + b"oops")))
