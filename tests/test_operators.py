"""Vectors worked out by hand from the formulas, and properties on random grids."""

import itertools
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spritelake.functions import color, grids, kernels, rules
from spritelake.operators import banding, cleaning, indexing, ordering, provenance, raster, similarity, splits, triage
from spritelake.sources import files
from spritelake.streaming import harvest


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_snes_snap(spark):
    cases = {0: 0, 3: 0, 4: 0, 5: 8, 12: 16, 20: 16, 28: 32, 252: 248, 255: 248}
    got = values(spark, [(v,) for v in cases], "v int", "v", color.snes_snap(F.col("v")))
    assert dict(got) == cases


def test_hue_and_distance(spark):
    cases = [((255, 0, 0), 0), ((255, 0, 128), 329.8824), ((0, 255, 0), 120), ((10, 10, 10), 0), ((200, 136, 90), 25.0909)]
    got = values(spark, [c for c, _ in cases], "r int, g int, b int", color.hue(F.col("r"), F.col("g"), F.col("b")))
    assert [round(h, 4) for (h,) in got] == [h for _, h in cases]
    pairs = [(359.0, 1.0, 2.0), (0.0, 180.0, 180.0), (10.0, 350.0, 20.0), (5.0, 0.0, 5.0)]
    assert values(spark, pairs, "a double, b double, d double", color.hue_distance(F.col("a"), F.col("b"))) == [(p[2],) for p in pairs]


def test_hex(spark):
    rows = [("#0a0B0c",), ("zz",), (None,), ("#080808",)]
    got = values(spark, rows, "c string", color.channel(F.col("c"), 1), color.snes_legal(F.col("c")))
    assert got == [(11, False), (None, False), (None, False), (8, True)]


def test_rubric_vectors(spark):
    points = {30: 25, 31: 20, 60: 20, 61: 25, 63: 25, 64: 24, 80: 20, 120: 10}
    assert dict(values(spark, [(c,) for c in points], "c int", "c", triage.technical(F.col("c")))) == points
    black = {0: 0, 5: 0, 10: 1, 15: 3, 20: 4, 25: 5, 30: 6, 49: 9, 50: 10, 80: 10}
    got = values(spark, [(c,) for c in black], "c int", "c", 25 - triage.construction(F.col("c"), F.lit(0), F.lit(8)))
    assert dict(got) == black


def test_color_bounds(spark):
    bounds = {16: 64, 17: 128, 32: 128, 33: 192, 64: 256, 65: 384, 128: 512, 129: 512}
    assert dict(values(spark, [(c,) for c in bounds], "c int", "c", cleaning.color_bound(F.col("c")))) == bounds


def test_licenses(spark):
    cases = {"CC0": True, "CC-BY 4.0": True, "public domain": True, "License: CC0": True, "CC-BY-NC": False,
             "CC0 and public domain": False, "Licence: CC0": False, "MIT": False}
    assert dict(values(spark, [(t,) for t in cases], "t string", "t", provenance.accepted(F.col("t")))) == cases
    assert values(spark, [("CC0 and public domain",), (None,)], "t string", provenance.accepted(F.col("t"), True)) == [(True,), (False,)]


def test_lock(spark):
    got = values(spark, [("a", " CONFIRM LOCK a "), ("a", "confirm lock a"), ("a", None)], "c string, t string", provenance.lock_confirmed(F.col("c"), F.col("t")))
    assert got == [(True,), (False,), (False,)]


def test_entropy(spark):
    rows = [([1] * 8 + [2] * 8,), ([1] + [2] * 15,), ([0, 0],), ([1] + [2] * 7,)]
    got = values(spark, rows, "g array<int>", F.round(cleaning.entropy(F.col("g"), F.lit(0)), 4))
    assert got == [(1.0,), (0.3373,), (0.0,), (0.5436,)]


def test_index_issues_stop_at_twenty(spark):
    rows = [(4, 10, ["#080808"], [9] * 40), (0, 1, ["#000000"], [0]), (2, 1, ["#000000"], [0, 1])]
    issues = cleaning.index_issues(F.col("w"), F.col("h"), F.col("p"), F.col("g"))
    got = [r[0] for r in values(spark, rows, "w int, h int, p array<string>, g array<int>", issues)]
    assert len(got[0]) == 21 and got[0][-1] == "suppressed" and got[1] == ["width", "length"] and got[2] == []


def test_class_rules(spark):
    rows = [("x", "tiles/a", True), ("DungeonCrawl", "a", False), ("z", "q", False), ("misc", "items/sword", False)]
    label = rules.class_label(F.col("p"), F.col("q"), F.col("m"))
    got = [tuple(r[0])[:2] for r in values(spark, rows, "p string, q string, m boolean", label)]
    assert got == [("tileset", None), ("tileset", "dungeon"), ("unknown", None), ("item", "weapon")]


def test_sheet_scores(spark):
    rows = [(5, 0, 0, 0.8), (30, 0, 1, 0.3), (10, 0, 0, None), (10, 0, 0, 0.575), (24, 0, 0, 0.575)]
    got = values(spark, rows, "n int, c int, t int, o double", similarity.sheet_type(F.col("n"), F.col("c"), F.col("t"), F.col("o")))
    assert [(r[0][0], r[0][1]) for r in got] == [("character", 0.75), ("tileset", 1.0), ("character", 0.3333), ("ambiguous", 0.5833), ("tileset", 0.375)]


def test_banding_vector(spark):
    px = spark.createDataFrame([(1, x, y, 1, 50 + 4 * y, 50 + 4 * y, 50 + 4 * y) for y in range(7) for x in range(2)], "sprite_id int, x int, y int, idx int, r int, g int, b int")
    assert sorted(r.y for r in banding.banding_rows(px).collect()) == [4, 5, 6]


@pytest.mark.parametrize("n,top5,bottom10", [(1, 0, 0), (10, 0, 9), (19, 0, 17), (20, 1, 18), (100, 5, 90), (101, 5, 90)])
def test_rank_thresholds(spark, n, top5, bottom10):
    falling = list(range(1000, 1000 - n, -1))
    row = triage.rank_thresholds(spark.createDataFrame([(v,) for v in falling], "total_score int")).first()
    assert (row.top5, row.bottom10) == (falling[top5], falling[bottom10])


@pytest.mark.parametrize("n,ratio,stratum,expected", [(1, 0.1, None, 1), (5, 0.1, None, 1), (15, 0.1, None, 2), (25, 0.1, None, 2), (35, 0.1, None, 4), (100, 0.2, None, 20), (1, 0.2, "g", 0)])
def test_split_counts(spark, n, ratio, stratum, expected):
    rows = spark.range(n).withColumn("g", F.lit(None).cast("string"))
    assert splits.split(rows, "id", ratio, 1, stratum).filter("split = 'val'").count() == expected


def test_split_rejects_bad_ratio(spark):
    with pytest.raises(ValueError):
        splits.split(spark.range(3), "id", 1.0)


def brute_regions(g):
    h, w = g.shape
    out = np.full((h, w), -1)
    for start in range(h * w):
        if g.flat[start] > 0 and out.flat[start] < 0:
            todo = [start]
            while todo:
                i = todo.pop()
                if out.flat[i] >= 0:
                    continue
                out.flat[i] = start
                y, x = divmod(i, w)
                todo += [a * w + b for a, b in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)) if 0 <= a < h and 0 <= b < w and g[a, b] == g[y, x]]
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 7), st.integers(1, 7), st.data())
def test_regions_equal_flood_fill(h, w, data):
    g = np.array(data.draw(st.lists(st.integers(0, 2), min_size=h * w, max_size=h * w))).reshape(h, w)
    assert np.array_equal(kernels.label_regions(g[None])[0], brute_regions(g))


def brute_merge(pal, target):
    pal = [tuple(map(int, p)) for p in pal]
    while len(pal) > target:
        gap, i, j = min((sum((a - b) ** 2 for a, b in zip(pal[i], pal[j], strict=True)), i, j) for i, j in itertools.combinations(range(len(pal)), 2))
        pal[i] = tuple((a + b) // 2 for a, b in zip(pal[i], pal[j], strict=True))
        del pal[j]
    return pal


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(*[st.integers(0, 255)] * 3), min_size=1, max_size=14), st.integers(1, 6))
def test_palette_merge(pal, target):
    assert list(map(tuple, kernels.merge_closest(np.array([pal]), target)[0].tolist())) == brute_merge(pal, target)


def test_grid_columns(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(0, 3, h * w).tolist(), int(w)) for i, (h, w) in enumerate([(1, 1), (1, 5), (5, 1), (4, 6), (8, 8)])]
    df = spark.createDataFrame(rows, "id int, grid array<int>, width int")
    g, w = F.col("grid"), F.col("width")
    df = df.select("id", grids.outline(g, w).alias("o"), grids.orphans(g, w).alias("a"), grids.mirrored(g, w).alias("m"), grids.zoomed(g, w, 2).alias("z"))
    for r in df.collect():
        _, flat, width = rows[r.id]
        a = np.array(flat).reshape(-1, width)
        p = np.pad(a, 1)
        near = np.stack([p[1:-1, :-2], p[1:-1, 2:], p[:-2, 1:-1], p[2:, 1:-1]])
        assert r.o == ((a > 0) & (near.min(0) == 0)).ravel().tolist()
        assert r.a == ((a > 0) & (near != a).all(0)).ravel().tolist()
        assert r.m == a[:, ::-1].ravel().tolist() and r.z == np.repeat(np.repeat(a, 2, 0), 2, 1).ravel().tolist()


def test_similar_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, int(i % 3), sorted(set(rng.integers(0, 12, rng.integers(0, 10)).tolist()))) for i in range(60)]
    df = spark.createDataFrame(rows, "sprite_id int, pack int, palette array<int>")
    got = {(r.id_a, r.id_b) for r in similarity.similar_pairs(df, ["pack"]).collect()}
    want = {(a, b) for (a, p, x), (b, q, y) in itertools.combinations(rows, 2) if p == q and x and y and len({*x} & {*y}) / len({*x} | {*y}) >= 0.6}
    assert got == want and want


def png(rows, kind, depth_bytes, palette=None, trns=None):
    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    h, w = len(rows), len(rows[0]) // depth_bytes
    out = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0))
    out += (chunk(b"PLTE", palette) if palette else b"") + (chunk(b"tRNS", trns) if trns else b"")
    return out + chunk(b"IDAT", zlib.compress(b"".join(b"\0" + r for r in rows))) + chunk(b"IEND", b"")


def test_images(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "rgba.png").write_bytes(png([bytes([10, 20, 30, 255, 1, 2, 3, 128])], 6, 4))
    (tmp_path / "indexed.png").write_bytes(png([bytes([0, 1])], 3, 1, bytes([9, 8, 7, 6, 5, 4])))
    heads = {r.path.rsplit("/", 1)[1]: (r.width, r.height, r.palette_indexed) for r in files.png_headers(spark, str(tmp_path)).collect()}
    assert heads == {"rgba.png": (2, 1, False), "indexed.png": (2, 1, True)}
    px = {(r.path.rsplit("/", 1)[1], r.x): (r.r, r.g, r.b, r.a) for r in files.pixels(files.images(spark, str(tmp_path))).collect()}
    assert px[("rgba.png", 0)] == (10, 20, 30, 255) and px[("rgba.png", 1)] == (1, 2, 3, 128) and px[("indexed.png", 1)] == (6, 5, 4, 255)


def test_zip_and_records(spark, tmp_path):
    import json
    import zipfile

    with zipfile.ZipFile(tmp_path / "p.zip", "w") as z:
        for name in ("a/x.png", "b/x.png", "__MACOSX/y.png", "t.txt"):
            z.writestr(name, name)
    flat = {r.member: bytes(r.content) for r in files.zip_members(spark, str(tmp_path)).collect()}
    assert flat == {"x.png": b"a/x.png", "y.png": b"__MACOSX/y.png"}
    assert {r.member for r in files.zip_members(spark, str(tmp_path), True).collect()} == {"a/x.png", "b/x.png"}
    schema = spark.createDataFrame([], "sprite_id string").schema
    assert files.manifest(spark, str(tmp_path / "none.json"), schema).count() == 0
    (tmp_path / "m.jsonl").write_text('{"sprite_id": "a"}\nbad\n')
    assert [r.sprite_id for r in files.json_lines(spark, str(tmp_path / "m.jsonl"), schema).collect()] == ["a"]
    for name in ("s.json", "s_seq.json", "manifest.json"):
        (tmp_path / name).write_text(json.dumps({"sprite_id": name}))
    assert [r.sprite_id for r in files.sprite_records(spark, str(tmp_path), schema).collect()] == ["s.json"]
    rows = spark.createDataFrame([("a",), ("b",)], schema)
    rows.write.parquet(str(tmp_path / "corpus"))
    moved = files.verified_move(spark.read.parquet(str(tmp_path / "corpus")), str(tmp_path / "moved"), str(tmp_path / "corpus"))
    assert moved == (2, []) and not (tmp_path / "corpus").exists() and spark.read.parquet(str(tmp_path / "moved")).count() == 2
    assert files.markdown_table(rows.orderBy("sprite_id")).splitlines()[2:] == ["| a |", "| b |"]
    assert provenance.training_gate(rows, True, "PHASE4_ARCHITECTURE_REVIEW: APPROVED") and not provenance.training_gate(rows.limit(0), True, "PHASE4_ARCHITECTURE_REVIEW: APPROVED")


def test_each_batch_takes_rows_once(spark, tmp_path):
    source, seen = str(tmp_path / "in"), []
    for part in ([1, 2, 2], [2, 3]):
        spark.createDataFrame([(v,) for v in part], "id long").coalesce(1).write.mode("append").parquet(source)
        new = harvest.stream(spark, source)
        query = harvest.each_batch(new, "id", str(tmp_path / "manifest"), str(tmp_path / "state"), lambda df, n: seen.extend(r.id for r in df.collect()))
        query.awaitTermination()
    assert sorted(seen) == [1, 2, 3]


def test_breaker_and_cells(spark):
    rows = spark.range(1, 41).withColumn("bad", F.col("id").isin(30, 31, 32))
    assert tuple(cleaning.breaker(rows, "id", F.col("bad"), 9).first()) == (31, 31, 2)
    px = spark.createDataFrame([(0, 0, 0, True), (0, 9, 9, False)], "sheet long, x int, y int, filled boolean")
    assert {(r.row, r.col) for r in raster.empty_cells(px, 8, 2, 2).collect()} == {(0, 1), (1, 0), (1, 1)}


def test_reduce_palette_merges_whole_palettes(spark, tmp_path):
    from spritelake.plans import queries

    sizes = {1: 15, 2: 16, 3: 20, 4: 21, 5: 24, 6: 43}
    rows = [(i, 0, [k * 0.01 + 0.005 for k in range(n)]) for i, n in sizes.items()]
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.sprite_id: r for r in queries.QUERIES["reduce_palette"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [2, 3, 4, 5, 6]

    def slow(packed, each):
        pal = [(p >> 16, p >> 8 & 255, p & 255) for p in packed]
        while len(pal) > 15:
            _, i, j = min((sum((x - y) ** 2 for x, y in zip(pal[i], pal[j], strict=True)), i, j) for i in range(len(pal)) for j in range(i + 1, len(pal)))
            pal[i] = tuple((x + y) // 2 for x, y in zip(pal[i], pal.pop(j), strict=True))
            if each:
                pal[i] = tuple(min(248, round(x / 8) * 8) for x in pal[i])
        return ",".join(str(r << 16 | g << 8 | b) for r, g, b in (dict.fromkeys(pal) if each else pal))

    for i, r in got.items():
        packed = sorted(int(np.floor((np.float64(np.float32(x)) + 0.6) * 100)) * 70001 % 16777216 for x in rows[i - 1][2])
        packed = list(dict.fromkeys(packed))
        assert r.colors == sizes[i] == len(packed) and (r.merged, r.snapped) == (slow(packed, False), slow(packed, True))


def test_rows_without_pack_stay(spark):
    rows = spark.createDataFrame([(1, None), (2, "a"), (3, "a"), (4, None), (5, "solo")], "id long, pack string")
    got = {r.id: (r.pack_total, r.quarantine) for r in cleaning.quarantined(rows).collect()}
    assert got == {1: (2, None), 2: (2, None), 3: (2, None), 4: (2, None), 5: (1, "ui_elements")}
    scores = spark.createDataFrame(
        [(i, None if i % 2 else "p", 16, 16, False, 60 + i, [], "A_autopass") for i in range(10)],
        "sprite_id long, pack string, width int, height int, is_tileset boolean, total_score int, failure_modes array<string>, bucket string",
    )
    found = {r.sprite_id: list(r.reasons) for r in triage.anomalies(scores).collect()}
    assert len(found) == 10 and found[0] == ["H2"] and found[9] == []  # the lowest in a good pack, which a null one is as well


def test_similar_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i % 25), "b" if i % 3 else None, sorted(set(rng.integers(0, 14, int(rng.integers(0, 9))).tolist()))) for i in range(40)]
    rows += [rows[4], (3, "b", [1, 2, 3, 4, 5]), (70, "b", [1, 2, 3, 4, 5]), (3, "b", [9, 10, 11])]
    got = sorted(map(str, similarity.similar_pairs(spark.createDataFrame(rows, "sprite_id long, pack string, palette array<int>"), ["pack"]).collect()))
    whole, want = sorted({(i, p, tuple(c)) for i, p, c in rows}, key=str), []
    for a, b in itertools.permutations(whole, 2):
        x, y = set(a[2]), set(b[2])
        if a[0] < b[0] and a[1] == b[1] and x and y and len(x & y) / len(x | y) >= 0.6:
            want.append((a[0], b[0], len(x & y) / len(x | y), a[1]))
    assert got == sorted(f"Row(id_a={a}, id_b={b}, similarity={s}, pack={p!r})" for a, b, s, p in want)


def test_similar_pairs_of_few_colours_are_compared_as_bits(spark, monkeypatch):
    """Blocks of few colours in several tiles, with colours beyond the bits, beside one of many colours."""
    monkeypatch.setattr(similarity, "WORDS", 1)
    monkeypatch.setattr(similarity, "TILE", 7)
    rng = np.random.default_rng(6)
    base = rng.permutation(100)
    rows = [(i % 55, "few" if i % 2 else None, sorted({*base[: 40 + i % 5].tolist(), *rng.integers(0, 100, 25 + i % 20).tolist()})) for i in range(60)]
    rows += [(100 + i, "many", [i * 10 // 2 * 2 + k for k in range(5)]) for i in range(40)] + [(1, "few", list(range(50))), rows[3]]
    found = similarity.similar_pairs(spark.createDataFrame(rows, "sprite_id long, pack string, palette array<int>"), ["pack"])
    whole = {(i, p, tuple(c)) for i, p, c in rows}
    pairs = [(a, b, set(a[2]), set(b[2])) for a, b in itertools.permutations(whole, 2) if a[0] < b[0] and a[1] == b[1]]
    want = [(a[0], b[0], len(x & y) / len(x | y), a[1]) for a, b, x, y in pairs if len(x & y) / len(x | y) >= 0.6]
    got = [tuple(r) for r in found.collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and 100 < len(want) < len(pairs)
    assert "bit_count" in found._jdf.queryExecution().optimizedPlan().toString()


def test_hash_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    rows = [(i, base[i % 6] ^ sum(1 << int(b) for b in set(rng.integers(0, 64, int(rng.integers(0, 4))).tolist()))) for i in range(50)]
    df = spark.createDataFrame([(i, f"{h:016x}") for i, h in rows], "id long, hash string")
    for within in (0, 1, 3, 5):
        got = sorted((r.id_a, r.id_b, r.distance) for r in similarity.hash_pairs(df, "id", "hash", within).collect())
        assert got == sorted((i, j, (a ^ b).bit_count()) for (i, a), (j, b) in itertools.combinations(rows, 2) if (a ^ b).bit_count() <= within)
    with pytest.raises(ValueError):
        similarity.hash_pairs(df, "id", "hash", 15)


def test_places_and_running_sums(spark):
    rng = np.random.default_rng(5)
    rows = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"k{i % 4}", int(rng.integers(0, 2))) for i in rng.permutation(200).tolist()]
    got = ordering.running(spark.createDataFrame(rows, "id long, k string, v int"), ["id"], {"total": F.col("v")}, ("k",), 15)
    want, seen = [], {}
    for i, k, v in sorted(rows):
        n, t = seen.get(k, (0, 0))
        seen[k] = (n + 1, t + v)
        want.append((i, k, v, *seen[k]))
    assert sorted(map(tuple, got.collect())) == want and got.columns == ["id", "k", "v", "place", "total"]
    assert ordering.running(spark.createDataFrame([], "id long"), ["id"], {}).count() == 0


def test_hash_kernels_equal_plain_arithmetic(spark):
    rng = np.random.default_rng(6)
    gray = rng.integers(0, 256, (5, 1024))
    rows = spark.createDataFrame([(g.tolist(),) for g in gray] + [([1, 2],), (None,)], "g array<int>")
    got = [r.h for r in rows.select(kernels.dct_hash("g").alias("h")).collect()]
    for g, h in zip(gray, got, strict=False):
        low = [
            sum(g[32 * y + x] * np.cos(np.pi * (2 * y + 1) * v / 64) * np.cos(np.pi * (2 * x + 1) * u / 64) for y in range(32) for x in range(32))
            for v in range(8) for u in range(8)
        ]
        assert h == f"{int(''.join('1' if c > np.median(low[1:]) else '0' for c in low), 2):016x}"
    assert got[5:] == [None, None]
    flat = spark.createDataFrame([([77] * 480, 24), (list(range(64)), 8), (None, 8)], "g array<int>, w int")
    small = [r.s for r in flat.select(kernels.resample_8x8("g", "w").alias("s")).collect()]
    assert small[0] == [77] * 64 and small[1] == list(range(64)) and small[2] is None


def test_manifests_splits_and_halt(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"sprite_id":"a"},{"other":1}]')
    (tmp_path / "b.json").write_text('["b", "c"]')
    (tmp_path / "c.json").write_text('{"d": {}, "e": 1}')
    (tmp_path / "d.json").write_text("[]")
    assert sorted(r.id for r in files.manifest_ids(spark, str(tmp_path)).collect()) == list("abcde")
    assert files.manifest_ids(spark, str(tmp_path / "none")).count() == 0
    files.write_split_manifest(spark.createDataFrame([(1, "train"), (2, "val")], "id long, split string"), str(tmp_path / "s"), "id")
    assert [r.id for r in files.load_split(spark, str(tmp_path / "s"), "val", "id").collect()] == [2]
    with pytest.raises(FileNotFoundError):
        files.load_split(spark, str(tmp_path / "s"), "test", "id")
    (tmp_path / "s" / "split=val" / "part-x.json").write_text('"no record"\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.load_split(spark, str(tmp_path / "s"), "val", "id").collect()
    halt = harvest.halt_file(spark, str(tmp_path / "HALT"))
    assert not halt()
    (tmp_path / "HALT").write_text("")
    assert halt()


def broadcast_whole(plan, node):
    """Whether a node of a finished plan went into a broadcast with no shuffle between, whose size would be known."""
    at = []
    for line in plan.split("Initial Plan")[0].splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        at = [a for a in at if a[0] < depth] + [(depth, line)]
        if node in line:
            for _, above in reversed(at):
                if "BroadcastExchange" in above:
                    return True
                if "Exchange" in above:
                    break
    return False


def test_hash_pairs_broadcast_no_segments(spark):
    rng = np.random.default_rng(5)
    base = [int(x) for x in rng.integers(0, 1 << 63, 40)]
    rows = [(i, f"{base[i % 40] ^ (1 << i % 64) ^ (1 << i * 7 % 64):016x}") for i in range(400)]
    found = similarity.hash_pairs(spark.createDataFrame(rows, "id long, hash string").repartition(2), "id", "hash")
    want = sum((int(a, 16) ^ int(b, 16)).bit_count() <= 3 for (_, a), (_, b) in itertools.combinations(rows, 2))
    assert len(found.collect()) == want > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "Generate explode" in plan and not broadcast_whole(plan, "Generate explode")


def test_class_label_reads_its_text_once(spark):
    """Below a filter the label's text is one expression, not one a rule."""
    rows = spark.createDataFrame([(1, "large hero", False), (2, "zz qq", None), (3, None, True)], "id int, name string, m boolean")
    rows = rows.select("id", F.substring_index("name", " ", -1).alias("pack"), F.lit("q/z").alias("path"), "m")
    found = rows.withColumn("c", rules.class_label(F.col("pack"), F.col("path"), F.col("m"))).filter("c.sprite_class <> 'tileset'").select("id", "c.sprite_class")
    assert sorted(tuple(r) for r in found.collect()) == [(1, "character"), (2, "unknown")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("lower(") <= 2  # the filter's and the result's


def test_schema_gaps_read_a_record_once(spark):
    whole = '{"' + '":1,"'.join(cleaning.REQUIRED) + '":1,"format_provenance":{"' + '":null,"'.join(cleaning.REQUIRED_FORMAT) + '":1}}'
    rows = [(1, whole), (2, whole.replace('"width"', '"w"')), (3, None), (4, "no json"), (5, whole.replace('"file_format"', '"f"')), (6, '{"format_provenance":7}')]
    found = spark.createDataFrame(rows, "id int, raw string").select("id", cleaning.schema_gaps(F.concat("raw", F.lit(""))).alias("gaps"))
    missing = ["format_provenance"]
    assert {r.id: r.gaps for r in found.collect()} == {1: [], 2: ["width"], 3: missing, 4: missing, 5: ["format_provenance.file_format"], 6: cleaning.REQUIRED}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("concat(raw") == 1


def test_light_and_kept_values(spark):
    px = spark.createDataFrame([(1, 0, 0, 255, 255, 255, 255), (1, 2, 4, 255, 255, 255, 255), (1, 3, 3, 9, 9, 9, 10), (2, 0, 0, 5, 5, 5, 0)], "id long, x int, y int, r int, g int, b int, a int")
    got = {r.id: (round(r.fill, 3), r.light_x, r.light_y) for r in indexing.light_fill(px, "id").collect()}
    assert got == {1: (0.667, 1.0, 2.0), 2: (0.0, None, None)}
