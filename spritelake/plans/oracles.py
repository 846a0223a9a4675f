"""SQL that DuckDB runs on the same tables, one for each query that SQL can express."""

from __future__ import annotations

from spritelake.functions import rules
from spritelake.operators import cleaning, provenance, similarity
from spritelake.plans import fixtures as fx
from spritelake.plans.queries import SHEET_NAMES


def _quoted(values) -> str:
    return ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)


def _cells(name: str, add: str, width: str) -> str:
    return f"""{name} AS (
        SELECT sprite_id, pack, w, i, i % w AS x, i // w AS y, idx, {fx.RED} AS r, {fx.GREEN} AS g, {fx.BLUE} AS b FROM (
            SELECT vec_id AS sprite_id, label AS pack, {width} AS w, i,
                   greatest(0, least(5, CAST(floor((CAST(embedding[i + 1] AS DOUBLE) + {add}) * 10) AS INTEGER))) AS idx
            FROM embeddings, (SELECT unnest(range(64)) AS i) AS n) AS t)"""


PX = _cells("px", "0.30", "8")
SPARSE = _cells("sp", "0.0", "CAST(pow(2, vec_id % 7) AS INTEGER)")
SHEET = lambda stride: f"""sheet_px AS (
        SELECT vec_id // 16 AS sheet, (vec_id % 16) % 4 * {stride} + i % 8 AS x, (vec_id % 16) // 4 * {stride} + i // 8 AS y,
               greatest(0, least(5, CAST(floor(CAST(embedding[i + 1] AS DOUBLE) * 10) AS INTEGER))) AS idx
        FROM embeddings, (SELECT unnest(range(64)) AS i) AS n)"""  # noqa: E731
HEX = "'#' || printf('%02x', r) || printf('%02x', g) || printf('%02x', b)"
USED = "used AS (SELECT DISTINCT pack, idx, r, g, b FROM px WHERE idx > 0)"
OUTLINE = """ol AS (
        SELECT p.*, (p.idx > 0 AND least(coalesce(l.idx, 0), coalesce(q.idx, 0), coalesce(u.idx, 0), coalesce(d.idx, 0)) = 0) AS outline,
               (p.idx > 0 AND coalesce(l.idx, -1) <> p.idx AND coalesce(q.idx, -1) <> p.idx AND coalesce(u.idx, -1) <> p.idx AND coalesce(d.idx, -1) <> p.idx) AS orphan
        FROM {0} p LEFT JOIN {0} l ON l.sprite_id = p.sprite_id AND l.y = p.y AND l.x = p.x - 1
        LEFT JOIN {0} q ON q.sprite_id = p.sprite_id AND q.y = p.y AND q.x = p.x + 1
        LEFT JOIN {0} u ON u.sprite_id = p.sprite_id AND u.x = p.x AND u.y = p.y - 1
        LEFT JOIN {0} d ON d.sprite_id = p.sprite_id AND d.x = p.x AND d.y = p.y + 1)"""
REGIONS = f"""{PX},
    e AS (SELECT a.sprite_id, a.i AS i, b.i AS j FROM px a JOIN px b ON a.sprite_id = b.sprite_id AND a.idx = b.idx AND a.idx > 0
          AND abs(a.x - b.x) + abs(a.y - b.y) <= 1),
    walk(sprite_id, i, j) AS (SELECT * FROM e UNION SELECT w.sprite_id, w.i, e.j FROM walk w JOIN e ON e.sprite_id = w.sprite_id AND e.i = w.j),
    lab AS (SELECT sprite_id, i, min(j) AS root FROM walk GROUP BY 1, 2),
    {OUTLINE.format("px")},
    cell AS (SELECT o.*, lab.root, coalesce(count(lab.root) OVER (PARTITION BY o.sprite_id, lab.root), 0) AS size FROM ol o LEFT JOIN lab ON lab.sprite_id = o.sprite_id AND lab.i = o.i),
    shade AS (SELECT DISTINCT s.sprite_id, s.root FROM cell s JOIN cell t ON s.sprite_id = t.sprite_id AND abs(s.x - t.x) + abs(s.y - t.y) = 1
              WHERE s.root IS NOT NULL AND t.root IS NOT NULL AND t.size > 6),
    cat AS (SELECT c.*, CASE WHEN idx = 0 THEN 0 WHEN outline THEN 1 WHEN size > 6 THEN 2 ELSE 3 END AS c4,
            CASE WHEN idx = 0 THEN 0 WHEN outline THEN 1 WHEN size > 6 THEN 2 WHEN shade.root IS NOT NULL THEN 3 ELSE 4 END AS c5
            FROM cell c LEFT JOIN shade ON shade.sprite_id = c.sprite_id AND shade.root = c.root)"""
WORDS = """w AS (SELECT doc_id, CAST(ceil(sqrt(CAST(n_chars AS DOUBLE))) AS INTEGER) AS side, len(list_distinct(string_split(text, ' '))) AS colors FROM documents)"""
BOUND = "CASE " + " ".join(f"WHEN side <= {a} THEN {b}" for a, b in cleaning.COLOR_BOUNDS) + f" ELSE {cleaning.COLOR_CAP} END"
SIZE_CLASS = "CASE " + " ".join(f"WHEN side <= {a} THEN {a}" for a, _ in cleaning.COLOR_BOUNDS) + " ELSE 129 END"
PACKS = (
    "packs AS (SELECT p_partkey AS id, CASE string_split(p_name, ' ')[-1] "
    + " ".join(f"WHEN '{w}' THEN '{p}'" for w, p, _ in fx.WORD_PATHS) + " ELSE 'misc' END AS pack, CASE string_split(p_name, ' ')[-1] "
    + " ".join(f"WHEN '{w}' THEN '{q}'" for w, _, q in fx.WORD_PATHS) + " ELSE 'q/z' END AS path, p_partkey % 37 = 0 AS has_meta FROM part)"
)


def _class_case(k: int) -> str:
    out = ["CASE WHEN has_meta THEN " + ("'tileset'", "NULL", "0.95", "'tileset_meta_present'")[k]]
    for pattern, cls, sub, confidence, rule in rules.CLASS_RULES:
        if k == 1 and sub is None:
            refined = " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for p, n in rules.SUBCLASS_RULES.get(cls, []))
            value = f"CASE {refined} ELSE NULL END"
        else:
            value = (f"'{cls}'", f"'{sub}'", str(confidence), f"'{rule}'")[k]
        out.append(f"WHEN regexp_matches(t, '{pattern}') THEN {value}")
    return " ".join([*out, "ELSE " + ("'unknown'", "NULL", "0.0", "'no_rule_matched'")[k], "END"])


CLASSES = f"""{PACKS}, texts AS (SELECT *, lower(pack || '/' || path) AS t FROM packs),
    classes AS (SELECT id, pack, path, {_class_case(0)} AS sprite_class, {_class_case(1)} AS sprite_subclass,
                CAST({_class_case(2)} AS DOUBLE) AS class_confidence, {_class_case(3)} AS class_rule_matched FROM texts)"""
STYLE = "CASE " + " ".join(f"WHEN regexp_matches(lower(pack), '{p}') THEN '{s}'" for p, s in rules.STYLE_RULES) + " ELSE 'unknown' END"
ENTROPY = """ent AS (SELECT sprite_id, sum(-(n / t) * log2(n / t)) AS entropy, count(*) AS colors FROM (
        SELECT sprite_id, CAST(count(*) AS DOUBLE) AS n, CAST(sum(count(*)) OVER (PARTITION BY sprite_id) AS DOUBLE) AS t FROM sp WHERE idx > 0 GROUP BY sprite_id, idx) AS c GROUP BY 1)"""
ARTIFACT = f"""{SPARSE}, {ENTROPY},
    m AS (SELECT s.sprite_id, any_value(pack) AS pack, avg(CASE WHEN idx = 0 THEN 1.0 ELSE 0.0 END) AS empty, coalesce(any_value(e.colors), 0) AS colors,
          coalesce(any_value(e.entropy), 0) AS entropy, any_value(w) / (64.0 / any_value(w)) AS aspect FROM sp s LEFT JOIN ent e ON e.sprite_id = s.sprite_id GROUP BY 1),
    art AS (SELECT *, CASE WHEN empty > 0.8 THEN 'transparency' WHEN colors < 2 THEN 'unique_colors' WHEN entropy < 0.5 THEN 'entropy'
            WHEN aspect > 4.0 THEN 'aspect_wide' WHEN aspect < 0.25 THEN 'aspect_tall' ELSE 'keep' END AS reason FROM m)"""
LIMITS = """o AS (SELECT total_score, row_number() OVER (ORDER BY total_score DESC) - 1 AS k, count(*) OVER () AS n FROM scores WHERE NOT is_tileset),
    lim AS (SELECT max(total_score) FILTER (k = n // 20) AS top5, max(total_score) FILTER (k = least(n - 1, CAST(floor(n * 0.9::DOUBLE) AS BIGINT))) AS bottom10 FROM o)"""
MANIFEST = """man AS (SELECT doc_id AS sprite_id, source, lang, n_chars % 60 + 40 AS total_score, doc_id % 23 = 0 AS is_tileset,
        list_filter([CASE WHEN n_chars % 3 = 0 THEN 'banding_detected' END, CASE WHEN n_chars % 4 = 0 THEN 'low_fill' END], lambda v: v IS NOT NULL) AS modes,
        CASE WHEN doc_id % 23 = 0 THEN 'E_tileset' WHEN n_chars % 60 + 40 >= 85 THEN 'A_autopass' WHEN n_chars % 60 + 40 >= 70 THEN 'B_borderline' ELSE 'C_autoreject' END AS bucket FROM documents),
    dec AS (SELECT doc_id AS sprite_id, CASE WHEN toxic = 1 THEN 'flag_recalibration' WHEN quality = 1 THEN 'accept' ELSE 'reject' END AS decision,
            CASE WHEN doc_id % 3 = 0 THEN 60 + doc_id % 40 END AS at_decision FROM labels)"""
CALIBRATED = f"""{MANIFEST},
    cal0 AS (SELECT dec.*, coalesce(m.total_score, at_decision, -1) AS total_score, coalesce(m.modes, []) AS modes FROM dec LEFT JOIN (SELECT * FROM man WHERE sprite_id % 4 <> 0) m ON m.sprite_id = dec.sprite_id),
    cal AS (SELECT *, CASE WHEN decision = 'reject' AND total_score >= 85 THEN 'permissive' WHEN decision = 'accept' AND total_score < 85 THEN 'strict'
            WHEN decision = 'flag_recalibration' THEN 'flagged' ELSE 'agreed' END AS verdict FROM cal0)"""
def _merging(name: str, middle: str) -> str:
    """A recursive table that merges the two closest of a list of packed colours, the first pair of
    equals, until 15 are left; ``middle`` gives a channel of two merged ones."""
    gap = " + ".join(f"pow(CAST((p[i] >> {k}) & 255 AS BIGINT) - CAST((p[j] >> {k}) & 255 AS BIGINT), 2)" for k in (16, 8, 0))
    channel = " + ".join(middle.format(f"((p[c.i] >> {k}) & 255)", f"((p[c.j] >> {k}) & 255)") + f" * {1 << k}" for k in (16, 8, 0))
    return f"""{name} AS (
        SELECT sprite_id, p FROM start
        UNION ALL
        SELECT sprite_id, list_transform(list_filter(range(1, len(p) + 1), lambda k: k <> c.j), lambda k: CASE WHEN k = c.i THEN CAST({channel} AS BIGINT) ELSE p[k] END) AS p
        FROM (SELECT sprite_id, p, list_min(flatten(list_transform(range(1, len(p)), lambda i: list_transform(range(i + 1, len(p) + 1),
              lambda j: struct_pack(d := CAST({gap} AS BIGINT), i := i, j := j))))) AS c FROM {name} WHERE len(p) > 15) AS t)"""


COMPLETIONS = "done AS (SELECT doc_id, lang, source, CASE WHEN n_chars % 97 = 0 THEN n_chars % 60 + 30 ELSE 95 + n_chars % 6 END AS score FROM documents)"
BINS = """bins AS (SELECT vec_id AS sprite_id, label AS pack, list_distinct(list_transform(embedding, lambda v: CAST(floor((CAST(v AS DOUBLE) + 0.6) * 100) AS INTEGER))) AS p FROM embeddings)"""
JACCARD = "CAST(len(list_intersect(a.p, b.p)) AS DOUBLE) / (len(a.p) + len(b.p) - len(list_intersect(a.p, b.p)))"
OVERLAP = f"""rows0 AS (SELECT vec_id AS id, CAST(label * 100 + length(bin(vec_id)) AS BIGINT) AS sheet, list_distinct(list_transform(embedding, lambda v: CAST(floor((CAST(v AS DOUBLE) + 0.6) * CASE WHEN label % 3 = 0 THEN 20 WHEN label % 3 = 1 THEN 60 ELSE 120 END) AS INTEGER))) AS p
        FROM embeddings),
    kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY id) AS k FROM rows0) t WHERE k <= 24),
    prs AS (SELECT a.sheet, {JACCARD} AS j, row_number() OVER (PARTITION BY a.sheet ORDER BY md5('42:' || a.id || ':' || b.id)) AS r FROM kept a JOIN kept b ON a.sheet = b.sheet AND a.k < b.k),
    ov AS (SELECT sheet, avg(j) AS overlap FROM prs WHERE r <= 12 GROUP BY 1)"""
GRAY_HASH = """hs AS (SELECT vec_id, bits, lower(printf('%016x', 0)) AS z FROM (SELECT vec_id, list_transform(range(64), lambda i: CASE WHEN CAST(embedding[i + 1] AS DOUBLE) >= list_sum(list_transform(embedding, lambda v: CAST(v AS DOUBLE))) / 64 THEN 1 ELSE 0 END) AS bits FROM embeddings) t),
    hx AS (SELECT vec_id, array_to_string(list_transform(range(16), lambda k: substr('0123456789abcdef', CAST(bits[4 * k + 1] * 8 + bits[4 * k + 2] * 4 + bits[4 * k + 3] * 2 + bits[4 * k + 4] + 1 AS BIGINT), 1)), '') AS hash, bits FROM hs)"""
BANDS = f"""{PX},
    bp AS (SELECT sprite_id, y, {fx.BAND_RED} AS r, {fx.BAND_GREEN} AS g, {fx.BAND_RED} AS b FROM px WHERE idx > 0),
    mean AS (SELECT sprite_id, y, CAST(sum(r) // count(*) AS BIGINT) AS r, CAST(sum(g) // count(*) AS BIGINT) AS g, CAST(sum(b) // count(*) AS BIGINT) AS b FROM bp GROUP BY 1, 2),
    lh AS (SELECT *, r * 0.299::DOUBLE + g * 0.587::DOUBLE + b * 0.114::DOUBLE AS l, CASE WHEN greatest(r, g, b) = least(r, g, b) THEN 0.0::DOUBLE ELSE 60.0::DOUBLE * CASE
            WHEN greatest(r, g, b) = r THEN fmod(fmod((g - b) / CAST(greatest(r, g, b) - least(r, g, b) AS DOUBLE), 6.0::DOUBLE) + 6.0::DOUBLE, 6.0::DOUBLE)
            WHEN greatest(r, g, b) = g THEN (b - r) / CAST(greatest(r, g, b) - least(r, g, b) AS DOUBLE) + 2.0::DOUBLE
            ELSE (r - g) / CAST(greatest(r, g, b) - least(r, g, b) AS DOUBLE) + 4.0::DOUBLE END END AS h FROM mean),
    st AS (SELECT *, row_number() OVER w - 1 AS i, CASE WHEN l - lag(l) OVER w > 2 THEN 1 WHEN l - lag(l) OVER w < -2 THEN -1 ELSE 0 END AS d,
           abs(fmod(fmod(h - lag(h) OVER w + 180.0::DOUBLE, 360.0::DOUBLE) + 360.0::DOUBLE, 360.0::DOUBLE) - 180.0::DOUBLE) AS turn FROM lh WINDOW w AS (PARTITION BY sprite_id ORDER BY y)),
    rs AS (SELECT *, (i = 0 OR d = 0 OR d <> coalesce(lag(d) OVER w, 0) OR turn >= 5) AS restart FROM st WINDOW w AS (PARTITION BY sprite_id ORDER BY y)),
    run AS (SELECT *, sum(CASE WHEN restart THEN 1 ELSE 0 END) OVER (PARTITION BY sprite_id ORDER BY y) AS run FROM rs),
    pos AS (SELECT *, row_number() OVER (PARTITION BY sprite_id, run ORDER BY y) AS step FROM run)"""

SPARSE_BANDS = BANDS.removeprefix(PX + ",").replace("FROM px WHERE", "FROM sp WHERE")
BANDED = "NOT restart AND step >= 4"
SCORES = f"""{SPARSE}, {OUTLINE.format("sp")}, {BINS}, {SPARSE_BANDS}, bd AS (SELECT sprite_id, count(*) AS band FROM pos WHERE {BANDED} GROUP BY 1),
    b AS (SELECT sprite_id, any_value(pack) AS pack, any_value(ol.w) AS width, 64 // any_value(ol.w) AS height,
          count(*) FILTER (outline AND idx = 1 AND pack % 2 = 1) AS black, avg(CASE WHEN idx > 0 THEN 1.0 ELSE 0.0 END) AS fill FROM ol GROUP BY 1),
    s0 AS (SELECT b.*, coalesce(len(w.p), 0) AS colors, coalesce(bd.band, 0) AS band, b.sprite_id % 17 = 0 AS is_tileset FROM b LEFT JOIN bins w ON w.sprite_id = b.sprite_id LEFT JOIN bd ON bd.sprite_id = b.sprite_id),
    s1 AS (SELECT *, 25 - CASE WHEN colors > 60 THEN least(15, (colors - 60) // 4) WHEN colors > 30 THEN 5 ELSE 0 END AS a1,
           greatest(0, 25 - CASE WHEN black > 0 THEN CAST(trunc((1.0::DOUBLE - (1.0::DOUBLE - least(1.0::DOUBLE, black / 50.0::DOUBLE))) * 10) AS INTEGER) ELSE 0 END
             - CASE WHEN band >= 2 THEN CAST(trunc(round(least(1.0::DOUBLE, band / CAST(greatest(height, 1) AS DOUBLE)), 3) * 10) AS INTEGER) ELSE 0 END) AS a2,
           greatest(0, 20 - CASE WHEN width < 8 OR height < 8 THEN 10 ELSE 0 END - CASE WHEN fill < 0.1 THEN 10 WHEN fill < 0.2 THEN 5 ELSE 0 END) AS a3,
           list_filter([CASE WHEN band >= 2 THEN 'banding_detected' END, CASE WHEN black > 0 THEN 'outline_issue' END, CASE WHEN fill < 0.1 THEN 'low_fill' END,
                        CASE WHEN colors > 30 THEN 'palette_bloat' END], lambda v: v IS NOT NULL) AS modes FROM s0),
    scores AS (SELECT sprite_id, pack, width, height, is_tileset, CASE WHEN is_tileset THEN 0 ELSE a1 + a2 + a3 + 15 END AS total_score, a1, a2, a3,
               CASE WHEN is_tileset THEN [] ELSE modes END AS modes,
               CASE WHEN is_tileset THEN 'E_tileset' WHEN a1 + a2 + a3 + 15 >= 85 THEN 'A_autopass' WHEN a1 + a2 + a3 + 15 >= 70 THEN 'B_borderline' ELSE 'C_autoreject' END AS bucket FROM s1)"""


def _slices(cell: str, width: str, least: int) -> str:
    return f"""{cell},
    box AS (SELECT sheet, row, col, avg(CASE WHEN idx > 0 THEN 0.0 ELSE 1.0 END) AS empty, min(x) FILTER (idx > 0) AS x0, max(x) FILTER (idx > 0) AS x1,
            min(y) FILTER (idx > 0) AS y0, max(y) FILTER (idx > 0) AS y1 FROM cells GROUP BY 1, 2, 3)
    SELECT sheet, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, CAST(x0 AS BIGINT) AS sheet_x, CAST(y0 AS BIGINT) AS sheet_y, CAST(x1 - x0 + 1 AS BIGINT) AS width,
           CAST(y1 - y0 + 1 AS BIGINT) AS height, row_number() OVER (PARTITION BY sheet ORDER BY row, col) - 1 AS sprite_id
    FROM box WHERE empty <= 0.95 AND x1 - x0 + 1 >= {least} AND y1 - y0 + 1 >= {least}"""


BAND_SQL = """axes AS (SELECT DISTINCT sheet, 'row' AS axis, y AS p FROM sheet_px WHERE idx > 0 UNION SELECT DISTINCT sheet, 'col', x FROM sheet_px WHERE idx > 0),
    isl AS (SELECT sheet, axis, p, p - row_number() OVER (PARTITION BY sheet, axis ORDER BY p) AS k FROM axes),
    bands AS (SELECT sheet, axis, min(p) AS start, max(p) + 1 AS "end" FROM isl GROUP BY sheet, axis, k)"""
NEAREST = ", ".join(f"({i + 1}, {r}, {g}, {b})" for i, (r, g, b) in enumerate(fx.PALETTE_15))

ORACLE_SQL: dict[str, str] = {
    "px_histogram": f"WITH {PX} SELECT CAST(idx AS BIGINT) AS idx, count(*) AS n FROM px GROUP BY 1",
    "category_distribution": f"""WITH {PX}, {OUTLINE.format("px")},
        c AS (SELECT pack, CASE WHEN idx = 0 THEN 0 WHEN outline THEN 1 ELSE 2 END AS category FROM ol)
        SELECT CAST(pack AS BIGINT) AS pack, CAST(category AS BIGINT) AS category, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER (PARTITION BY pack) AS pct FROM c GROUP BY pack, category""",
    "palette_per_sprite": f"""WITH {PX}, h AS (SELECT DISTINCT sprite_id, {HEX} AS hex FROM px WHERE idx > 0),
        a AS (SELECT sprite_id, string_agg(hex, ',' ORDER BY hex) AS palette, count(*) AS n_colors FROM h GROUP BY 1)
        SELECT e.vec_id AS sprite_id, coalesce(palette, '') AS palette, coalesce(n_colors, 0) AS n_colors FROM embeddings e LEFT JOIN a ON a.sprite_id = e.vec_id""",
    "snes_snap": """SELECT v, CAST(greatest(0, least(248, round_even(v / 8.0::DOUBLE, 0) * 8)) AS BIGINT) AS snapped
        FROM (SELECT DISTINCT CAST((p_size * 5 + p_partkey % 7) % 256 AS BIGINT) AS v FROM part) t""",
    "snes_legality": f"""WITH {PX}, {USED} SELECT CAST(pack AS BIGINT) AS pack, count(*) AS colors,
        CAST(sum(CASE WHEN r % 8 = 0 AND g % 8 = 0 AND b % 8 = 0 AND greatest(r, g, b) <= 248 THEN 1 ELSE 0 END) AS BIGINT) AS legal FROM used GROUP BY 1""",
    "luminance_hue": f"""WITH {PX}, {USED},
        h AS (SELECT *, greatest(r, g, b) AS t, CAST(greatest(r, g, b) - least(r, g, b) AS DOUBLE) AS s FROM used),
        u AS (SELECT *, CASE WHEN s = 0 THEN 0.0::DOUBLE WHEN t = r THEN 60.0::DOUBLE * fmod(fmod((g - b) / s, 6.0::DOUBLE) + 6.0::DOUBLE, 6.0::DOUBLE)
              WHEN t = g THEN 60.0::DOUBLE * ((b - r) / s + 2.0::DOUBLE) ELSE 60.0::DOUBLE * ((r - g) / s + 4.0::DOUBLE) END AS hue FROM h)
        SELECT CAST(pack AS BIGINT) AS pack, CAST(idx AS BIGINT) AS idx, round(r * 0.299::DOUBLE + g * 0.587::DOUBLE + b * 0.114::DOUBLE, 6) AS luminance, round(hue, 6) AS hue,
               round(abs(fmod(fmod(hue - 350.0::DOUBLE + 180.0::DOUBLE, 360.0::DOUBLE) + 360.0::DOUBLE, 360.0::DOUBLE) - 180.0::DOUBLE), 6) AS from_350 FROM u""",
    "aesthetic_score": f"""WITH {WORDS}, s AS (SELECT colors, doc_id, CASE WHEN colors <= 30 THEN 1.0::DOUBLE WHEN colors <= 60 THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END AS score FROM w)
        SELECT CASE WHEN doc_id % 10 = 0 THEN least(score, 0.3::DOUBLE) ELSE score END AS score, count(*) AS n, CAST(max(colors) AS BIGINT) AS most FROM s GROUP BY 1""",
    "hex_roundtrip": f"""WITH {PX} SELECT DISTINCT {HEX} AS hex, CAST(r AS BIGINT) AS r, CAST(g AS BIGINT) AS g, CAST(b AS BIGINT) AS b, CAST(r * 65536 + g * 256 + b AS BIGINT) AS packed FROM px WHERE idx > 0""",
    "nearest_palette": f"""WITH {PX}, {USED}, pal(position, pr, pg, pb) AS (VALUES {NEAREST}),
        d AS (SELECT pack, idx, position, (r - pr) * (r - pr) + (g - pg) * (g - pg) + (b - pb) * (b - pb) AS distance FROM used, pal),
        k AS (SELECT *, row_number() OVER (PARTITION BY pack, idx ORDER BY distance, position) AS rn FROM d)
        SELECT CAST(pack AS BIGINT) AS pack, CAST(idx AS BIGINT) AS idx, CAST(position AS BIGINT) AS position, CAST(distance AS BIGINT) AS distance FROM k WHERE rn = 1""",
    "index_sprites": f"""WITH {PX}, k AS (SELECT sprite_id, i, CASE WHEN idx > 0 THEN r * 65536 + g * 256 + b END AS c, {HEX} AS hex FROM px),
        p AS (SELECT sprite_id, string_agg(hex, ',' ORDER BY c) AS palette FROM (SELECT DISTINCT sprite_id, c, hex FROM k WHERE c IS NOT NULL) u GROUP BY 1),
        d AS (SELECT sprite_id, i, CASE WHEN c IS NULL THEN 0 ELSE dense_rank() OVER (PARTITION BY sprite_id ORDER BY c NULLS LAST) END AS v FROM k),
        g AS (SELECT sprite_id, string_agg(CAST(v AS VARCHAR), '' ORDER BY i) AS grid FROM d GROUP BY 1)
        SELECT g.sprite_id, coalesce(palette, '') AS palette, grid FROM g LEFT JOIN p ON p.sprite_id = g.sprite_id""",
    "index_sprites_strict": f"""WITH {PX}, s AS (SELECT sprite_id, i, idx, CAST(greatest(0, least(248, round_even(r / 8.0::DOUBLE, 0) * 8)) AS INTEGER) AS r,
            CAST(greatest(0, least(248, round_even(g / 8.0::DOUBLE, 0) * 8)) AS INTEGER) AS g, CAST(greatest(0, least(248, round_even(b / 8.0::DOUBLE, 0) * 8)) AS INTEGER) AS b FROM px),
        k AS (SELECT sprite_id, i, CASE WHEN idx > 0 THEN r * 65536 + g * 256 + b END AS c, {HEX} AS hex FROM s),
        p AS (SELECT sprite_id, string_agg(hex, ',' ORDER BY c) AS palette FROM (SELECT DISTINCT sprite_id, c, hex FROM k WHERE c IS NOT NULL) u GROUP BY 1),
        d AS (SELECT sprite_id, i, CASE WHEN c IS NULL THEN 0 ELSE dense_rank() OVER (PARTITION BY sprite_id ORDER BY c NULLS LAST) END AS v FROM k),
        g AS (SELECT sprite_id, string_agg(CAST(v AS VARCHAR), '' ORDER BY i) AS grid FROM d GROUP BY 1)
        SELECT g.sprite_id, coalesce(palette, '') AS palette, grid FROM g LEFT JOIN p ON p.sprite_id = g.sprite_id""",
    "partial_alpha": f"WITH {PX} SELECT sprite_id, count(*) FILTER (idx = 5) AS soft FROM px GROUP BY 1",
    "tileset_tags": f"""WITH {SHEET(8)}, c16 AS (SELECT sheet, y // 16 AS row, x // 16 AS col, x, y, idx FROM sheet_px WHERE sheet % 2 = 0),
        c32 AS (SELECT sheet, 0 AS row, 0 AS col, x, y, idx FROM sheet_px), b16 AS (SELECT sheet, row, col, avg(CASE WHEN idx > 0 THEN 0.0 ELSE 1.0 END) AS e, min(x) FILTER (idx > 0) AS x0, max(x) FILTER (idx > 0) AS x1,
            min(y) FILTER (idx > 0) AS y0, max(y) FILTER (idx > 0) AS y1 FROM c16 GROUP BY 1, 2, 3),
        b32 AS (SELECT sheet, row, col, avg(CASE WHEN idx > 0 THEN 0.0 ELSE 1.0 END) AS e, min(x) FILTER (idx > 0) AS x0, max(x) FILTER (idx > 0) AS x1, min(y) FILTER (idx > 0) AS y0, max(y) FILTER (idx > 0) AS y1 FROM c32 GROUP BY 1, 2, 3),
        s16 AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY row, col) - 1 AS sprite_id FROM b16 WHERE e <= 0.95 AND x1 - x0 >= 7 AND y1 - y0 >= 7),
        s32 AS (SELECT *, row_number() OVER (PARTITION BY sheet ORDER BY row, col) - 1 AS sprite_id FROM b32 WHERE e <= 0.95 AND x1 - x0 >= 7 AND y1 - y0 >= 7),
        u AS (SELECT * FROM s16 UNION ALL SELECT * FROM s32 WHERE sheet NOT IN (SELECT sheet FROM s16))
        SELECT sheet, sprite_id, CAST(x0 // 16 AS BIGINT) AS grid_x, CAST(y0 // 16 AS BIGINT) AS grid_y, CAST(x1 - x0 + 1 AS BIGINT) AS width, 'pending_spec_decision' AS edge_compatibility FROM u""",
    "hsv_darken": """WITH h AS (SELECT DISTINCT CAST(p_partkey * 7 % 360 AS DOUBLE) AS hue FROM part),
        c AS (SELECT hue, 0.5::DOUBLE AS c, 0.5::DOUBLE * (1 - abs(fmod(hue / 60.0::DOUBLE, 2.0::DOUBLE) - 1)) AS x, 0.5::DOUBLE AS m, CAST(floor(hue / 60.0::DOUBLE) AS INTEGER) AS k FROM h),
        t AS (SELECT hue, CAST(trunc((CASE k WHEN 0 THEN c WHEN 1 THEN x WHEN 4 THEN x WHEN 5 THEN c ELSE 0 END + m) * 255) AS BIGINT) AS r,
              CAST(trunc((CASE k WHEN 0 THEN x WHEN 1 THEN c WHEN 2 THEN c WHEN 3 THEN x ELSE 0 END + m) * 255) AS BIGINT) AS g,
              CAST(trunc((CASE k WHEN 2 THEN x WHEN 3 THEN c WHEN 4 THEN c WHEN 5 THEN x ELSE 0 END + m) * 255) AS BIGINT) AS b FROM c)
        SELECT hue, r, g, b, CAST(trunc(r * 0.5::DOUBLE) AS BIGINT) AS dark_r FROM t""",
    "grid_slice": f"WITH {_slices(SHEET(8) + ', cells AS (SELECT *, y // 16 AS row, x // 16 AS col FROM sheet_px WHERE x < 32 AND y < 32)', '', 8)}",
    "gutter_bands": f'WITH {SHEET(10)}, {BAND_SQL} SELECT sheet, axis, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM bands',
    "gutter_slice": "WITH " + _slices(
        f"""{SHEET(10)}, {BAND_SQL}, numbered AS (SELECT *, row_number() OVER (PARTITION BY sheet, axis ORDER BY start) - 1 AS k FROM bands),
        cells AS (SELECT p.*, r.k AS row, c.k AS col FROM sheet_px p JOIN numbered r ON r.sheet = p.sheet AND r.axis = 'row' AND p.y >= r.start AND p.y < r."end"
                  JOIN numbered c ON c.sheet = p.sheet AND c.axis = 'col' AND p.x >= c.start AND p.x < c."end")""", "", 7),
    "tight_bbox": f"WITH {SPARSE} SELECT sprite_id, CAST(min(x) AS BIGINT) AS x0, CAST(min(y) AS BIGINT) AS y0, CAST(max(x) AS BIGINT) AS x1, CAST(max(y) AS BIGINT) AS y1 FROM sp WHERE idx > 0 GROUP BY 1",
    "source_routing": """WITH s AS (SELECT p_size * 16 AS w, (p_partkey % 40 + 1) * 8 AS h FROM part)
        SELECT CASE WHEN w > 32 AND h > 32 AND w % 16 = 0 AND h % 16 = 0 THEN 'sheet' WHEN w BETWEEN 8 AND 256 AND h BETWEEN 8 AND 256 THEN 'individual' ELSE 'skipped' END AS route,
               CAST(CASE WHEN w >= 128 AND h >= 128 AND w % 32 = 0 AND h % 32 = 0 THEN 32 ELSE 16 END AS BIGINT) AS tile,
               CASE WHEN w <= 32 AND h <= 32 THEN 'whole' WHEN w % 16 = 0 AND h % 16 = 0 THEN 'grid16' ELSE 'auto16' END AS mode, count(*) AS n FROM s GROUP BY 1, 2, 3""",
    "outline_mask": f"WITH {PX}, {OUTLINE.format('px')} SELECT sprite_id, string_agg(CASE WHEN outline THEN '1' ELSE '0' END, '' ORDER BY i) AS mask FROM ol GROUP BY 1",
    "regions": f"""WITH RECURSIVE {REGIONS}, g AS (SELECT sprite_id, idx, root, count(*) AS size FROM cell WHERE idx > 0 GROUP BY 1, 2, 3)
        SELECT sprite_id, CAST(idx AS BIGINT) AS idx, CAST(root AS BIGINT) AS root, size, dense_rank() OVER (PARTITION BY sprite_id, idx ORDER BY root) - 1 AS region FROM g""",
    "classify_4": f"WITH RECURSIVE {REGIONS} SELECT CAST(pack AS BIGINT) AS pack, CAST(c4 AS BIGINT) AS category, count(*) AS n FROM cat GROUP BY 1, 2",
    "classify_5": f"WITH RECURSIVE {REGIONS} SELECT CAST(pack AS BIGINT) AS pack, CAST(c5 AS BIGINT) AS category, count(*) AS n FROM cat GROUP BY 1, 2",
    "token_sequence": f"""WITH RECURSIVE {REGIONS} SELECT sprite_id, string_agg(idx || ':' || x || ':' || y, ' ' ORDER BY CASE c4 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 0 THEN 3 ELSE 2 END, y, x) AS tokens FROM cat GROUP BY 1""",
    "category_share": f"""WITH RECURSIVE {REGIONS}, k AS (SELECT c5, count(*) AS n FROM cat GROUP BY 1)
        SELECT CAST(c5 AS BIGINT) AS category, n, CAST(n AS DOUBLE) / sum(n) OVER () AS share, CAST(n AS DOUBLE) / sum(n) OVER () < 0.03::DOUBLE AS rare FROM k""",
    "pure_black_outline": f"""WITH {PX}, {OUTLINE.format("px")} SELECT sprite_id, count(*) FILTER (outline AND r < 20 AND g < 20 AND b < 20 AND idx = 1 AND pack % 2 = 1) AS black_pixels,
        1.0::DOUBLE - least(1.0::DOUBLE, count(*) FILTER (outline AND idx = 1 AND pack % 2 = 1) / 50.0::DOUBLE) AS score FROM ol GROUP BY 1""",
    "banding_rows": f"WITH {BANDS} SELECT sprite_id, CAST(y AS BIGINT) AS y FROM pos WHERE NOT restart AND step >= 4",
    "seam_neighbours": f"""WITH {SHEET(8)}, t AS (SELECT *, y // 8 AS row, x // 8 AS col FROM sheet_px),
        m AS (SELECT a.sheet, a.row, a.col, 'left' AS side, a.idx AS own, b.idx AS other FROM t a JOIN t b ON a.sheet = b.sheet AND a.y = b.y AND b.x = a.x - 1 WHERE a.x % 8 = 0
              UNION ALL SELECT a.sheet, a.row, a.col, 'up', a.idx, b.idx FROM t a JOIN t b ON a.sheet = b.sheet AND a.x = b.x AND b.y = a.y - 1 WHERE a.y % 8 = 0)
        SELECT sheet, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, side, CAST(sum(CASE WHEN own <> other THEN 1 ELSE 0 END) AS BIGINT) AS mismatches FROM m GROUP BY 1, 2, 3, 4""",
    "orphan_pixels": f"WITH {PX}, {OUTLINE.format('px')} SELECT sprite_id, count(*) FILTER (orphan) AS orphans FROM ol GROUP BY 1",
    "reflection_zoom": f"""WITH {PX}, z AS (SELECT p.sprite_id, (2 * y + dy) * 16 + 2 * x + dx AS k, idx FROM px p, (SELECT unnest([0, 1]) AS dx) a, (SELECT unnest([0, 1]) AS dy) b),
        zz AS (SELECT sprite_id, md5(string_agg(CAST(idx AS VARCHAR), '' ORDER BY k)) AS zoomed FROM z GROUP BY 1),
        m AS (SELECT sprite_id, string_agg(CAST(idx AS VARCHAR), '' ORDER BY y, 7 - x) AS mirrored FROM px GROUP BY 1)
        SELECT m.sprite_id, mirrored, zoomed FROM m JOIN zz ON zz.sprite_id = m.sprite_id""",
    "half_consistency": f"""WITH {PX}, h AS (SELECT sprite_id, count(*) FILTER (idx > 0 AND y < 4) / 32.0::DOUBLE AS top, count(*) FILTER (idx > 0 AND y >= 4) / 32.0::DOUBLE AS low FROM px GROUP BY 1)
        SELECT *, abs(top - low) > 0.1::DOUBLE AS uneven FROM h""",
    "entropy": f"WITH {SPARSE}, {ENTROPY} SELECT vec_id AS sprite_id, round(coalesce(entropy, 0.0), 6) AS entropy FROM embeddings LEFT JOIN ent ON ent.sprite_id = vec_id",
    "artifact_reasons": f"""WITH {ARTIFACT} SELECT reason, count(*) AS n, count(*) FILTER (reason <> 'transparency') AS n_colors,
        count(*) FILTER (reason NOT IN ('transparency', 'unique_colors', 'entropy')) AS n_aspect FROM art GROUP BY 1""",
    "flagged_packs": f"""WITH {ARTIFACT}, g AS (SELECT pack, count(*) AS total, count(*) FILTER (reason <> 'keep') AS hits FROM art GROUP BY 1)
        SELECT CAST(pack AS BIGINT) AS pack, total, hits, hits / CAST(total AS DOUBLE) AS rate FROM g WHERE hits / CAST(total AS DOUBLE) > 0.5""",
    "clean_deviation": f"""WITH {ARTIFACT}, g AS (SELECT count(*) FILTER (reason <> 'keep') AS deleted, count(*) AS total FROM art),
        h AS (SELECT deleted, total, abs(deleted - total * 0.7::DOUBLE) / (total * 0.7::DOUBLE) AS off FROM g) SELECT *, off <= 0.05::DOUBLE AS within FROM h""",
    "pack_quarantine": f"""WITH {PACKS}, q AS (SELECT CASE WHEN id % 89 = 0 THEN NULL WHEN id % 101 = 0 THEN pack || id ELSE pack END AS pack FROM packs),
        t AS (SELECT pack, count(*) OVER (PARTITION BY pack) AS total, lower(pack) AS p FROM q),
        c AS (SELECT pack, CASE WHEN pack LIKE 'texture-%' OR starts_with(pack, 'texture_') THEN 'texture_packs'
            WHEN contains(p, '1-bit-pack') OR (contains(p, 'monochrome') AND contains(p, 'kenney'))
              OR p IN ('colored-transparent', 'colored-transparent_packed', 'monochrome-transparent', 'monochrome-transparent_packed')
              OR (contains(p, 'micro-roguelike') AND (contains(p, 'monochrome') OR contains(p, 'colored'))) OR regexp_matches(p, '(black|blonde|brown1|brown2|grey|red)(man|woman)\\d') THEN 'monochrome_packs'
            WHEN contains(p, '_outline') OR ends_with(p, 'outline') THEN 'outline_art' WHEN total = 1 THEN 'ui_elements' END AS quarantine FROM t)
        SELECT quarantine, count(*) AS n, count(DISTINCT pack) AS packs FROM c GROUP BY 1""",
    "format_bounds": f"""WITH {WORDS} SELECT CAST({SIZE_CLASS} AS BIGINT) AS size_class, CAST(max({BOUND}) AS BIGINT) AS bound, count(*) AS n, count(*) FILTER (colors > {BOUND}) AS suspects FROM w GROUP BY 1""",
    "size_class_stats": f"""WITH {WORDS}, s AS (SELECT {SIZE_CLASS} AS size_class, colors FROM w),
        g AS (SELECT size_class, count(*) AS n, CAST(sum(colors) AS DOUBLE) / count(*) AS mean, CAST(median(colors) AS DOUBLE) AS median, list_sort(list(colors)) AS l, CAST(max(colors) AS DOUBLE) AS max_value FROM s GROUP BY 1)
        SELECT CAST(size_class AS BIGINT) AS size_class, n, mean, median, CAST(l[CAST(floor(n * 0.95::DOUBLE) AS BIGINT) + 1] AS DOUBLE) AS p95, CAST(l[CAST(floor(n * 0.99::DOUBLE) AS BIGINT) + 1] AS DOUBLE) AS p99, max_value FROM g""",
    "running_breaker": f"""WITH {WORDS}, r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS position, sum(CASE WHEN colors > {BOUND} THEN 1 ELSE 0 END) OVER (ORDER BY doc_id) AS suspects FROM w)
        SELECT position, doc_id, CAST(suspects AS BIGINT) AS suspects FROM r WHERE suspects / CAST(position AS DOUBLE) > 0.05 ORDER BY position LIMIT 1""",
    "class_labels": f"WITH {CLASSES} SELECT sprite_class, sprite_subclass, class_confidence, class_rule_matched, count(*) AS n FROM classes GROUP BY 1, 2, 3, 4",
    "class_rollup": f"""WITH {CLASSES} SELECT sprite_class, sprite_subclass, count(*) AS n, CAST(grouping(sprite_class, sprite_subclass) AS BIGINT) AS level FROM classes GROUP BY ROLLUP (sprite_class, sprite_subclass)""",
    "unknown_drivers": f"WITH {CLASSES} SELECT pack, count(*) AS n FROM classes WHERE sprite_class IN ('unknown', 'character') GROUP BY 1 ORDER BY n DESC, pack LIMIT 20",
    "class_samples": f"WITH {CLASSES}, s AS (SELECT sprite_class, path, id, row_number() OVER (PARTITION BY sprite_class ORDER BY path, id) AS place FROM classes) SELECT * FROM s WHERE place <= 20",
    "aesthetic_styles": f"WITH {PACKS} SELECT {STYLE} AS style, count(*) AS n FROM packs GROUP BY 1",
    "index_issues": f"""WITH {PX}, s AS (SELECT sprite_id, list(idx ORDER BY i) AS grid FROM px GROUP BY 1),
        t AS (SELECT sprite_id, sprite_id % 5 = 0 AS bad, CASE WHEN sprite_id % 7 = 0 THEN grid[1:60] ELSE grid END AS grid, CASE WHEN sprite_id % 11 = 0 THEN 0 ELSE 8 END AS w FROM s),
        h AS (SELECT sprite_id, grid, CASE WHEN bad THEN 3 ELSE 5 END AS colors, list_filter([CASE WHEN w <= 0 THEN 'width' END, CASE WHEN len(grid) <> w * 8 THEN 'length' END,
              CASE WHEN bad THEN 'palette:1' END, CASE WHEN bad THEN 'palette:2' END], lambda v: v IS NOT NULL) AS head FROM t),
        x AS (SELECT sprite_id, head, list_transform(list_filter(range(len(grid)), lambda i: grid[i + 1] > colors), lambda i: 'index:' || i) AS wrong FROM h),
        y AS (SELECT sprite_id, head, CASE WHEN len(wrong) >= greatest(1, 20 - len(head)) THEN list_concat(wrong[1:greatest(1, 20 - len(head))], ['suppressed']) ELSE wrong END AS wrong FROM x)
        SELECT sprite_id, CAST(len(head) + len(wrong) AS BIGINT) AS n, list_contains(wrong, 'suppressed') AS capped, array_to_string(list_concat(head, wrong)[1:4], ',') AS first_issues FROM y""",
    "schema_gaps": "WITH k(field, m) AS (VALUES " + ", ".join(f"('{k}', {i + 2})" for i, k in enumerate(cleaning.REQUIRED)) + """)
        SELECT field, count(*) AS n FROM embeddings, k WHERE vec_id % m = 0 GROUP BY 1
        UNION ALL SELECT 'format_provenance', count(*) FROM embeddings WHERE vec_id % 4 <> 1 HAVING count(*) > 0
        UNION ALL SELECT 'format_provenance.' || f, count(*) FROM embeddings, (SELECT unnest(['native_format', 'color_count_at_ingestion']) AS f) u WHERE vec_id % 4 = 1 GROUP BY f""",
    "rubric_scores": f"""WITH {SCORES} SELECT sprite_id, CAST(pack AS BIGINT) AS pack, is_tileset, CAST(total_score AS BIGINT) AS total_score, CAST(a1 AS BIGINT) AS A1_technical, CAST(a2 AS BIGINT) AS A2_construction,
        CAST(a3 AS BIGINT) AS A3_readability, CAST(15 AS BIGINT) AS A4_animation, array_to_string(modes, ',') AS failure_modes, bucket FROM scores""",
    "bucket_counts": f"WITH {SCORES} SELECT bucket, count(*) AS n, avg(total_score) AS mean_score FROM scores GROUP BY 1",
    "rank_thresholds": f"WITH {SCORES}, {LIMITS} SELECT CAST(top5 AS BIGINT) AS top5, CAST(bottom10 AS BIGINT) AS bottom10 FROM lim",
    "anomaly_h1_h2_h3": f"""WITH {SCORES}, {LIMITS}, sh AS (SELECT *, avg(CASE WHEN bucket = 'A_autopass' THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY CASE WHEN sprite_id % 13 <> 4 THEN pack END) AS share FROM scores),
        r AS (SELECT sprite_id, bucket, CASE WHEN is_tileset THEN [] ELSE list_filter([CASE WHEN total_score >= top5 AND len(modes) > 0 THEN 'H1' END, CASE WHEN total_score <= bottom10 AND share > 0.8 THEN 'H2' END,
              CASE WHEN greatest(width, height) / CAST(greatest(least(width, height), 1) AS DOUBLE) > 4.0 THEN 'H3' END], lambda v: v IS NOT NULL) END AS reasons FROM sh, lim)
        SELECT sprite_id, array_to_string(reasons, ',') AS reasons, CASE WHEN len(reasons) > 0 THEN 'D_anomaly' ELSE bucket END AS final_bucket FROM r""",
    "review_queue": f"WITH {MANIFEST} SELECT sprite_id, CAST(total_score AS BIGINT) AS total_score FROM man WHERE bucket = 'B_borderline' AND sprite_id NOT IN (SELECT sprite_id FROM dec)",
    "curation_stats": f"""WITH {MANIFEST} SELECT bucket, count(*) AS n, count(*) - count(decision) AS remaining, count(decision) AS reviewed, count(*) FILTER (decision = 'accept') AS accepted,
        count(*) FILTER (decision = 'reject') AS rejected, count(*) FILTER (decision = 'flag_recalibration') AS flagged,
        CASE WHEN count(decision) > 0 THEN count(*) FILTER (decision = 'accept') * 100.0::DOUBLE / count(decision) END AS accept_rate FROM man LEFT JOIN dec ON dec.sprite_id = man.sprite_id GROUP BY 1""",
    "calibration_summary": f"WITH {CALIBRATED} SELECT verdict, count(*) AS n, CAST(min(total_score) AS BIGINT) AS least, CAST(max(total_score) AS BIGINT) AS most FROM cal GROUP BY 1",
    "disagreement_modes": f"""WITH {CALIBRATED}, m AS (SELECT verdict, unnest(CASE WHEN len(modes) = 0 THEN ['no_flag'] ELSE modes END) AS mode FROM cal WHERE verdict IN ('permissive', 'strict'))
        SELECT verdict, mode, count(*) AS n FROM m GROUP BY 1, 2""",
    "session_count": "SELECT count(DISTINCT substr(md5(CAST(doc_id % 97 AS VARCHAR)), 1, 8)) AS sessions, count(*) AS decisions FROM labels",
    "palette_jaccard_pairs": f"""WITH {BINS} SELECT a.sprite_id AS id_a, b.sprite_id AS id_b, round({JACCARD}, 4) AS similarity, CAST(a.pack AS BIGINT) AS pack
        FROM bins a JOIN bins b ON a.pack = b.pack AND a.sprite_id < b.sprite_id WHERE {JACCARD} >= 0.6""",
    "mean_palette_overlap": f"WITH {OVERLAP} SELECT CAST(sheet AS BIGINT) AS sheet, round(overlap, 9) AS overlap FROM ov",
    "sheet_type": f"""WITH {OVERLAP}, sz AS (SELECT sheet, count(*) AS n FROM rows0 GROUP BY 1),
        nm AS (SELECT sz.*, overlap, string_split(trim(regexp_replace([{_quoted(SHEET_NAMES)}][sz.sheet % 10 + 1], '[^a-z0-9]+', ' ', 'g')), ' ') AS t FROM sz LEFT JOIN ov ON ov.sheet = sz.sheet),
        hit AS (SELECT *, len(list_intersect(t, [{_quoted(similarity.CHARACTER_WORDS)}])) AS c, len(list_intersect(t, [{_quoted(similarity.TILESET_WORDS)}])) AS s FROM nm),
        sc AS (SELECT *, (CASE WHEN c > s THEN 2.0::DOUBLE * (c / CAST(c + s AS DOUBLE)) WHEN s > c THEN -2.0::DOUBLE * (s / CAST(c + s AS DOUBLE)) ELSE 0.0::DOUBLE END
              + CASE WHEN n >= 20 THEN -1.5::DOUBLE ELSE 0.5::DOUBLE END + CASE WHEN overlap IS NULL THEN 0.0::DOUBLE WHEN overlap >= 0.70::DOUBLE THEN 2.5::DOUBLE WHEN overlap <= 0.45::DOUBLE THEN -2.5::DOUBLE
                ELSE 2.5::DOUBLE * (2 * ((overlap - 0.45::DOUBLE) / 0.25::DOUBLE) - 1) END)
              / (CASE WHEN c + s > 0 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END + 1.5::DOUBLE + CASE WHEN overlap IS NULL THEN 0.0::DOUBLE ELSE 2.5::DOUBLE END) AS v FROM hit)
        SELECT CAST(sheet AS BIGINT) AS sheet, n, CAST(c AS BIGINT) AS char_hits, CAST(s AS BIGINT) AS tile_hits, CASE WHEN v >= 0.3 THEN 'character' WHEN v <= -0.3 THEN 'tileset' ELSE 'ambiguous' END AS sheet_type,
               round(CASE WHEN abs(v) >= 0.3 THEN least(abs(v), 1.0::DOUBLE) ELSE 1.0::DOUBLE - abs(v) / 0.3::DOUBLE END, 4) AS confidence, round(v, 4) AS normalised FROM sc""",
    "split_random": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents)
        SELECT doc_id, CASE WHEN k <= greatest(1, round_even(n * 0.1::DOUBLE, 0)) THEN 'val' ELSE 'train' END AS split FROM r""",
    "split_stratified": """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 97 = 3 THEN lang || doc_id ELSE lang END AS genre FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY genre ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER (PARTITION BY genre) AS n FROM d)
        SELECT doc_id, genre, CASE WHEN n > 1 AND k <= greatest(1, round_even(n * 0.2::DOUBLE, 0)) THEN 'val' ELSE 'train' END AS split FROM r""",
    "split_bernoulli": """SELECT CASE WHEN CAST('0x' || substr(md5('0:' || doc_id), 1, 8) AS BIGINT) % 100 < 10 THEN 'val' ELSE 'train' END AS split, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM documents GROUP BY 1""",
    "ahash": f"WITH {GRAY_HASH} SELECT vec_id, hash FROM hx",
    "hash_near_dupes": """WITH g AS (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS g FROM embeddings),
        e AS (SELECT * FROM g UNION ALL SELECT vec_id + 1000000, list_transform(range(64), lambda i: CASE WHEN i % 32 = vec_id % 32 THEN -g[i + 1] ELSE g[i + 1] END) FROM g),
        hx AS (SELECT vec_id, list_transform(range(64), lambda i: CASE WHEN g[i + 1] >= list_reduce(list_prepend(0.0::DOUBLE, g), lambda a, b: a + b) / 64 THEN 1 ELSE 0 END) AS bits FROM e),
        w AS (SELECT vec_id, CAST(list_reduce(list_transform(range(64), lambda i: CAST(bits[i + 1] AS HUGEINT) << (63 - i)), lambda a, b: a + b) AS UBIGINT) AS h FROM hx),
        p AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, CAST(bit_count(CAST(xor(a.h, b.h) AS BIT)) AS BIGINT) AS distance FROM w a JOIN w b ON a.vec_id < b.vec_id)
        SELECT * FROM p WHERE distance <= 3""",
    "md5_dupes": "SELECT substr(md5(text), 1, 16) AS hash, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1",
    "manifest_gap": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "provenance_gate": "SELECT conv_id * 3 IN (SELECT doc_id FROM documents) AS in_manifest, count(*) AS n FROM conversations GROUP BY 1",
    "license_filter": f"""WITH l AS (SELECT [{_quoted(fx.LICENSE_TEXTS)}][doc_id % 8 + 1] AS license FROM documents),
        a AS (SELECT license, lower(license) AS t FROM l)
        SELECT license, count(*) AS n, bool_and(NOT (contains(t, 'nc') OR contains(t, 'nd')) AND ({" OR ".join(f"contains(t, '{x}')" for x in provenance.ACCEPTED)})) AS accepted,
               bool_and(NOT regexp_matches(t, '(^|[^a-z])(nc|nd)([^a-z]|$)') AND ({" OR ".join(f"contains(t, '{x}')" for x in provenance.ACCEPTED)})) AS accepted_strict FROM a GROUP BY 1""",
    "license_url": f"""WITH l AS (SELECT [{_quoted(fx.LICENSE_TEXTS)}][doc_id % 8 + 1] AS license FROM documents)
        SELECT CASE WHEN contains(lower(license), 'cc0') THEN 'https://creativecommons.org/publicdomain/zero/1.0/' WHEN contains(lower(license), 'cc-by-sa') THEN 'https://creativecommons.org/licenses/by-sa/4.0/'
               WHEN contains(lower(license), 'cc-by') THEN 'https://creativecommons.org/licenses/by/4.0/' ELSE '' END AS url, count(*) AS n, count(*) FILTER (license IN ('CC0', 'CC-BY', 'CC-BY-SA')) AS verified FROM l GROUP BY 1""",
    "href_links_topn": """WITH l AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS u FROM pages),
        e AS (SELECT page_id, unnest(u) AS link, unnest(range(len(u))) AS k FROM l), f AS (SELECT page_id, link, min(k) AS k FROM e GROUP BY 1, 2),
        r AS (SELECT page_id AS id, row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS place, link FROM f) SELECT * FROM r WHERE place < 5""",
    "first_link_title": """SELECT page_id, CASE WHEN regexp_extract(html, 'href="(/[a-z]+)"', 1) <> '' THEN 'https://example.org' || regexp_extract(html, 'href="(/[a-z]+)"', 1) END AS link,
        trim(substr(regexp_replace(coalesce(nullif(trim(regexp_extract(html, '<title>([^<]*)</title>', 1)), ''), 'Unknown'), '\\s*\\|.*$', ''), 1, 40)) AS title FROM pages""",
    "slugs": """WITH p AS (SELECT page_id, url, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages)
        SELECT page_id, substr(regexp_replace(lower(url), '[^a-z0-9_]', '_', 'g'), 1, 60) AS slug, replace(replace(regexp_replace(path, '\\.[^./]*$', ''), '/', '__'), ' ', '_') AS stem,
               string_split(path, '/')[1] AS pack, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS rest FROM p""",
    "source_infos": """WITH p AS (SELECT doc_id % 6 AS k FROM documents)
        SELECT ['Kenney.nl', 'OpenGameArt (LPC)', 'Dungeon Crawl Stone Soup', 'OpenGameArt contributor', 'LPC Community', 'Unknown'][k + 1] AS creator,
               ['CC0', 'CC-BY-SA', 'CC0', 'CC0', 'CC-BY-SA', 'CC0'][k + 1] AS license,
               CASE WHEN k = 5 THEN '' WHEN k IN (1, 4) THEN 'https://creativecommons.org/licenses/by-sa/3.0/' ELSE 'https://creativecommons.org/publicdomain/zero/1.0/' END AS url, count(*) AS n FROM p GROUP BY 1, 2, 3""",
    "pack_resolution": """WITH d AS (SELECT ['kenney', 'opengameart', 'direct'][doc_id % 3 + 1] AS source, CASE WHEN doc_id % 9 = 2 THEN 'lpc_base' ELSE source END AS pack FROM documents),
        k AS (SELECT source, pack, pack IN ('src1', 'src7') AND source <> 'direct' AS hit FROM (SELECT ['kenney', 'opengameart', 'direct'][doc_id % 3 + 1] AS source, CASE WHEN doc_id % 9 = 2 THEN 'lpc_base' ELSE documents.source END AS pack FROM documents) t)
        SELECT source, CASE WHEN hit THEN 'known' WHEN source = 'kenney' THEN 'inferred' WHEN source = 'direct' AND pack = 'lpc_base' THEN 'lpc_base' WHEN source = 'opengameart' AND pack = 'src4' THEN 'searched' ELSE 'quarantine' END AS how,
               CASE WHEN hit OR source = 'kenney' OR source = 'direct' AND pack = 'lpc_base' OR source = 'opengameart' AND pack = 'src4' THEN NULL WHEN source = 'opengameart' AND pack = 'src13' THEN 'license unverifiable'
                    WHEN source = 'opengameart' AND pack = 'src10' THEN 'license not acceptable' ELSE 'no provenance' END AS reason,
               CASE WHEN hit THEN 'by ' || pack WHEN source = 'kenney' THEN 'Kenney' WHEN source = 'direct' AND pack = 'lpc_base' THEN 'LPC Community' WHEN source = 'opengameart' AND pack = 'src4' THEN 'of src4' END AS creator,
               CASE WHEN hit THEN 'CC-BY' WHEN source = 'kenney' THEN 'CC0' WHEN source = 'direct' AND pack = 'lpc_base' THEN 'CC-BY-SA' WHEN source = 'opengameart' AND pack = 'src4' THEN 'CC0' END AS license, count(*) AS n FROM k GROUP BY 1, 2, 3, 4, 5""",
    "latest_score_dedup": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) SELECT user_id, event_id, event_type, value FROM r WHERE k = 1""",
    "size_histogram": "SELECT CAST(p_size AS BIGINT) AS p_size, p_type, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY n DESC, p_size, p_type LIMIT 15",
    "golden_names": """WITH r AS (SELECT p_partkey, p_brand || '_' || p_size AS name, row_number() OVER (PARTITION BY p_brand || '_' || p_size ORDER BY p_partkey) AS k FROM part)
        SELECT p_partkey, name, CASE WHEN k = 1 THEN name ELSE name || '_' || substr(CAST(p_partkey AS VARCHAR), 1, 6) END AS golden_name FROM r""",
    "gate_summary": f"""WITH {CLASSES}, s AS (SELECT avg(CASE WHEN sprite_class = 'unknown' THEN 1.0 ELSE 0.0 END) AS unknown_rate, avg(CASE WHEN {STYLE} <> 'unknown' THEN 1.0 ELSE 0.0 END) AS style_coverage,
          count(*) FILTER (id % 1000 <> 999) / CAST(count(*) AS DOUBLE) AS score_coverage, 1.0::DOUBLE AS hash_coverage, count(*) FILTER (id % 700 = 699) AS with_gaps FROM classes),
        g AS (SELECT *, unknown_rate < 0.15 AS unknown_gate, 1 - unknown_rate >= 0.85 AS class_gate, style_coverage >= 0.70 AS style_gate, score_coverage = 1.0 AS score_gate,
              hash_coverage = 1.0 AS hash_gate, with_gaps = 0 AS schema_gate FROM s)
        SELECT *, unknown_gate AND class_gate AND style_gate AND score_gate AND hash_gate AND schema_gate AS passed FROM g""",
    "human_gate": """WITH g AS (SELECT n_chars % 4 <> 0 AS shown, CASE WHEN n_chars % 4 <> 0 THEN 85 + least(10, n_chars % 12) + least(5, n_chars % 7) END AS combined FROM documents)
        SELECT shown, coalesce(combined >= 95, FALSE) AS passed, count(*) AS n, CAST(min(combined) AS BIGINT) AS least, CAST(max(combined) AS BIGINT) AS most FROM g GROUP BY 1, 2""",
    "calibration_suggestions": f"""WITH {CALIBRATED}, m AS (SELECT verdict, unnest(CASE WHEN len(modes) = 0 THEN ['no_flag'] ELSE modes END) AS mode FROM cal WHERE verdict IN ('permissive', 'strict')),
        c AS (SELECT verdict, mode, row_number() OVER (PARTITION BY verdict ORDER BY count(*) DESC, mode) AS k FROM m GROUP BY 1, 2),
        n AS (SELECT verdict, count(*) AS n FROM cal WHERE verdict IN ('permissive', 'strict') GROUP BY 1)
        SELECT n.verdict, n, mode, CASE WHEN n.verdict = 'permissive' THEN 'tighten' ELSE 'relax' END AS action FROM n JOIN c ON c.verdict = n.verdict AND k = 1 WHERE n > 10""",
    "paginated_links": """WITH p AS (SELECT page_id // 10 AS number, page_id, CASE WHEN page_id < 80 THEN regexp_extract_all(html, 'href="([^"]*)"', 1) ELSE [] END AS u FROM pages),
        stop AS (SELECT min(number) AS stop FROM (SELECT number, sum(len(u)) AS n FROM p GROUP BY 1) t WHERE n = 0),
        e AS (SELECT number, page_id, unnest(u) AS link, unnest(range(len(u))) AS k FROM p, stop WHERE stop IS NULL OR number < stop),
        seen AS (SELECT link FROM (SELECT link, min(k) AS k FROM (SELECT unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link, unnest(range(len(regexp_extract_all(html, 'href="([^"]*)"', 1)))) AS k FROM pages WHERE page_id = 3) a GROUP BY 1) b ORDER BY k LIMIT 5),
        f AS (SELECT link, min(struct_pack(n := number, p := page_id, k := k)) AS place FROM e WHERE link NOT IN (SELECT link FROM seen) GROUP BY 1)
        SELECT link FROM f ORDER BY place, link LIMIT 40""",
    "bucket_tables": f"WITH {MANIFEST} SELECT bucket, count(*) AS n, CAST(sum(total_score) AS BIGINT) AS points FROM man GROUP BY 1",
    "hash_or_md5": f"WITH {GRAY_HASH} SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN substr(md5(CAST(vec_id AS VARCHAR)), 1, 16) ELSE hash END AS hash FROM hx",
    "listed_files": """SELECT CASE WHEN p_size % 7 = 0 THEN 'loose' ELSE p_brand END AS pack, count(*) AS n FROM part WHERE p_size % 11 <> 0 GROUP BY 1""",
    "provenance_entries": f"""WITH l AS (SELECT *, [{_quoted(fx.LICENSE_TEXTS)}][doc_id % 8 + 1] AS license FROM documents)
        SELECT CAST(doc_id AS VARCHAR) AS sprite_id, 'https://x/' || source AS source_url, license, CASE WHEN contains(lower(license), 'cc0') THEN 'https://creativecommons.org/publicdomain/zero/1.0/'
               WHEN contains(lower(license), 'cc-by-sa') THEN 'https://creativecommons.org/licenses/by-sa/4.0/' WHEN contains(lower(license), 'cc-by') THEN 'https://creativecommons.org/licenses/by/4.0/' ELSE '' END AS license_url,
               substr(md5(text), 1, 16) AS perceptual_hash, 'md5' AS hash_algo, lang AS tier, '2024-01-01T00:00:00' AS added FROM l""",
    "lock_and_phase": "SELECT count(*) FILTER (doc_id % 3 = 0) AS locked, bool_and(doc_id % 2 = 0) AND NOT bool_or(toxic = 1) AS passed FROM labels",
    "harvest_stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "ramp_compliance": f"""WITH {PX}, {USED}, u AS (SELECT DISTINCT pack, r * 65536 + g * 256 + b AS c FROM used), ramp AS (SELECT DISTINCT c FROM u WHERE pack % 3 = 0),
        o AS (SELECT pack, count(*) FILTER (c NOT IN (SELECT c FROM ramp)) AS off_ramp FROM u GROUP BY 1) SELECT CAST(pack AS BIGINT) AS pack, off_ramp, off_ramp <= 2 AS compliant FROM o""",
    "batch_pass_rate": f"""WITH {COMPLETIONS}, r AS (SELECT *, (row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) // 100 AS batch FROM done),
        g AS (SELECT lang, batch, count(*) AS n, count(*) FILTER (score >= 95) AS passed FROM r GROUP BY 1, 2) SELECT *, passed >= n * 0.99::DOUBLE AS ok FROM g""",
    "rolling_pass_rate": f"""WITH {COMPLETIONS}, r AS (SELECT *, avg(CASE WHEN score >= 95 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY lang ORDER BY doc_id) AS rate FROM done)
        SELECT lang, source, count(*) AS n, min(rate) AS least_rate FROM r WHERE score < 95 AND rate < 0.99 GROUP BY 1, 2""",
    "token_count_split": """WITH g AS (SELECT n_chars > 1500 AS long, count(*) AS n, avg(CASE WHEN n_chars % 60 >= 20 THEN 1.0 ELSE 0.0 END) AS rate FROM documents GROUP BY 1)
        SELECT *, long AND rate < 0.70 AS failed FROM g""",
    "empty_cells": f"""WITH {SHEET(8)}, c AS (SELECT sheet, k // 4 AS row, k % 4 AS col FROM (SELECT DISTINCT sheet FROM sheet_px) s, (SELECT unnest(range(16)) AS k) n),
        u AS (SELECT DISTINCT sheet, y // 8 AS row, x // 8 AS col FROM sheet_px WHERE idx > 2)
        SELECT c.sheet, CAST(c.row AS BIGINT) AS row, CAST(c.col AS BIGINT) AS col FROM c LEFT JOIN u ON u.sheet = c.sheet AND u.row = c.row AND u.col = c.col WHERE u.sheet IS NULL""",
    "weakest_in_group": f"""WITH {MANIFEST}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY total_score, sprite_id) AS k FROM man) SELECT source, sprite_id, CAST(total_score AS BIGINT) AS total_score FROM r WHERE k = 1""",
    "lpc_layout": """WITH c AS (SELECT p_partkey % 22 AS row, p_size % 13 AS frame FROM part)
        SELECT CASE WHEN row = 20 THEN 'hurt' WHEN row < 20 THEN ['cast', 'thrust', 'walk', 'slash', 'shoot'][row // 4 + 1] END AS animation,
               CASE WHEN row = 20 THEN 'S' WHEN row < 20 THEN ['N', 'W', 'S', 'E'][row % 4 + 1] END AS direction, CAST(frame AS BIGINT) AS frame, count(*) AS n FROM c GROUP BY 1, 2, 3""",
    "near_duplicate_colors": f"""WITH {PX}, {USED}, p AS (SELECT a.pack, a.idx AS idx_a, b.idx AS idx_b, (a.r - b.r) * (a.r - b.r) + (a.g - b.g) * (a.g - b.g) + (a.b - b.b) * (a.b - b.b) AS d FROM used a JOIN used b ON a.pack = b.pack AND a.idx < b.idx)
        SELECT CAST(pack AS BIGINT) AS pack, CAST(idx_a AS BIGINT) AS idx_a, CAST(idx_b AS BIGINT) AS idx_b, CAST(d AS BIGINT) AS distance_sq FROM p WHERE d < 14400""",
    "rollback_scope": """WITH f AS (SELECT o_custkey, o_orderkey % 5 AS version, max(o_orderkey % 5) OVER (PARTITION BY o_custkey) AS latest FROM orders)
        SELECT version, CASE WHEN version < latest THEN 'superseded' ELSE 'current' END AS status, count(*) AS n, count(DISTINCT o_custkey) AS characters FROM f GROUP BY 1, 2""",
    "outline_alpha": f"""WITH {PX}, faint AS (SELECT * REPLACE (CASE WHEN idx = 5 THEN 0 ELSE idx END AS idx) FROM px), {OUTLINE.format("faint")}
        SELECT sprite_id, count(*) FILTER (outline) AS outline FROM ol GROUP BY 1""",
    "training_gate": "SELECT unnest(['ready', 'no approval', 'empty manifest']) AS state, unnest([(SELECT count(*) > 0 FROM labels), FALSE, FALSE]) AS open",
    "appended_once": "SELECT source, count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents GROUP BY 1",
    "reduce_palette": f"""WITH RECURSIVE {BINS}, start AS (SELECT sprite_id, list_sort(list_transform(p, lambda v: CAST(abs(v * 70001) % 16777216 AS BIGINT))) AS p FROM bins WHERE len(p) > 15),
        {_merging("plain", "(({} + {}) // 2)")},
        {_merging("snapped", "least(248, CAST(round_even((({} + {}) // 2) / 8.0::DOUBLE, 0) AS BIGINT) * 8)")}
        SELECT s.sprite_id, CAST(len(s.p) AS BIGINT) AS colors, array_to_string(m.p, ',') AS merged, array_to_string(list_filter(n.p, lambda x, i: list_position(n.p, x) = i), ',') AS snapped
        FROM start s JOIN plain m ON m.sprite_id = s.sprite_id AND len(m.p) = 15 JOIN snapped n ON n.sprite_id = s.sprite_id AND len(n.p) = 15""",
    "rubric_dispatch": """WITH t AS (SELECT ['Character', 'enemy_idle', 'NPC', 'portrait', 'hit_effect', 'Boss', 'tileset', 'tile_16', 'parallax_far', 'Background', 'misc', 'boss_background'][p_partkey % 12 + 1] AS asset_type FROM part),
        r AS (SELECT asset_type, CASE WHEN asset_type IN ('tileset', 'tile_16') THEN 'B' WHEN asset_type IN ('parallax_far', 'Background') THEN 'C' ELSE 'A' END AS rubric, asset_type = 'hit_effect' AS is_effect FROM t)
        SELECT asset_type, rubric, is_effect, count(*) AS n, CAST(CASE rubric WHEN 'B' THEN 80 WHEN 'C' THEN 75 END AS BIGINT) AS constant_total FROM r GROUP BY 1, 2, 3""",
    "issue_modes": """WITH m(i, mode) AS (VALUES (0, 'pillow_shading_detected'), (1, 'banding_detected'), (2, 'outline_issue'), (3, 'outline_issue'), (4, 'low_fill'), (5, 'palette_bloat')),
        d AS (SELECT DISTINCT doc_id, unnest([doc_id % 8, doc_id % 5, doc_id % 3 + 5]) AS i FROM documents),
        f AS (SELECT DISTINCT doc_id, mode FROM d JOIN m ON m.i = d.i) SELECT mode, count(*) AS n FROM f GROUP BY 1""",
    "black_colors": f"""WITH {PX}, {USED} SELECT CAST(pack AS BIGINT) AS pack, count(*) AS colors, count(*) FILTER (greatest(r, g, b) < 20) AS black FROM used GROUP BY 1""",
    "sibling_meta": """WITH f AS (SELECT p_brand || '/' || p_size AS folder, p_partkey % 37 = 0 AS meta FROM part),
        h AS (SELECT folder, bool_or(meta) AS has_meta, count(*) AS k FROM f GROUP BY 1) SELECT has_meta, CAST(sum(k) AS BIGINT) AS n, count(*) AS folders FROM h GROUP BY 1""",
    "zip_by_position": """WITH a AS (SELECT c_nationkey AS sheet, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS place FROM customer),
        b AS (SELECT s_nationkey AS sheet, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS place FROM supplier)
        SELECT CAST(a.sheet AS BIGINT) AS sheet, a.place, c_custkey, s_suppkey FROM a JOIN b ON a.sheet = b.sheet AND a.place = b.place""",
    "pipeline_counters": f"""WITH {ARTIFACT} SELECT count(*) AS seen, count(*) FILTER (reason = 'keep') AS kept, count(*) FILTER (reason <> 'keep') AS removed, CAST(64 * count(*) FILTER (reason = 'keep') AS BIGINT) AS tokens, count(DISTINCT pack) AS packs FROM art""",
    "first_unscored": "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 50",
    "light_fill": f"""WITH {PX}, l AS (SELECT sprite_id, x, y, idx NOT IN (0, 5) AS seen, r * 0.299::DOUBLE + g * 0.587::DOUBLE + b * 0.114::DOUBLE AS v FROM px)
        SELECT sprite_id, avg(CASE WHEN seen THEN 1.0 ELSE 0.0 END) AS fill, round(sum(v * x) FILTER (seen) / nullif(sum(v) FILTER (seen), 0), 6) AS light_x,
               round(sum(v * y) FILTER (seen) / nullif(sum(v) FILTER (seen), 0), 6) AS light_y FROM l GROUP BY 1""",
    "batch_routing": "SELECT CAST(CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN 2 ELSE 1 END AS BIGINT) AS corpus_batch, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1",
    "kept_labels": """SELECT CASE WHEN p_size % 3 = 0 THEN p_brand ELSE lower(string_split(p_type, ' ')[1]) END AS label, p_size % 3 = 0 AS label_kept, count(*) AS n FROM part GROUP BY 1, 2""",
    "records_from_files": f"""WITH {PX}, s AS (SELECT sprite_id, any_value(pack) AS pack, list(idx ORDER BY i) AS grid FROM px GROUP BY 1)
        SELECT sprite_id, CAST(pack AS BIGINT) AS pack, CAST(CASE WHEN sprite_id % 9 <> 0 THEN 8 END AS BIGINT) AS rows, CASE WHEN sprite_id % 9 <> 0 THEN array_to_string(grid[1:8], '') END AS first_row FROM s""",
    "manifest_from_files": "SELECT doc_id % 4 <> 3 AS in_manifest, count(*) AS n FROM documents GROUP BY 1",
    "split_manifest": """WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS k, count(*) OVER () AS n FROM documents),
        s AS (SELECT doc_id, CASE WHEN k <= greatest(1, round_even(n * 0.1::DOUBLE, 0)) THEN 'val' ELSE 'train' END AS split FROM r) SELECT split, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM s GROUP BY 1""",
    "moved_packs": f"""WITH {PACKS}, t AS (SELECT pack, lower(pack) AS p FROM packs),
        c AS (SELECT starts_with(pack, 'texture-') OR starts_with(pack, 'texture_') OR contains(p, '1-bit-pack') OR (contains(p, 'monochrome') AND contains(p, 'kenney'))
              OR p IN ('colored-transparent', 'colored-transparent_packed', 'monochrome-transparent', 'monochrome-transparent_packed')
              OR (contains(p, 'micro-roguelike') AND (contains(p, 'monochrome') OR contains(p, 'colored'))) OR regexp_matches(p, '(black|blonde|brown1|brown2|grey|red)(man|woman)\\d')
              OR contains(p, '_outline') OR ends_with(p, 'outline') AS gone FROM t)
        SELECT count(*) FILTER (gone) AS moved, count(*) FILTER (NOT gone) AS left, CAST(0 AS BIGINT) AS errors FROM c""",
    "resumable_scores": """WITH s AS (SELECT event_id, 25 - CASE WHEN length(props) % 90 > 60 THEN least(15, (length(props) % 90 - 60) // 4) WHEN length(props) % 90 > 30 THEN 5 ELSE 0 END AS score FROM events)
        SELECT CAST(score AS BIGINT) AS score, count(*) AS n, count(DISTINCT event_id) AS events, TRUE AS halted FROM s GROUP BY 1""",
    "pricing_summary": """SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(sum(l_quantity), 2) AS quantity, count(*) AS n
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY 1, 2""",
}
# Fixtures have no palette beyond the target, so both variants of the merge give the same sprites.
ORACLE_SQL["index_sprites_filter"] = ORACLE_SQL["index_sprites_strict"]
