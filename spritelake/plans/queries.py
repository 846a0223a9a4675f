"""One query for each operator over the sprite-shaped views; names match the checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spritelake.functions import color, grids, kernels, rules
from spritelake.operators import banding, cleaning, indexing, provenance, raster, similarity, splits, triage
from spritelake.plans import fixtures as fx
from spritelake.session import shared_path
from spritelake.sources import files
from spritelake.streaming import harvest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query; its whole numbers come out as 64 bits."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(*(F.col(c).cast("long").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes))

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return run


def _palette(rows: DataFrame) -> DataFrame:
    """The colours that a sprite uses, sorted; a fold over its own row."""
    used = F.array_distinct(F.filter("grid", lambda v: v > 0))

    def text(v):
        def formula(t: str) -> F.Column:
            shade = (v * t[0] + F.col("pack") * t[1]) % 256
            return F.when((v == 1) & (F.col("pack") % 2 == 1), F.col("pack") * t[2] % 20).otherwise(shade)

        return color.hex_color(formula((53, 29, 1)), formula((97, 31, 3)), formula((151, 17, 7)))

    return rows.withColumn("palette", F.array_sort(F.array_distinct(F.transform(used, text))))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.sprites(spark, sf_dir).withColumn("labels", kernels.regions("grid", "width"))
    return rows.withColumn("sizes", kernels.region_sizes("labels"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, side, colors): documents as images: side by length, colours by distinct words."""
    docs = fx.table(spark, sf_dir, "documents")
    colors = F.size(F.array_distinct(F.split("text", " ")))
    return docs.select("doc_id", F.ceil(F.sqrt(F.col("n_chars").cast("double"))).cast("int").alias("side"), colors.alias("colors"))


def _black() -> F.Column:
    """Pure black outline cells: index 1 is black in every other pack."""
    cells = grids.zipped(v=F.col("grid"), edge=grids.outline(F.col("grid"), F.col("width")))
    return F.when(F.col("pack") % 2 == 1, grids.count_where(cells, lambda c: c["edge"] & (c["v"] == 1))).otherwise(0)


@query
def px_histogram(spark, sf_dir):
    return fx.pixels(fx.sprites(spark, sf_dir)).groupBy("idx").agg(F.count("*").alias("n"))


@query
def category_distribution(spark, sf_dir):
    """Transparent, outline and interior cells of each pack, with shares."""
    rows = fx.sprites(spark, sf_dir)
    cells = grids.zipped(v=F.col("grid"), edge=grids.outline(F.col("grid"), F.col("width")))
    cats = F.transform(cells, lambda c: F.when(c["v"] == 0, 0).when(c["edge"], 1).otherwise(2))
    counts = rows.select("pack", F.explode(cats).alias("category")).groupBy("pack", "category").agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("pack"))
    return counts.withColumn("pct", F.col("n") * F.lit(100.0) / whole)


@query
def palette_per_sprite(spark, sf_dir):
    rows = _palette(fx.sprites(spark, sf_dir))
    return rows.select("sprite_id", F.array_join("palette", ",").alias("palette"), F.size("palette").alias("n_colors"))


@query
def snes_snap(spark, sf_dir):
    v = (F.col("p_size") * 5 + F.col("p_partkey") % 7) % 256
    rows = fx.table(spark, sf_dir, "part").select(v.cast("long").alias("v")).distinct()
    return rows.withColumn("snapped", color.snes_snap(F.col("v")))


@query
def snes_legality(spark, sf_dir):
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("pack", "idx", "r", "g", "b").distinct()
    legal = color.snes_legal(color.hex_color(F.col("r"), F.col("g"), F.col("b")))
    return used.groupBy("pack").agg(F.count("*").alias("colors"), F.sum(F.when(legal, 1).otherwise(0)).alias("legal"))


@query
def luminance_hue(spark, sf_dir):
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("pack", "idx", "r", "g", "b").distinct()
    rgb = [F.col(c) for c in "rgb"]
    lum, hue = color.luminance(*rgb), color.hue(*rgb)
    return used.select("pack", "idx", F.round(lum, 6).alias("luminance"), F.round(hue, 6).alias("hue"), F.round(color.hue_distance(hue, F.lit(350.0)), 6).alias("from_350"))


@query
def aesthetic_score(spark, sf_dir):
    rows = _words(spark, sf_dir)
    score = color.aesthetic_score(F.col("colors"), F.col("doc_id") % 10 == 0)
    return rows.groupBy(score.alias("score")).agg(F.count("*").alias("n"), F.max("colors").alias("most"))


@query
def hex_roundtrip(spark, sf_dir):
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("r", "g", "b").distinct()
    rows = used.select(color.hex_color(F.col("r"), F.col("g"), F.col("b")).alias("hex"))
    back = [color.channel(F.col("hex"), k) for k in range(3)]
    return rows.select("hex", *(c.alias(n) for c, n in zip(back, "rgb", strict=True)), color.packed(*back).alias("packed"))


@query
def nearest_palette(spark, sf_dir):
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("pack", "idx", "r", "g", "b").distinct()
    found = used.withColumn("n", color.nearest(tuple(F.col(c) for c in "rgb"), fx.PALETTE_15))
    return found.select("pack", "idx", F.col("n.position").alias("position"), F.col("n.distance").alias("distance"))


def _alpha_pixels(spark, sf_dir) -> DataFrame:
    """Coloured pixels with an alpha: index 0 is transparent, index 5 is soft."""
    alpha = F.when(F.col("idx") == 0, 0).when(F.col("idx") == 5, 140).otherwise(255)
    return fx.pixels(fx.sprites(spark, sf_dir)).withColumn("a", alpha)


@query
def index_sprites(spark, sf_dir):
    found = indexing.index_sprites(_alpha_pixels(spark, sf_dir), "sprite_id")
    return found.select("sprite_id", F.array_join(indexing.hex_palette(F.col("palette")), ",").alias("palette"), F.array_join("index_grid", "").alias("grid"))


@query
def index_sprites_strict(spark, sf_dir):
    found = indexing.index_sprites(_alpha_pixels(spark, sf_dir), "sprite_id", strict=True)
    return found.select("sprite_id", F.array_join(indexing.hex_palette(F.col("palette")), ",").alias("palette"), F.array_join("index_grid", "").alias("grid"))


@query
def partial_alpha(spark, sf_dir):
    return indexing.partial_alpha(_alpha_pixels(spark, sf_dir), "sprite_id")


@query
def tileset_tags(spark, sf_dir):
    """Tiles of 16, and of 32 for the sheets that gave none, with their cells."""
    px = fx.sheets(spark, sf_dir, 8)
    tiles = indexing.with_retry(raster.grid_slice(px.filter("sheet % 2 = 0"), 16, 16, 32, 32), raster.grid_slice(px, 32, 32, 32, 32))
    return indexing.tile_rows(tiles, 16).select("sheet", "sprite_id", "grid_x", "grid_y", "width", "edge_compatibility")


@query
def hsv_darken(spark, sf_dir):
    h = (F.col("p_partkey") * 7 % 360).cast("double")
    rows = fx.table(spark, sf_dir, "part").select(h.alias("hue")).distinct()
    rgb = color.hsv_to_rgb(F.col("hue"), F.lit(0.5), F.lit(1.0))
    return rows.select("hue", rgb["r"].alias("r"), rgb["g"].alias("g"), rgb["b"].alias("b"), color.darkened(rgb["r"], 0.5).alias("dark_r"))


@query
def grid_slice(spark, sf_dir):
    return raster.grid_slice(fx.sheets(spark, sf_dir, 8), 16, 16, 32, 32)


@query
def gutter_bands(spark, sf_dir):
    return raster.gutter_bands(fx.sheets(spark, sf_dir, 10))


@query
def gutter_slice(spark, sf_dir):
    return raster.gutter_slice(fx.sheets(spark, sf_dir, 10), 7)


@query
def tight_bbox(spark, sf_dir):
    px = fx.pixels(fx.sparse(spark, sf_dir)).withColumn("filled", F.col("idx") > 0)
    return raster.bounding_box(px, "sprite_id")


@query
def source_routing(spark, sf_dir):
    """Route and tile sizes by made-up sizes of parts."""
    w, h = F.col("p_size") * 16, (F.col("p_partkey") % 40 + 1) * 8
    rows = fx.table(spark, sf_dir, "part").select(w.cast("int").alias("w"), h.cast("int").alias("h"))
    w, h = F.col("w"), F.col("h")
    return rows.groupBy(raster.route(w, h).alias("route"), raster.tile_size(w, h).alias("tile"), raster.slice_mode(w, h).alias("mode")).agg(F.count("*").alias("n"))


@query
def outline_mask(spark, sf_dir):
    mask = grids.outline(F.col("grid"), F.col("width"))
    return fx.sprites(spark, sf_dir).select("sprite_id", F.array_join(F.transform(mask, lambda m: F.when(m, "1").otherwise("0")), "").alias("mask"))


@query
def regions(spark, sf_dir):
    rows = _labelled(spark, sf_dir).select("sprite_id", F.explode(F.arrays_zip("grid", "labels")).alias("c"))
    found = rows.filter("c.grid > 0").groupBy("sprite_id", F.col("c.grid").alias("idx"), F.col("c.labels").alias("root")).agg(F.count("*").alias("size"))
    rank = F.dense_rank().over(Window.partitionBy("sprite_id", "idx").orderBy("root")) - 1
    return found.withColumn("region", rank)


def _classified(spark, sf_dir, five: bool) -> DataFrame:
    rows = _labelled(spark, sf_dir)
    cats = grids.categories(F.col("grid"), F.col("width"), F.col("labels"), F.col("sizes"), five)
    return rows.select("pack", F.explode(cats).alias("category")).groupBy("pack", "category").agg(F.count("*").alias("n"))


@query
def classify_4(spark, sf_dir):
    return _classified(spark, sf_dir, False)


@query
def classify_5(spark, sf_dir):
    return _classified(spark, sf_dir, True)


@query
def token_sequence(spark, sf_dir):
    rows = _labelled(spark, sf_dir)
    cats = grids.categories(F.col("grid"), F.col("width"), F.col("labels"), F.col("sizes"))
    rows = rows.withColumn("cats", cats)
    tokens = grids.sequence(F.col("grid"), F.col("width"), F.col("cats"))
    text = F.array_join(F.transform(tokens, lambda t: F.concat_ws(":", t["p"].cast("string"), t["x"].cast("string"), t["y"].cast("string"))), " ")
    return rows.select("sprite_id", text.alias("tokens"))


@query
def category_share(spark, sf_dir):
    """Categories with less than 3 % of all tokens."""
    counts = _classified(spark, sf_dir, True).groupBy("category").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return counts.select("category", "n", share.alias("share"), (share < 0.03).alias("rare"))


@query
def pure_black_outline(spark, sf_dir):
    """Pure black outline cells of each sprite; colours follow the index, so a fold is enough."""
    rows = fx.sprites(spark, sf_dir)
    rows = rows.select("sprite_id", _black().alias("black_pixels"))
    return rows.withColumn("score", color.outline_score(F.col("black_pixels")))


def _banded(spark, sf_dir, sprites=fx.sprites) -> DataFrame:
    px = fx.pixels(sprites(spark, sf_dir))
    return banding.banding_rows(px.withColumns({"r": F.expr(fx.BAND_RED), "g": F.expr(fx.BAND_GREEN), "b": F.expr(fx.BAND_RED)}))


@query
def banding_rows(spark, sf_dir):
    return _banded(spark, sf_dir)


@query
def seam_neighbours(spark, sf_dir):
    return raster.seams(fx.sheets(spark, sf_dir, 8), 8)


@query
def orphan_pixels(spark, sf_dir):
    alone = grids.orphans(F.col("grid"), F.col("width"))
    return fx.sprites(spark, sf_dir).select("sprite_id", F.size(F.filter(alone, lambda a: a)).alias("orphans"))


@query
def reflection_zoom(spark, sf_dir):
    rows = fx.sprites(spark, sf_dir)
    flat = lambda g: F.array_join(g, "")
    return rows.select("sprite_id", flat(grids.mirrored(F.col("grid"), F.col("width"))).alias("mirrored"), F.md5(flat(grids.zoomed(F.col("grid"), F.col("width"), 2)).cast("binary")).alias("zoomed"))


@query
def half_consistency(spark, sf_dir):
    """Filled share of the upper and lower halves, and whether they differ by more than a tenth."""
    n = F.size("grid")
    filled = lambda part: F.size(F.filter(part, lambda v: v > 0)) / F.size(part)
    top, low = F.slice("grid", F.lit(1), (n / 2).cast("int")), F.slice("grid", (n / 2).cast("int") + 1, (n / 2).cast("int"))
    rows = fx.sprites(spark, sf_dir).select("sprite_id", filled(top).alias("top"), filled(low).alias("low"))
    return rows.withColumn("uneven", F.abs(F.col("top") - F.col("low")) > 0.1)


@query
def entropy(spark, sf_dir):
    mixed = cleaning.entropy(F.col("grid"), F.lit(0))
    return fx.sparse(spark, sf_dir).select("sprite_id", F.round(mixed, 6).alias("entropy"))


def _artifacts(spark, sf_dir) -> DataFrame:
    rows = fx.sparse(spark, sf_dir)
    return rows.withColumn("m", cleaning.artifact(F.col("grid"), F.lit(0), F.col("width"), F.col("height")))


@query
def artifact_reasons(spark, sf_dir):
    rows = _artifacts(spark, sf_dir).groupBy(F.col("m.reason").alias("reason"))
    return rows.agg(F.count("*").alias("n"), F.count("m.unique_colors").alias("n_colors"), F.count("m.aspect_ratio").alias("n_aspect"))


@query
def flagged_packs(spark, sf_dir):
    return cleaning.flagged(_artifacts(spark, sf_dir), ["pack"], F.col("m.reason") != "keep", cleaning.FLAGGED_DELETED)


@query
def clean_deviation(spark, sf_dir):
    """Deletions against a projection, as one row."""
    gone = _artifacts(spark, sf_dir).agg(F.sum(F.when(F.col("m.reason") != "keep", 1).otherwise(0)).alias("deleted"), F.count("*").alias("total"))
    off = F.abs(F.col("deleted") - F.col("total") * 0.7) / (F.col("total") * 0.7)
    return gone.withColumns({"off": off, "within": off <= 0.05})


@query
def pack_quarantine(spark, sf_dir):
    pack = F.when(F.col("id") % 89 == 0, F.lit(None)).when(F.col("id") % 101 == 0, F.concat("pack", F.col("id").cast("string"))).otherwise(F.col("pack"))
    rows = fx.packs(spark, sf_dir).withColumn("pack", pack)
    return cleaning.quarantined(rows).groupBy("quarantine").agg(F.count("*").alias("n"), F.count_distinct("pack").alias("packs"))


@query
def format_bounds(spark, sf_dir):
    rows = _words(spark, sf_dir)
    side = F.col("side")
    return rows.groupBy(cleaning.size_class(side).alias("size_class")).agg(
        F.max(cleaning.color_bound(side)).alias("bound"), F.count("*").alias("n"),
        F.sum(F.when(cleaning.native_format(side, F.col("colors")) == "jpeg_suspect", 1).otherwise(0)).alias("suspects"),
    )


@query
def size_class_stats(spark, sf_dir):
    rows = _words(spark, sf_dir).withColumn("size_class", cleaning.size_class(F.col("side")))
    return cleaning.distribution(rows, "size_class", "colors")


@query
def running_breaker(spark, sf_dir):
    rows = _words(spark, sf_dir)
    suspect = cleaning.native_format(F.col("side"), F.col("colors")) == "jpeg_suspect"
    return cleaning.breaker(rows, "doc_id", suspect)


def _classes(spark, sf_dir) -> DataFrame:
    rows = fx.packs(spark, sf_dir)
    return rows.withColumn("c", rules.class_label(F.col("pack"), F.col("path"), F.col("has_meta")))


@query
def class_labels(spark, sf_dir):
    return _classes(spark, sf_dir).groupBy("c.sprite_class", "c.sprite_subclass", "c.class_confidence", "c.class_rule_matched").agg(F.count("*").alias("n"))


@query
def class_rollup(spark, sf_dir):
    rows = _classes(spark, sf_dir).select("c.sprite_class", "c.sprite_subclass")
    out = rows.rollup("sprite_class", "sprite_subclass").agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))
    return out


@query
def unknown_drivers(spark, sf_dir):
    rows = _classes(spark, sf_dir).filter("c.sprite_class IN ('unknown', 'character')")
    return rows.groupBy("pack").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "pack").limit(20)


@query
def class_samples(spark, sf_dir):
    """The first 20 of each class by path and id, which is the feature's limit. Spark keeps 20 rows
    of a class in each task before it shuffles (WindowGroupLimit), so a class is no task's work."""
    rows = _classes(spark, sf_dir).select(F.col("c.sprite_class").alias("sprite_class"), "path", "id")
    at = F.row_number().over(Window.partitionBy("sprite_class").orderBy("path", "id"))
    return rows.withColumn("place", at).filter("place <= 20")


@query
def aesthetic_styles(spark, sf_dir):
    return fx.packs(spark, sf_dir).groupBy(rules.aesthetic_style(F.col("pack")).alias("style")).agg(F.count("*").alias("n"))


@query
def index_issues(spark, sf_dir):
    """Sprites with faults by id: a short grid, no width, an illegal colour, indexes out of range."""
    rows = fx.sprites(spark, sf_dir)
    k = F.col("sprite_id")
    colors = F.when(k % 5 == 0, F.array(F.lit("#080808"), F.lit("#07ff00"), F.lit("zz"))).otherwise(F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: color.hex_color(i * 8, i * 16, i * 24)))
    grid = F.when(k % 7 == 0, F.slice("grid", 1, 60)).otherwise(F.col("grid"))
    width = F.when(k % 11 == 0, 0).otherwise(F.col("width"))
    issues = cleaning.index_issues(width, F.col("height"), colors, grid)
    return rows.select("sprite_id", F.size(issues).alias("n"), F.array_contains(issues, "suppressed").alias("capped"), F.array_join(F.slice(issues, 1, 4), ",").alias("first_issues"))


@query
def schema_gaps(spark, sf_dir):
    """Records as JSON without some keys, by id."""
    rows = fx.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    pairs = [F.when(F.col("id") % (i + 2) != 0, F.lit(f'"{k}":null')) for i, k in enumerate(cleaning.REQUIRED)]
    block = F.when(F.col("id") % 4 == 1, F.lit('"format_provenance":{"file_format":"png","palette_indexed":true}'))
    raw = F.concat(F.lit("{"), F.array_join(F.filter(F.array(*pairs, block), lambda p: p.isNotNull()), ","), F.lit("}"))
    gaps = rows.select(F.explode(cleaning.schema_gaps(raw)).alias("field"))
    return gaps.groupBy("field").agg(F.count("*").alias("n"))


def _scores(spark, sf_dir) -> DataFrame:
    """Rubric scores of the sparse sprites from their own detectors: distinct shades, black outline
    cells, banded rows, fill."""
    rows = fx.sparse(spark, sf_dir)
    colors = _bins(spark, sf_dir).select("sprite_id", F.size("palette").alias("colors"))
    banded = _banded(spark, sf_dir, fx.sparse).groupBy("sprite_id").agg(F.count("*").alias("band"))
    black = _black()
    fill = F.size(F.filter("grid", lambda v: v > 0)) / F.size("grid")
    rows = rows.join(colors, "sprite_id", "left").join(banded, "sprite_id", "left").withColumns({"black": black, "fill": fill})
    score = triage.rubric_a(F.coalesce("colors", F.lit(0)), F.col("black"), F.coalesce("band", F.lit(0)), F.col("width"), F.col("height"), F.col("fill"))
    rows = rows.withColumns({"s": score, "is_tileset": F.col("sprite_id") % 17 == 0})
    total = F.when(F.col("is_tileset"), 0).otherwise(F.col("s.total_score"))
    return rows.select(
        "sprite_id", "pack", "width", "height", "is_tileset", total.alias("total_score"),
        *(F.col(f"s.{p}").alias(p) for p in ("A1_technical", "A2_construction", "A3_readability", "A4_animation")),
        F.when(F.col("is_tileset"), F.array().cast("array<string>")).otherwise(F.col("s.failure_modes")).alias("failure_modes"),
        triage.bucket(total, F.col("is_tileset")).alias("bucket"),
    )


@query
def rubric_scores(spark, sf_dir):
    return _scores(spark, sf_dir).withColumn("failure_modes", F.array_join("failure_modes", ",")).drop("width", "height")


@query
def bucket_counts(spark, sf_dir):
    return _scores(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"), F.avg("total_score").alias("mean_score"))


@query
def rank_thresholds(spark, sf_dir):
    return triage.rank_thresholds(_scores(spark, sf_dir).filter("NOT is_tileset"))


@query
def anomaly_h1_h2_h3(spark, sf_dir):
    rows = _scores(spark, sf_dir).withColumn("pack", F.when(F.col("sprite_id") % 13 != 4, F.col("pack")))  # some have no pack
    found = triage.anomalies(rows)
    return found.select("sprite_id", F.array_join("reasons", ",").alias("reasons"), "final_bucket")


def _manifest(spark, sf_dir) -> DataFrame:
    """Documents as scored sprites: the score by length, the bucket by score."""
    docs = fx.table(spark, sf_dir, "documents")
    score = (F.col("n_chars") % 60 + 40).cast("int")
    modes = F.filter(F.array(F.when(F.col("n_chars") % 3 == 0, "banding_detected"), F.when(F.col("n_chars") % 4 == 0, "low_fill")), lambda m: m.isNotNull())
    rows = docs.select(F.col("doc_id").alias("sprite_id"), "source", "lang", score.alias("total_score"), modes.alias("failure_modes"), (F.col("doc_id") % 23 == 0).alias("is_tileset"))
    return rows.withColumn("bucket", triage.bucket(F.col("total_score"), F.col("is_tileset")))


@query
def review_queue(spark, sf_dir):
    return triage.review_queue(_manifest(spark, sf_dir), fx.decisions(spark, sf_dir), "B_borderline").select("sprite_id", "total_score")


@query
def curation_stats(spark, sf_dir):
    rows = _manifest(spark, sf_dir).join(fx.decisions(spark, sf_dir), "sprite_id", "left")
    hit = lambda d: F.sum(F.when(F.col("decision") == d, 1).otherwise(0))
    reviewed = F.count("decision")
    return rows.groupBy("bucket").agg(
        F.count("*").alias("n"), (F.count("*") - reviewed).alias("remaining"), reviewed.alias("reviewed"), hit("accept").alias("accepted"),
        hit("reject").alias("rejected"), hit("flag_recalibration").alias("flagged"), F.try_divide(hit("accept") * 100.0, reviewed).alias("accept_rate"),
    )


def _calibrated(spark, sf_dir) -> DataFrame:
    known = _manifest(spark, sf_dir).filter("sprite_id % 4 <> 0")
    return triage.calibration(fx.decisions(spark, sf_dir), known)


@query
def calibration_summary(spark, sf_dir):
    rows = _calibrated(spark, sf_dir)
    return rows.groupBy("verdict").agg(F.count("*").alias("n"), F.min("total_score").alias("least"), F.max("total_score").alias("most"))


@query
def disagreement_modes(spark, sf_dir):
    return triage.disagreement_modes(_calibrated(spark, sf_dir))


@query
def session_count(spark, sf_dir):
    """Distinct sessions and decisions of a log; the session is a prefix of a hash."""
    rows = fx.table(spark, sf_dir, "labels").select(F.substring(F.md5((F.col("doc_id") % 97).cast("string").cast("binary")), 1, 8).alias("session_id"))
    return rows.agg(F.count_distinct("session_id").alias("sessions"), F.count("*").alias("decisions"))


def _bins(spark, sf_dir, scale: int = 100) -> DataFrame:
    rows = fx.table(spark, sf_dir, "embeddings")
    bins = F.array_distinct(F.transform("embedding", lambda v: F.floor((v.cast("double") + 0.6) * scale).cast("int")))
    return rows.select(F.col("vec_id").alias("sprite_id"), F.col("label").alias("pack"), bins.alias("palette"))


@query
def palette_jaccard_pairs(spark, sf_dir):
    found = similarity.similar_pairs(_bins(spark, sf_dir), ["pack"])
    return found.select("id_a", "id_b", F.round("similarity", 4).alias("similarity"), "pack")


def _overlap_sheets(spark, sf_dir) -> DataFrame:
    """All sprites on sheets of growing sizes, by label and length of the id, with coarser or finer palettes."""
    rows = fx.table(spark, sf_dir, "embeddings")
    scale = F.when(F.col("label") % 3 == 0, 20).when(F.col("label") % 3 == 1, 60).otherwise(120)
    bins = F.array_distinct(F.transform("embedding", lambda v: F.floor((v.cast("double") + 0.6) * scale).cast("int")))
    return rows.select(F.col("vec_id").alias("sprite_id"), (F.col("label") * 100 + F.length(F.bin("vec_id"))).cast("long").alias("sheet"), bins.alias("palette"))


@query
def mean_palette_overlap(spark, sf_dir):
    found = similarity.mean_overlap(_overlap_sheets(spark, sf_dir))
    return found.select("sheet", F.round("overlap", 9).alias("overlap"))


SHEET_NAMES = ["hero_walk", "dungeon tiles", "sheet_a", "forest map", "enemy anim idle", "misc", "tile wall npc", "boss", "ice-lava", "x"]


@query
def sheet_type(spark, sf_dir):
    rows = _overlap_sheets(spark, sf_dir)
    sizes = rows.groupBy("sheet").agg(F.count("*").alias("n")).join(similarity.mean_overlap(rows), "sheet", "left")
    name = F.get(F.array(*map(F.lit, SHEET_NAMES)), (F.col("sheet") % 10).cast("int"))
    hits = [similarity.name_hits(name, words) for words in (similarity.CHARACTER_WORDS, similarity.TILESET_WORDS)]
    sizes = sizes.withColumns({"c": hits[0], "t": hits[1]})
    sizes = sizes.withColumn("s", similarity.sheet_type(F.col("n"), F.col("c"), F.col("t"), F.col("overlap")))
    return sizes.select("sheet", "n", F.col("c").alias("char_hits"), F.col("t").alias("tile_hits"), "s.sheet_type", "s.confidence", "s.normalised")


@query
def split_random(spark, sf_dir):
    rows = splits.split(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1)
    return rows.select("doc_id", "split")


@query
def split_stratified(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 97 == 3, F.concat("lang", F.col("doc_id").cast("string"))).otherwise(F.col("lang")).alias("genre"))
    return splits.split(docs, "doc_id", 0.2, 42, "genre").select("doc_id", "genre", "split")


@query
def split_bernoulli(spark, sf_dir):
    rows = splits.bernoulli(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")
    return rows.groupBy("split").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


def _hashes(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", grids.average_hash(F.col("embedding")).alias("hash"))


@query
def ahash(spark, sf_dir):
    return _hashes(spark, sf_dir)


@query
def hash_near_dupes(spark, sf_dir):
    """Each grid and a second one in which every 32nd cell is turned round: pairs at most three bits apart."""
    rows = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("g"))
    turned = F.transform("g", lambda v, i: F.when(i % 32 == F.col("vec_id") % 32, -v).otherwise(v))
    both = rows.union(rows.select((F.col("vec_id") + 1_000_000).alias("vec_id"), turned.alias("g")))
    return similarity.hash_pairs(both.select("vec_id", grids.average_hash(F.col("g")).alias("hash")), "vec_id", "hash", 3)


@query
def md5_dupes(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", F.substring(F.md5(F.col("text").cast("binary")), 1, 16).alias("hash"))
    return docs.groupBy("hash").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


@query
def manifest_gap(spark, sf_dir):
    return provenance.missing_from(fx.table(spark, sf_dir, "documents").select("doc_id"), fx.table(spark, sf_dir, "labels"), "doc_id")


@query
def provenance_gate(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "conversations").select((F.col("conv_id") * 3).alias("doc_id"))
    checked = provenance.in_manifest(rows, fx.table(spark, sf_dir, "documents"), "doc_id")
    return checked.groupBy("in_manifest").agg(F.count("*").alias("n"))


@query
def license_filter(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "documents").select(fx.license_text().alias("license"))
    ok = [provenance.accepted(F.col("license")), provenance.accepted(F.col("license"), strict_words=True)]
    return rows.groupBy("license").agg(F.count("*").alias("n"), F.bool_and(ok[0]).alias("accepted"), F.bool_and(ok[1]).alias("accepted_strict"))


@query
def license_url(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "documents").select(fx.license_text().alias("license"))
    return rows.groupBy(provenance.license_url(F.col("license")).alias("url")).agg(F.count("*").alias("n"), F.sum(F.when(provenance.verified(F.col("license")), 1).otherwise(0)).alias("verified"))


@query
def href_links_topn(spark, sf_dir):
    return provenance.links(fx.table(spark, sf_dir, "pages"), 5)


@query
def first_link_title(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    title = provenance.first_text(F.col("html"), [r"<h9[^>]*>([^<]*)</h9>", r"<title>([^<]*)</title>"])
    return pages.select("page_id", provenance.first_link(F.col("html"), r'href="(/[a-z]+)"', "https://example.org").alias("link"), provenance.clean_title(title).alias("title"))


@query
def slugs(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    path = F.regexp_replace("url", "^[a-z]+://", "")
    return pages.select("page_id", provenance.slug(F.col("url")).alias("slug"), provenance.safe_stem(path).alias("stem"), provenance.pack_of(path).alias("pack"), provenance.without_prefix(F.col("url"), "https://").alias("rest"))


@query
def source_infos(spark, sf_dir):
    roots = ["kenney/a", "opengameart/lpc_x", "opengameart/dungeon_crawl", "opengameart/y", "direct/z", "other/q"]
    path = F.get(F.array(*map(F.lit, roots)), (F.col("doc_id") % 6).cast("int"))
    info = provenance.source_info(path)
    names = [info[c].alias(c) for c in ("creator", "license", "url")]
    return fx.table(spark, sf_dir, "documents").groupBy(*names).agg(F.count("*").alias("n"))


@query
def pack_resolution(spark, sf_dir):
    sources = F.array(*map(F.lit, ("kenney", "opengameart", "direct")))
    docs = fx.table(spark, sf_dir, "documents").select(F.get(sources, (F.col("doc_id") % 3).cast("int")).alias("source"), F.when(F.col("doc_id") % 9 == 2, "lpc_base").otherwise(F.col("source")).alias("pack"))
    catalogue = docs.select("source", "pack").filter("pack IN ('src1', 'src7') AND source <> 'direct'").distinct()
    catalogue = catalogue.withColumns({"creator": F.concat(F.lit("by "), "pack"), "license": F.lit("CC-BY")})
    pages = docs.select("pack").filter("pack IN ('src4', 'src10', 'src13')").distinct()
    pages = pages.select("pack", F.concat(F.lit("of "), "pack").alias("creator"), F.when(F.col("pack") == "src10", "CC-BY-NC").otherwise("CC0").alias("license"), (F.col("pack") != "src13").alias("verified"))
    found = provenance.resolved_packs(docs, catalogue, pages)
    return found.groupBy("source", "how", "reason", "creator", "license").agg(F.count("*").alias("n"))


@query
def latest_score_dedup(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", F.col("ts").cast("string").alias("at"))
    found = triage.last_by_key(rows, "user_id", F.struct("at", "event_id"))
    return found.select("user_id", "event_id", "event_type", "value")


@query
def size_histogram(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "part").groupBy("p_size", "p_type").agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "p_size", "p_type").limit(15)


@query
def golden_names(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "part").select("p_partkey", F.concat("p_brand", F.lit("_"), F.col("p_size").cast("string")).alias("name"))
    return provenance.collision_names(rows, "name", "p_partkey", F.col("p_partkey"))


@query
def gate_summary(spark, sf_dir):
    """One row of all gates before training: classes, styles, scores, hashes, schema."""
    score, hashed = F.when(F.col("id") % 1000 != 999, F.col("id") % 100), F.md5(F.col("path").cast("binary"))
    raw = F.when(F.col("id") % 700 != 699, F.concat(F.lit('{"'), F.array_join(F.array(*map(F.lit, cleaning.REQUIRED)), '":1,"'), F.lit('":1,"format_provenance":{"'), F.array_join(F.array(*map(F.lit, cleaning.REQUIRED_FORMAT)), '":1,"'), F.lit('":1}}'))).otherwise("{}")
    c = _classes(spark, sf_dir).select("c.sprite_class", rules.aesthetic_style(F.col("pack")).alias("style"), score.alias("score"), hashed.alias("hash"), F.size(cleaning.schema_gaps(raw)).alias("gaps"))
    rows = c.agg(
        F.avg(F.when(F.col("sprite_class") == "unknown", 1.0).otherwise(0.0)).alias("unknown_rate"),
        F.avg(F.when(F.col("style") != "unknown", 1.0).otherwise(0.0)).alias("style_coverage"),
        (F.count("score") / F.count("*")).alias("score_coverage"), (F.count("hash") / F.count("*")).alias("hash_coverage"),
        F.sum(F.when(F.col("gaps") > 0, 1).otherwise(0)).alias("with_gaps"),
    )
    gates = {
        "unknown_gate": F.col("unknown_rate") < 0.15, "class_gate": 1 - F.col("unknown_rate") >= 0.85, "style_gate": F.col("style_coverage") >= 0.70,
        "score_gate": F.col("score_coverage") == 1.0, "hash_gate": F.col("hash_coverage") == 1.0, "schema_gate": F.col("with_gaps") == 0,
    }
    passed = F.lit(True)
    for gate in gates:
        passed &= F.col(gate)
    return rows.withColumns(gates).withColumn("passed", passed)


@query
def lock_and_phase(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "labels").select((F.col("doc_id") % 2 == 0).alias("met"), (F.col("toxic") == 1).alias("blocker"), F.col("doc_id"))
    text = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" CONFIRM LOCK "), F.col("doc_id").cast("string"))).otherwise(F.concat(F.lit("confirm lock "), F.col("doc_id").cast("string")))
    locked = rows.agg(F.sum(F.when(provenance.lock_confirmed(F.col("doc_id").cast("string"), text), 1).otherwise(0)).alias("locked"))
    return locked.crossJoin(provenance.phase_gate(rows))  # one row each


@query
def harvest_stream_dedup(spark, sf_dir):
    """The distinct user and event type of the event files, taken as a stream."""
    events = harvest.stream(spark, f"{sf_dir}/events.parquet").select("user_id", "event_type")
    return harvest.harvest(events, ["user_id", "event_type"])


@query
def ramp_compliance(spark, sf_dir):
    """Colours of each pack that no ramp has; at most two are allowed."""
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("pack", color.packed(F.col("r"), F.col("g"), F.col("b")).alias("color")).distinct()
    ramp = used.filter("pack % 3 = 0").select("color").distinct()
    off = used.join(ramp, "color", "left_anti").groupBy("pack").agg(F.count("*").alias("off_ramp"))
    packs = used.select("pack").distinct().join(off, "pack", "left").withColumn("off_ramp", F.coalesce("off_ramp", F.lit(0)))
    return packs.withColumn("compliant", F.col("off_ramp") <= 2)


def _completions(spark, sf_dir) -> DataFrame:
    """Documents as completions with a score by length: most reach 95."""
    docs = fx.table(spark, sf_dir, "documents")
    score = F.when(F.col("n_chars") % 97 == 0, F.col("n_chars") % 60 + 30).otherwise(95 + F.col("n_chars") % 6)
    return docs.select("doc_id", "lang", "source", score.alias("score"))


@query
def batch_pass_rate(spark, sf_dir):
    """Per hundred completions of a rubric (a language stands for it), whether 99 reach a score of 95."""
    return triage.batches(_completions(spark, sf_dir), ("lang",), "doc_id", F.col("score") >= 95)


@query
def rolling_pass_rate(spark, sf_dir):
    """Failures while the running pass rate of their language is below 0.99, by language and source."""
    return triage.failure_clusters(_completions(spark, sf_dir), "lang", ["lang", "source"], "doc_id", F.col("score") >= 95, 0.99)


@query
def token_count_split(spark, sf_dir):
    """Pass rates of short and long assets; the long ones fail below 0.7."""
    docs = fx.table(spark, sf_dir, "documents")
    long = F.col("n_chars") > 1500
    rates = docs.groupBy(long.alias("long")).agg(F.count("*").alias("n"), F.avg(F.when(F.col("n_chars") % 60 >= 20, 1.0).otherwise(0.0)).alias("rate"))
    return rates.withColumn("failed", F.col("long") & (F.col("rate") < 0.70))


@query
def empty_cells(spark, sf_dir):
    return raster.empty_cells(fx.sheets(spark, sf_dir, 8).withColumn("filled", F.col("idx") > 2), 8, 4, 4)


@query
def weakest_in_group(spark, sf_dir):
    rows = _manifest(spark, sf_dir)
    weakest = F.min(F.struct("total_score", "sprite_id")).alias("w")
    return rows.groupBy("source").agg(weakest).select("source", F.col("w.sprite_id").alias("sprite_id"), F.col("w.total_score").alias("total_score"))


@query
def lpc_layout(spark, sf_dir):
    x, y = F.col("p_size") % 13 * 64, F.col("p_partkey") % 22 * 64
    cell = raster.lpc_layout(x, y)
    return fx.table(spark, sf_dir, "part").groupBy(cell["animation_type"].alias("animation"), cell["pose_direction"].alias("direction"), cell["frame_index"].alias("frame")).agg(F.count("*").alias("n"))


@query
def near_duplicate_colors(spark, sf_dir):
    """Pairs of a pack's colours that differ by less than 120: few colours a pack."""
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("pack", "idx", "r", "g", "b").distinct()
    a, b = used.alias("a"), used.alias("b")
    gap = color.distance_sq(*(tuple(F.col(f"{t}.{c}") for c in "rgb") for t in "ab"))
    met = a.join(b, (F.col("a.pack") == F.col("b.pack")) & (F.col("a.idx") < F.col("b.idx")) & (gap < 120 * 120))
    return met.select(F.col("a.pack").alias("pack"), F.col("a.idx").alias("idx_a"), F.col("b.idx").alias("idx_b"), gap.alias("distance_sq"))


@query
def rollback_scope(spark, sf_dir):
    """Frames by whether their character's version is still the latest: orders as frames, customers
    as characters."""
    frames = fx.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("character"), (F.col("o_orderkey") % 5).alias("version"))
    latest = frames.groupBy("character").agg(F.max("version").alias("latest"))
    status = F.when(F.col("version") < F.col("latest"), "superseded").otherwise("current")
    return frames.join(latest, "character").groupBy("version", status.alias("status")).agg(F.count("*").alias("n"), F.count_distinct("character").alias("characters"))


@query
def outline_alpha(spark, sf_dir):
    """Outline cells where an alpha below 10 counts as transparent: index 5 is that faint."""
    rows = fx.sprites(spark, sf_dir).withColumn("a", F.transform("grid", lambda v: F.when(v == 0, 0).when(v == 5, 8).otherwise(255)))
    edge = grids.outline(grids.opaque(F.col("grid"), F.col("a"), 10), F.col("width"))
    return rows.select("sprite_id", F.size(F.filter(edge, lambda e: e)).alias("outline"))


@query
def index_sprites_filter(spark, sf_dir):
    """The filter's variant: merged colours are put on the grid each time."""
    found = indexing.index_sprites(_alpha_pixels(spark, sf_dir), "sprite_id", strict=True, resnap_each=True)
    return found.select("sprite_id", F.array_join(indexing.hex_palette(F.col("palette")), ",").alias("palette"), F.array_join("index_grid", "").alias("grid"))


@query
def training_gate(spark, sf_dir):
    """Whether training may begin, for each of three states of notes, approval and manifest."""
    listed = fx.table(spark, sf_dir, "labels").select("doc_id")
    marker = "notes\nPHASE4_ARCHITECTURE_REVIEW: APPROVED\n"
    states = [("ready", True, marker, listed), ("no approval", True, "PHASE4_ARCHITECTURE_REVIEW: PENDING", listed), ("empty manifest", True, marker, listed.limit(0))]
    rows = [F.struct(F.lit(n).alias("state"), F.lit(provenance.training_gate(m, notes, text)).alias("open")) for n, notes, text, m in states]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query
def appended_once(spark, sf_dir):
    """Manifest entries appended in two overlapping parts: a key that is there is not added again."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "source")
    path = shared_path(spark, "entries")
    for part in ("doc_id % 3 <> 0", "doc_id % 3 <> 1"):
        files.append_new(docs.filter(part), path, "doc_id")
    return spark.read.parquet(path).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))


@query
def reduce_palette(spark, sf_dir):
    """Palettes of more than 15 colours merged down, by both published variants."""
    rows = _bins(spark, sf_dir).filter(F.size("palette") > 15).withColumn("p", F.array_sort(F.transform("palette", lambda v: F.abs(v * 70001) % 16777216)))
    kept = [kernels.palette_reducer(15, each)("p") for each in (False, True)]
    return rows.select("sprite_id", F.size("p").alias("colors"), F.array_join(kept[0], ",").alias("merged"), F.array_join(kept[1], ",").alias("snapped"))


@query
def human_gate(spark, sf_dir):
    """Automated and human points together, by outcome."""
    docs = fx.table(spark, sf_dir, "documents")
    n = F.col("n_chars")
    gate = triage.human_gate(F.when(n % 4 == 0, 80).otherwise(85), n % 12, n % 7)
    return docs.select(gate.alias("g")).groupBy("g.shown", "g.passed").agg(F.count("*").alias("n"), F.min("g.combined").alias("least"), F.max("g.combined").alias("most"))


@query
def calibration_suggestions(spark, sf_dir):
    return triage.suggestions(_calibrated(spark, sf_dir))


@query
def paginated_links(spark, sf_dir):
    """The first 40 new links of a listing of ten pages each; the ninth and later lists are empty."""
    pages = fx.table(spark, sf_dir, "pages").withColumn("html", F.when(F.col("page_id") < 80, F.col("html")).otherwise(""))
    seen = provenance.links(pages.filter("page_id = 3"), 5).select("link")
    return provenance.listing(pages, F.floor(F.col("page_id") / 10), 40, seen)


@query
def bucket_tables(spark, sf_dir):
    """Scores written to a folder for each bucket and read back from there."""
    path = shared_path(spark, "buckets")
    files.append(_manifest(spark, sf_dir).select("sprite_id", "total_score", "bucket"), path, ["bucket"])
    return spark.read.parquet(path).groupBy("bucket").agg(F.count("*").alias("n"), F.sum("total_score").alias("points"))


@query
def hash_or_md5(spark, sf_dir):
    """The average hash of whole grids, else a part of a digest."""
    rows = fx.table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 10 == 0, F.slice("embedding", 1, 32)).otherwise(F.col("embedding")).alias("g"))
    digest = F.substring(F.md5(F.col("vec_id").cast("string").cast("binary")), 1, 16)
    return rows.select("vec_id", F.when(F.size("g") == 64, grids.average_hash(F.col("g"))).otherwise(digest).alias("hash"))


@query
def listed_files(spark, sf_dir):
    """A list of paths written beforehand, read with blanks and empty lines dropped, by pack; bare
    names belong to a parent."""
    path = shared_path(spark, "listed")
    name = F.when(F.col("p_size") % 11 == 0, "").when(F.col("p_size") % 7 == 0, F.concat(F.lit(" "), "p_partkey", F.lit(".png "))).otherwise(F.concat_ws("/", "p_brand", F.concat("p_partkey", F.lit(".png"))))
    fx.table(spark, sf_dir, "part").select(name).write.text(path)
    found = files.listed_paths(spark, path)
    return found.groupBy(provenance.pack_of(F.col("path"), F.lit("loose")).alias("pack")).agg(F.count("*").alias("n"))


@query
def provenance_entries(spark, sf_dir):
    """Manifest entries with licence addresses and named hash algorithms."""
    docs = fx.table(spark, sf_dir, "documents")
    entry = indexing.provenance_entry(F.col("doc_id").cast("string"), F.concat(F.lit("https://x/"), "source"), F.col("source"), fx.license_text(), F.substring(F.md5(F.col("text").cast("binary")), 1, 16), "md5", F.col("lang"), F.lit("2024-01-01 00:00:00"))
    rows = docs.select(entry.alias("e")).select("e.sprite_id", "e.source_url", "e.license", "e.license_url", "e.perceptual_hash", "e.hash_algo", "e.tier", F.date_format("e.date_added", "yyyy-MM-dd'T'HH:mm:ss").alias("added"))
    return rows


@query
def rubric_dispatch(spark, sf_dir):
    """Asset types by the rubric that scores them, with the constants of rubrics B and C."""
    names = ["Character", "enemy_idle", "NPC", "portrait", "hit_effect", "Boss", "tileset", "tile_16", "parallax_far", "Background", "misc", "boss_background"]
    kind = F.get(F.array(*map(F.lit, names)), (F.col("p_partkey") % len(names)).cast("int"))
    rows = fx.table(spark, sf_dir, "part").select(kind.alias("asset_type"), rules.asset_rubric(kind).alias("r"))
    total = F.when(F.col("r.rubric") == "B", triage.constant_rubric("B")["total_score"]).when(F.col("r.rubric") == "C", triage.constant_rubric("C")["total_score"])
    return rows.groupBy("asset_type", "r.rubric", "r.is_effect").agg(F.count("*").alias("n"), F.max(total).alias("constant_total"))


@query
def issue_modes(spark, sf_dir):
    """Failure modes by the wording of issue texts."""
    texts = ["Pillow shading near the rim", "colour BANDING in rows 3-5", "too many black pixels", "Outline broken", "sparse silhouette", "palette has 45 colors", "palette is fine", "seam"]
    some = F.array(*map(F.lit, texts))
    k = F.col("doc_id")
    issues = F.array(F.get(some, (k % 8).cast("int")), F.get(some, (k % 5).cast("int")), F.get(some, (k % 3 + 5).cast("int")))
    rows = fx.table(spark, sf_dir, "documents").select(F.explode(triage.failure_modes(issues)).alias("mode"))
    return rows.groupBy("mode").agg(F.count("*").alias("n"))


@query
def black_colors(spark, sf_dir):
    """Colours of which every channel is below 20."""
    used = fx.pixels(fx.sprites(spark, sf_dir)).filter("idx > 0").select("pack", "idx", "r", "g", "b").distinct()
    return used.groupBy("pack").agg(F.count("*").alias("colors"), F.sum(F.when(color.pure_black(F.col("r"), F.col("g"), F.col("b")), 1).otherwise(0)).alias("black"))


@query
def sibling_meta(spark, sf_dir):
    """Files whose folder also has a tileset_meta file: a join with the folders that have one."""
    folder = F.concat_ws("/", "p_brand", F.col("p_size").cast("string"))
    name = F.when(F.col("p_partkey") % 37 == 0, "tileset_meta.json").otherwise(F.concat("p_partkey", F.lit(".png")))
    files = fx.table(spark, sf_dir, "part").select(folder.alias("folder"), name.alias("name"))
    return provenance.with_sibling(files, "folder", F.col("name") == "tileset_meta.json", "has_meta").groupBy("has_meta").agg(F.count("*").alias("n"), F.count_distinct("folder").alias("folders"))


@query
def zip_by_position(spark, sf_dir):
    """Manifest rows and files of a sheet by their places: customers and suppliers of a nation."""
    rows = fx.table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("sheet"), "c_custkey")
    files = fx.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("sheet"), "s_suppkey")
    return provenance.zipped(rows, files, "sheet", "c_custkey", "s_suppkey").select("sheet", "place", "c_custkey", "s_suppkey")


@query
def pipeline_counters(spark, sf_dir):
    """One row of counters over a pass."""
    rows = _artifacts(spark, sf_dir)
    kept = F.col("m.reason") == "keep"
    return rows.agg(
        F.count("*").alias("seen"), F.sum(F.when(kept, 1).otherwise(0)).alias("kept"), F.sum(F.when(~kept, 1).otherwise(0)).alias("removed"),
        F.sum(F.when(kept, F.size("grid")).otherwise(0)).alias("tokens"), F.count_distinct("pack").alias("packs"),
    )


@query
def first_unscored(spark, sf_dir):
    """The first 50 that have no score, by id: the limit is the feature."""
    found = provenance.missing_from(fx.table(spark, sf_dir, "documents").select("doc_id"), fx.table(spark, sf_dir, "labels"), "doc_id")
    return found.orderBy("doc_id").limit(50)


@query
def light_fill(spark, sf_dir):
    """Fill of each sprite by alpha above 10, and the mean place of its light, if it has any."""
    px = fx.pixels(fx.sprites(spark, sf_dir)).withColumn("a", F.when(F.col("idx") == 0, 0).when(F.col("idx") == 5, 8).otherwise(255))
    return indexing.light_fill(px, "sprite_id").select("sprite_id", "fill", F.round("light_x", 6).alias("light_x"), F.round("light_y", 6).alias("light_y"))


@query
def batch_routing(spark, sf_dir):
    """Rows by the corpus batch that they are routed to: those harvested from a day on are the second."""
    day = F.to_date("ts")
    rows = fx.table(spark, sf_dir, "events").withColumn("corpus_batch", splits.corpus_batch(day, "2024-01-15"))
    return rows.groupBy("corpus_batch").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query
def kept_labels(spark, sf_dir):
    """Labels that are there are kept and still counted; the others are computed."""
    rows = fx.table(spark, sf_dir, "part").select(F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).alias("label"), "p_type")
    done = indexing.fill_missing(rows, "label", F.lower(F.split("p_type", " ")[0]))
    return done.groupBy("label", "label_kept").agg(F.count("*").alias("n"))


@query
def records_from_files(spark, sf_dir):
    """Sprites written as a record a line, read back with their schema, grids checked and rebuilt in rows."""
    rows = fx.sprites(spark, sf_dir).select("sprite_id", "pack", "width", "height", F.when(F.col("sprite_id") % 9 == 0, F.slice("grid", 1, 60)).otherwise(F.col("grid")).alias("grid"))
    path = shared_path(spark, "records")
    files.append(rows, path, as_json=True)
    back = files.json_lines(spark, path, rows.schema)
    whole = grids.rows_of(F.col("grid"), F.col("width"))
    return back.select("sprite_id", "pack", F.size(whole).alias("rows"), F.array_join(F.transform(F.get(whole, 0), lambda v: v.cast("string")), "").alias("first_row"))


@query
def manifest_from_files(spark, sf_dir):
    """Manifests of three shapes written as JSON documents, and a missing one: what is known."""
    docs = fx.table(spark, sf_dir, "documents").select("doc_id")
    rows = docs.select("doc_id", F.concat(F.lit('s"'), F.col("doc_id").cast("string")).alias("sprite_id"))
    found = files.manifest_ids(spark, shared_path(spark, "nowhere"))
    for k, shape in enumerate(("records", "ids", "keyed")):
        path = shared_path(spark, "manifest")
        files.write_documents(rows.filter(F.col("doc_id") % 4 == k), path, "sprite_id", shape)
        found = found.unionByName(files.manifest_ids(spark, path))
    return provenance.in_manifest(rows, found.withColumnRenamed("id", "sprite_id"), "sprite_id").groupBy("in_manifest").agg(F.count("*").alias("n"))


@query
def split_manifest(spark, sf_dir):
    """Splits written as a manifest for each split and loaded again, checked."""
    rows = splits.split(fx.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.1).select("doc_id", "split")
    path = shared_path(spark, "splits")
    files.write_split_manifest(rows, path, "doc_id")
    both = [files.load_split(spark, path, name, "doc_id").withColumn("split", F.lit(name)) for name in ("train", "val")]
    return both[0].unionByName(both[1]).groupBy("split").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query
def moved_packs(spark, sf_dir):
    """Quarantined rows moved to a folder of their own, verified, and what is left of the corpus."""
    rows = fx.packs(spark, sf_dir).select("id", "pack")
    gone = cleaning.quarantine(F.col("pack"), F.lit(2)).isNotNull()
    path = shared_path(spark, "quarantine")
    moved = files.verified_move(rows.filter(gone), path)
    rest = rows.join(spark.read.parquet(path).select("id"), "id", "left_anti")
    left = rest.agg(F.count("*").alias("left"))
    return left.select(F.lit(moved.rows).alias("moved"), "left", F.lit(len(moved.errors)).alias("errors"))


@query
def resumable_scores(spark, sf_dir):
    """Scores of a stream in micro-batches; a second run after the first finds nothing new, and an
    emergency halt stops before a batch."""
    out, known = shared_path(spark, "scores"), shared_path(spark, "scored")

    def process(df, number: int) -> None:
        score = triage.technical(F.length("props") % 90)
        df.select("event_id", score.alias("score")).write.mode("append").parquet(out)

    for k in range(2):
        source = harvest.stream(spark, f"{sf_dir}/events.parquet").select("event_id", "props")
        harvest.each_batch(source, "event_id", known, shared_path(spark, f"state{k}"), process).awaitTermination()
    halt = shared_path(spark, "HALT")
    spark.range(1).write.parquet(halt)
    query = harvest.each_batch(harvest.stream(spark, f"{sf_dir}/events.parquet").select("event_id", "props"), "event_id", known, shared_path(spark, "state2"), process, harvest.halt_file(spark, halt))
    halted = harvest.was_halted(query)
    done = spark.read.parquet(out)
    return done.groupBy("score").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events")).withColumn("halted", F.lit(halted))


@query
def pricing_summary(spark, sf_dir):
    """An extension over the relational tables: the usual aggregate of line items."""
    rows = fx.table(spark, sf_dir, "lineitem").filter("l_shipdate <= timestamp_ntz '1998-09-02 00:00:00'")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum(price), 2).alias("revenue"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.count("*").alias("n"))
