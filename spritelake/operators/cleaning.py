"""Cleaning, format integrity, class labels and schema checks. Every pass marks rows and drops
none: what is kept, rejected or quarantined is a filter on the marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spritelake.functions.rules import first_match, let
from spritelake.operators import ordering

MOST_TRANSPARENT = 0.80
LEAST_COLORS = 2
LEAST_ENTROPY = 0.5
WIDEST, NARROWEST = 4.0, 0.25
FLAGGED_SUSPECT, FLAGGED_DELETED = 0.20, 0.50
BREAKER = 0.05

# Largest side of a size class and the most colours that it should have.
COLOR_BOUNDS = [(16, 64), (32, 128), (48, 192), (64, 256), (96, 384), (128, 512)]
COLOR_CAP = 512

# Keys that every sprite record must have.
REQUIRED = [
    "sprite_id", "width", "height", "palette", "index_grid", "transparent_index", "sprite_class", "sprite_subclass", "class_confidence",
    "class_rule_matched", "aesthetic_style", "aesthetic_subclass", "animation_id", "frame_index", "frame_count", "animation_type", "pose_direction",
    "view_angle", "rubric_score", "rubric_bucket", "perceptual_hash",
]
REQUIRED_FORMAT = [
    "file_format", "native_format", "color_count_at_ingestion", "palette_indexed",
]


def transparency(grid: Column, transparent: Column) -> Column:
    """Share of cells with the transparent index; 0 where that index is null."""
    hits = F.size(F.filter(grid, lambda v: v == transparent))
    return F.coalesce(F.try_divide(hits.cast("double"), F.size(grid)), F.lit(0.0))


def unique_colors(grid: Column, transparent: Column) -> Column:
    return F.size(F.filter(F.array_distinct(grid), lambda v: ~v.eqNullSafe(transparent)))


def entropy(grid: Column, transparent: Column) -> Column:
    """Shannon entropy (base 2) of the cells that are not transparent; 0 where there is none."""
    cells = F.filter(grid, lambda v: ~v.eqNullSafe(transparent))

    def share(u):
        return F.size(F.filter(cells, lambda v: v == u)) / F.size(cells)

    terms = F.transform(F.sort_array(F.array_distinct(cells)), lambda u: -share(u) * F.log2(share(u)))
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def artifact(grid: Column, transparent: Column, width: Column, height: Column) -> Column:
    """A struct (reason, metrics): the first test that fails, and metrics up to it."""
    empty, colors = transparency(grid, transparent), unique_colors(grid, transparent)
    mixed, aspect = entropy(grid, transparent), width / height
    tests = [
        ("transparency", empty > MOST_TRANSPARENT), ("unique_colors", colors < LEAST_COLORS), ("entropy", mixed < LEAST_ENTROPY),
        ("aspect_wide", aspect > WIDEST), ("aspect_tall", aspect < NARROWEST),
    ]
    reason = first_match([(test, F.lit(name)) for name, test in tests], F.lit("keep"))

    def reached(*stops: str) -> Column:
        return ~reason.isin(*stops)

    return F.struct(
        reason.alias("reason"), empty.alias("transparency_ratio"),
        F.when(reached("transparency"), colors).alias("unique_colors"),
        F.when(reached("transparency", "unique_colors"), mixed).alias("entropy"),
        F.when(reached("transparency", "unique_colors", "entropy"), aspect).alias("aspect_ratio"),
    )


def quarantine(pack: Column, pack_total: Column) -> Column:
    """Category of a pack that is set aside, or null; the first that fits."""
    # The parts of pack names that decide.
    low = F.lower(pack)
    texture = pack.startswith("texture-") | pack.startswith("texture_")
    monochrome = (
        low.contains("1-bit-pack")
        | (low.contains("monochrome") & low.contains("kenney"))
        | low.isin("colored-transparent", "colored-transparent_packed", "monochrome-transparent", "monochrome-transparent_packed")
        | (low.contains("micro-roguelike") & (low.contains("monochrome") | low.contains("colored")))
        | low.rlike(r"(black|blonde|brown1|brown2|grey|red)(man|woman)\d")
    )
    rules = [
        (texture, F.lit("texture_packs")), (monochrome, F.lit("monochrome_packs")),
        (low.contains("_outline") | low.endswith("outline"), F.lit("outline_art")), (pack_total == 1, F.lit("ui_elements")),
    ]
    return first_match(rules, F.lit(None).cast("string"))


def quarantined(sprites: DataFrame, pack_col: str = "pack") -> DataFrame:
    """``sprites`` with pack_total and quarantine. Packs are counted by a group-by that combines
    before it shuffles and joined back, so a large pack is no single task's window."""
    totals = sprites.groupBy(F.col(pack_col).alias("__pack")).agg(F.count("*").alias("pack_total"))
    rows = sprites.join(totals, F.col(pack_col).eqNullSafe(F.col("__pack"))).drop("__pack")  # a null pack is a pack
    return rows.withColumn("quarantine", quarantine(F.col(pack_col), F.col("pack_total")))


def flagged(sprites: DataFrame, keys: list[str], flag: Column, over: float) -> DataFrame:
    """(keys, total, hits, rate) of the groups in which more than a share ``over`` is flagged."""
    groups = sprites.groupBy(*keys).agg(F.count("*").alias("total"), F.sum(F.when(flag, 1).otherwise(0)).alias("hits"))
    return groups.withColumn("rate", F.col("hits") / F.col("total")).filter(F.col("rate") > over)


def size_class(side: Column) -> Column:
    return first_match([(side <= most, F.lit(most)) for most, _ in COLOR_BOUNDS], F.lit(129))


def color_bound(side: Column) -> Column:
    return first_match([(side <= most, F.lit(colors)) for most, colors in COLOR_BOUNDS], F.lit(COLOR_CAP))


def native_format(side: Column, colors: Column) -> Column:
    return F.when(colors < 0, "unknown").when(colors > color_bound(side), "jpeg_suspect").otherwise("png")


def distribution(rows: DataFrame, key: str, value: str) -> DataFrame:
    """n, mean, median, p95, p99 (the element at floor(n * q) in rising order) and max by key.

    Values are counted first, so the order statistics come from running counts over distinct
    values: no group's values are collected."""
    counts = rows.groupBy(key, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(key)
    running = counts.withColumns({
        "upto": F.sum("c").over(w.orderBy(value)), "n": F.sum("c").over(w),
    })

    def element(k: Column) -> Column:
        return F.min(F.when(F.col("upto") > k, F.col(value))).cast("double")

    n = F.col("n")
    return running.groupBy(key).agg(
        F.max("n").alias("n"), (F.sum(F.col(value) * F.col("c")) / F.max("n")).alias("mean"),
        ((element(F.floor((n - 1) / 2)) + element(F.floor(n / 2))) / 2).alias("median"),
        element(F.floor(n * 0.95)).alias("p95"), element(F.floor(n * 0.99)).alias("p99"), F.max(value).cast("double").alias("max_value"),
    )


def breaker(rows: DataFrame, order: str, suspect: Column, range_rows: int = ordering.RANGE_ROWS, over: float = BREAKER) -> DataFrame:
    """(position, order, suspects): the first row, by ``order``, at which more than a share ``over``
    of the rows so far is suspect; by two levels of running sums."""
    at = ordering.running(rows.select(order, suspect.alias("__suspect")), [order], {"suspects": F.col("__suspect").cast("int")}, range_rows=range_rows)
    at = at.select(F.col("place").alias("position"), order, "suspects")
    return at.filter(F.col("suspects") / F.col("position") > over).orderBy("position").limit(1)


def schema_gaps(raw: Column) -> Column:
    """Names of required keys that a JSON record lacks; null is a value, absence is not. A record is
    made up once and its keys are read once, not for each name."""

    def lacking(names: list[str], keys: Column) -> Column:
        return F.coalesce(F.array_except(F.array(*map(F.lit, names)), keys), F.array().cast("array<string>"))

    def gaps(record: Column, block: Column) -> Column:
        nested = F.transform(lacking(REQUIRED_FORMAT, F.json_object_keys(block)), lambda k: F.concat(F.lit("format_provenance."), k))
        return F.concat(lacking(REQUIRED, F.json_object_keys(record)), F.when(block.isNull(), F.array(F.lit("format_provenance"))).otherwise(nested))

    return let(raw, lambda record: let(F.get_json_object(record, "$.format_provenance"), lambda block: gaps(record, block)))


def index_issues(width: Column, height: Column, palette: Column, grid: Column) -> Column:
    """What is wrong with an indexed sprite, as codes; index errors stop after 20 issues with one
    line that says so."""
    from spritelake.functions.color import snes_legal

    head = F.filter(
        F.array(
            F.when(F.coalesce(width, F.lit(0)) <= 0, "width"), F.when(F.coalesce(height, F.lit(0)) <= 0, "height"),
            F.when(F.size(grid) != width * height, "length"), F.when(F.size(palette) > 15, "colors"),
        ),
        lambda m: m.isNotNull(),
    )
    illegal = F.filter(F.transform(palette, lambda c, i: F.when(~snes_legal(c), F.concat(F.lit("palette:"), i.cast("string")))), lambda m: m.isNotNull())
    head = F.concat(head, illegal)
    wrong = F.transform(grid, lambda v, i: F.when((v < 0) | (v > F.size(palette)), F.concat(F.lit("index:"), i.cast("string"))))
    wrong = F.filter(wrong, lambda m: m.isNotNull())
    room = F.greatest(F.lit(1), F.lit(20) - F.size(head))
    capped = F.when(F.size(wrong) >= room, F.concat(F.slice(wrong, F.lit(1), room), F.array(F.lit("suppressed")))).otherwise(wrong)
    return F.concat(head, capped)
