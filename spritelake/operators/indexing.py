"""From coloured pixels to indexed sprites, tile rows and provenance entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spritelake.functions import color, kernels

OPAQUE = 128


def palettes(px: DataFrame, key: str, snap: bool = False) -> DataFrame:
    """(key, palette): sorted distinct packed colours of the opaque pixels. Distinct colours are
    found before anything is collected, so what meets is a palette, not a sprite's pixels."""
    rgb = [color.snes_snap(F.col(c)) if snap else F.col(c) for c in "rgb"]
    used = px.filter(F.col("a") >= OPAQUE).select(key, color.packed(*rgb).alias("c")).distinct()
    return used.groupBy(key).agg(F.array_sort(F.collect_list("c")).alias("palette"))


def hex_palette(palette: Column) -> Column:
    return F.transform(palette, lambda c: color.hex_color(F.floor(c / 65536), F.floor(c / 256) % 256, c % 256))


def index_sprites(px: DataFrame, key: str, strict: bool = False, resnap_each: bool = False) -> DataFrame:
    """(key, palette, index_grid): each pixel (key, x, y, r, g, b, a) as its colour's 1-based place
    in the sprite's palette, 0 if it is transparent; in rows, left to right.

    ``strict`` puts colours on the 15-bit grid, merges a palette of more than 15 down to that, and
    gives each pixel the nearest colour that is left; ``resnap_each`` is the filter's variant of
    the merge, else the merged palette is put on the grid once."""
    found = palettes(px, key, strict)
    if strict:
        large = F.size("palette") > color.SNES_COLORS
        merged = kernels.palette_reducer(color.SNES_COLORS, resnap_each)("palette")
        small, big = found.filter(~large), found.filter(large).withColumn("palette", merged)
        if not resnap_each:
            snapped = F.transform("palette", lambda c: color.packed(*(color.snes_snap(v) for v in (F.floor(c / 65536), F.floor(c / 256) % 256, c % 256))))
            big = big.withColumn("palette", F.array_distinct(snapped))
        found = small.union(big)
    rows = px.join(found, key, "left")
    own = [F.col(c) for c in "rgb"]
    if strict:
        own = [color.snes_snap(c) for c in own]

        def candidate(c, i):
            other = (F.floor(c / 65536), F.floor(c / 256) % 256, c % 256)
            return F.struct(color.distance_sq(tuple(own), other).alias("d"), (i + 1).alias("i"))

        place = F.array_min(F.transform("palette", candidate))["i"]
    else:
        place = F.array_position("palette", color.packed(*own))
    cell = F.when(F.col("a") >= OPAQUE, place.cast("int")).otherwise(0)
    grid = F.array_sort(F.collect_list(F.struct("y", "x", cell.alias("v"))))
    out = rows.groupBy(key).agg(F.coalesce(F.first("palette"), F.array().cast("array<int>")).alias("palette"), grid.alias("g"))
    return out.select(key, "palette", F.transform("g", lambda c: c["v"]).alias("index_grid"))


def partial_alpha(px: DataFrame, key: str) -> DataFrame:
    """(key, soft): how many pixels are neither opaque nor transparent."""
    return px.groupBy(key).agg(F.sum(F.when((F.col("a") > 0) & (F.col("a") < 255), 1).otherwise(0)).alias("soft"))


def light_fill(px: DataFrame, key: str, alpha_over: int = 10) -> DataFrame:
    """(key, fill, light_x, light_y): the share of pixels whose alpha is above a bound, and their
    centre weighted by brightness; null where nothing shines."""
    seen = F.col("a") > alpha_over
    shine = F.when(seen, color.luminance(F.col("r"), F.col("g"), F.col("b"))).otherwise(0.0)
    sums = px.groupBy(key).agg(
        F.avg(F.when(seen, 1.0).otherwise(0.0)).alias("fill"), F.sum(shine).alias("__l"), F.sum(shine * F.col("x")).alias("__x"), F.sum(shine * F.col("y")).alias("__y")
    )
    return sums.select(key, "fill", F.try_divide("__x", "__l").alias("light_x"), F.try_divide("__y", "__l").alias("light_y"))


def tile_rows(tiles: DataFrame, tile: int) -> DataFrame:
    """Slices of a tileset with their cells and fixed tags."""
    return tiles.select(
        "*", F.floor(F.col("sheet_x") / tile).alias("grid_x"), F.floor(F.col("sheet_y") / tile).alias("grid_y"),
        F.lit("tileset").alias("sheet_type"), F.lit("skipped").alias("pair_detection"), F.lit("pending_spec_decision").alias("edge_compatibility"),
    )


def with_retry(first: DataFrame, second: DataFrame, key: str = "sheet") -> DataFrame:
    """``first``, and ``second`` for the sheets that gave nothing."""
    return first.unionByName(second.join(first.select(key).distinct(), key, "left_anti"))


def fill_missing(rows: DataFrame, name: str, computed: Column) -> DataFrame:
    """``rows`` with ``name`` computed where it is null, and whether it was there before."""
    return rows.withColumns({f"{name}_kept": F.col(name).isNotNull(), name: F.coalesce(F.col(name), computed)})


def format_provenance(side: Column, colors: Column, indexed: Column) -> Column:
    from spritelake.operators.cleaning import native_format

    return F.struct(
        F.lit("png").alias("file_format"), native_format(side, colors).alias("native_format"),
        colors.alias("color_count_at_ingestion"), indexed.alias("palette_indexed"),
    )


def provenance_entry(sprite_id: Column, source_url: Column, creator: Column, license_id: Column, hash16: Column, algorithm: str, tier: Column, added: Column) -> Column:
    """A manifest's entry; hashes of different algorithms are told apart by name."""
    from spritelake.operators.provenance import license_url

    return F.struct(
        sprite_id.alias("sprite_id"), source_url.alias("source_url"), creator.alias("creator"), license_id.alias("license"),
        license_url(license_id).alias("license_url"), added.cast("timestamp").alias("date_added"), hash16.alias("perceptual_hash"),
        F.lit(algorithm).alias("hash_algo"), tier.cast("string").alias("tier"),
    )
