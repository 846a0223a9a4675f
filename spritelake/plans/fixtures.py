"""The sprite-shaped views of the tables: embeddings as 8x8 index grids, documents as manifests,
labels as decisions, parts as packs.

Formulas that both Spark and the checking SQL use are kept as text here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RED = "(CASE WHEN idx = 1 AND pack % 2 = 1 THEN pack % 20 ELSE (idx * 53 + pack * 29) % 256 END)"
GREEN = "(CASE WHEN idx = 1 AND pack % 2 = 1 THEN (pack * 3) % 20 ELSE (idx * 97 + pack * 31) % 256 END)"
BLUE = "(CASE WHEN idx = 1 AND pack % 2 = 1 THEN (pack * 7) % 20 ELSE (idx * 151 + pack * 17) % 256 END)"
#: Colours that brighten from row to row; in one pack of four the hue moves too.
BAND_RED = "(60 + y * 8 + idx * (pack % 3))"
BAND_GREEN = "(CASE WHEN pack % 4 = 3 THEN (y * 60) % 256 ELSE 60 + y * 8 + idx * (pack % 3) END)"

#: A realistic pack and path for each word of a part's name.
WORD_PATHS = [
    ("anodized", "dungeoncrawl", "tiles/floor_01"), ("blue", "texture-stone", "a/b"), ("bolt", "lightning_pack", "fx/bolt_3"),
    ("brass", "kenney_monochrome", "x/1"), ("cog", "lpc_character_base", "walk/north"), ("copper", "kenney_ui_pack", "buttons/red"),
    ("gear", "kenney_tiny_town", "tile_0001"), ("green", "forest_pack", "nature/tree_2"), ("large", "hero_outline", "idle/0"),
    ("nut", "misc", "q/z"), ("pipe", "blackMan8", "run/1"), ("red", "redWoman2", "zz/1"), ("small", "rpg_asset_x", "q/1"),
    ("spring", "vehicles_pk", "cars/blue"), ("steel", "swords_pk", "items/steel"), ("washer", "preview_22", "q/2"),
]
#: Licence texts by doc_id % 8.
LICENSE_TEXTS = ["CC0", "CC-BY 4.0", "public domain", "License: CC0", "CC-BY-NC", "CC0 and public domain", "Licence: CC0", "MIT"]
#: Fifteen fixed colours.
PALETTE_15 = [((k * 97) % 256, (k * 61 + 40) % 256, (k * 151 + 80) % 256) for k in range(15)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _grid(add: float) -> F.Column:
    return F.transform("embedding", lambda v: F.greatest(F.lit(0), F.least(F.lit(5), F.floor((v.cast("double") + F.lit(add)) * 10).cast("int"))))


def sprites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sprite_id, pack, grid, width, height): 8x8 grids of indexes 0 to 5."""
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").alias("sprite_id"), F.col("label").alias("pack"), _grid(0.30).alias("grid"), F.lit(8).alias("width"), F.lit(8).alias("height"))


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with more transparent cells and widths from 1 to 64."""
    rows = table(spark, sf_dir, "embeddings")
    width = F.pow(F.lit(2), F.col("vec_id") % 7).cast("int")
    return rows.select(F.col("vec_id").alias("sprite_id"), F.col("label").alias("pack"), _grid(0.0).alias("grid"), width.alias("width"), (64 / width).cast("int").alias("height"))


def pixels(rows: DataFrame) -> DataFrame:
    """(sprite_id, pack, x, y, idx, r, g, b): a row a cell, coloured by pack and index."""
    px = rows.select("sprite_id", "pack", "width", F.posexplode("grid").alias("i", "idx"))
    px = px.select("sprite_id", "pack", (F.col("i") % F.col("width")).alias("x"), F.floor(F.col("i") / F.col("width")).cast("int").alias("y"), "idx")
    return px.withColumns({"r": F.expr(RED), "g": F.expr(GREEN), "b": F.expr(BLUE)})


def sheets(spark: SparkSession, sf_dir: str, stride: int) -> DataFrame:
    """(sheet, x, y, idx, filled): sixteen sparse sprites a sheet, ``stride`` pixels apart."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", _grid(0.0).alias("grid"))
    k = F.col("vec_id") % 16
    px = rows.select(F.floor(F.col("vec_id") / 16).alias("sheet"), k.alias("k"), F.posexplode("grid").alias("i", "idx"))
    return px.select(
        "sheet", (F.col("k") % 4 * stride + F.col("i") % 8).cast("int").alias("x"),
        (F.floor(F.col("k") / 4) * stride + F.floor(F.col("i") / 8)).cast("int").alias("y"), "idx", (F.col("idx") > 0).alias("filled"),
    )


def packs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, pack, path, has_meta): a part's words give its pack and path; brands tell packs apart."""
    rows = table(spark, sf_dir, "part")
    # The last word is looked up in one constant map, not compared with each word in turn.
    pairs = F.create_map(*(c for w, *pair in WORD_PATHS for c in (F.lit(w), F.array(*map(F.lit, pair)))))
    pair = F.coalesce(pairs[F.substring_index("p_name", " ", -1)], F.array(F.lit("misc"), F.lit("q/z")))
    return rows.select(F.col("p_partkey").alias("id"), pair[0].alias("pack"), pair[1].alias("path"), (F.col("p_partkey") % 37 == 0).alias("has_meta"))


def license_text(doc_id: str = "doc_id") -> F.Column:
    return F.get(F.array(*map(F.lit, LICENSE_TEXTS)), (F.col(doc_id) % 8).cast("int"))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sprite_id, decision, score_at_decision) by a document's labels."""
    rows = table(spark, sf_dir, "labels")
    decision = F.when(F.col("toxic") == 1, "flag_recalibration").when(F.col("quality") == 1, "accept").otherwise("reject")
    return rows.select(F.col("doc_id").alias("sprite_id"), decision.alias("decision"), F.when(F.col("doc_id") % 3 == 0, 60 + F.col("doc_id") % 40).cast("int").alias("score_at_decision"))
