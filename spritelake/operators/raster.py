"""Sheets: slicing, bands, bounding boxes, seams. Pixels are rows (sheet, x, y, filled)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_SIZE = 8
MAX_SIZE = 256
MOST_EMPTY = 0.95


def islands(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, start, end): runs of consecutive integers, end exclusive."""
    run = F.col(at) - F.row_number().over(Window.partitionBy(*keys).orderBy(at))
    runs = rows.select(*keys, at).distinct().withColumn("__run", run)
    return runs.groupBy(*keys, "__run").agg(F.min(at).alias("start"), (F.max(at) + 1).alias("end")).drop("__run")


def _numbered(tiles: DataFrame, min_size: int) -> DataFrame:
    kept = tiles.filter((F.col("width") >= min_size) & (F.col("height") >= min_size))
    order = Window.partitionBy("sheet").orderBy("row", "col")
    return kept.withColumn("sprite_id", (F.row_number().over(order) - 1).cast("int"))


def grid_slice(px: DataFrame, tile_w: int, tile_h: int, sheet_w: int, sheet_h: int, min_size: int = MIN_SIZE) -> DataFrame:
    """Tiles of a fixed grid (what is left over at the edges is dropped) that are not nearly empty,
    cut to their bounding boxes. Map-side aggregation leaves a row a tile to shuffle."""
    cols, rows = sheet_w // tile_w, sheet_h // tile_h
    inside = px.filter((F.col("x") < cols * tile_w) & (F.col("y") < rows * tile_h))
    cells = inside.withColumns({"col": F.floor(F.col("x") / tile_w), "row": F.floor(F.col("y") / tile_h)})
    boxes = cells.groupBy("sheet", "row", "col").agg(*_box())
    return _numbered(_placed(boxes), min_size)


def _box() -> list[Column]:
    seen = [F.when(F.col("filled"), F.col(c)) for c in ("x", "y")]
    return [
        F.avg(F.when(F.col("filled"), 0.0).otherwise(1.0)).alias("empty"),
        F.min(seen[0]).alias("x0"), F.max(seen[0]).alias("x1"), F.min(seen[1]).alias("y0"), F.max(seen[1]).alias("y1"),
    ]


def _placed(boxes: DataFrame) -> DataFrame:
    kept = boxes.filter((F.col("empty") <= MOST_EMPTY) & F.col("x0").isNotNull())
    return kept.select(
        "sheet", "row", "col", F.col("x0").alias("sheet_x"), F.col("y0").alias("sheet_y"),
        (F.col("x1") - F.col("x0") + 1).alias("width"), (F.col("y1") - F.col("y0") + 1).alias("height"),
    )


def gutter_bands(px: DataFrame) -> DataFrame:
    """(sheet, axis, start, end): bands of rows and of columns that hold a filled pixel."""
    filled = px.filter("filled")
    both = filled.select("sheet", F.explode(F.array(
        F.struct(F.lit("row").alias("axis"), F.col("y").alias("at")), F.struct(F.lit("col").alias("axis"), F.col("x").alias("at"))
    )).alias("a")).select("sheet", "a.*")
    return islands(both, ["sheet", "axis"], "at")


def gutter_slice(px: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """Sprites where a band of rows crosses a band of columns, cut to their bounding boxes. Bands
    become arrays on the sheet's rows, so pixels find theirs without a range join."""
    bands = gutter_bands(px).groupBy("sheet", "axis").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("b"))
    by_axis = bands.groupBy("sheet").agg(
        F.first(F.when(F.col("axis") == "row", F.col("b")), ignorenulls=True).alias("rows"),
        F.first(F.when(F.col("axis") == "col", F.col("b")), ignorenulls=True).alias("cols"),
    )

    def place(list_name: str, at: str) -> Column:
        return F.size(F.filter(list_name, lambda b: b["start"] <= F.col(at))) - 1

    found = px.join(by_axis, "sheet").withColumns({"row": place("rows", "y"), "col": place("cols", "x")})
    boxes = found.filter((F.col("row") >= 0) & (F.col("col") >= 0)).groupBy("sheet", "row", "col")
    return _numbered(_placed(boxes.agg(*_box())), min_size)


def bounding_box(px: DataFrame, *keys: str) -> DataFrame:
    """(keys, x0, y0, x1, y1) of the filled pixels."""
    return px.filter("filled").groupBy(*keys).agg(
        F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1")
    )


def seams(px: DataFrame, tile: int) -> DataFrame:
    """(sheet, row, col, side, mismatches): how many pixels along a tile's left and upper edge
    differ from the neighbouring tile's. Only edge pixels are joined."""
    cells = px.withColumns({"row": F.floor(F.col("y") / tile), "col": F.floor(F.col("x") / tile)})
    x, y = F.col("x") % tile, F.col("y") % tile

    def edge(which: Column, side: str, along: Column, row: Column, col: Column, name: str) -> DataFrame:
        return cells.filter(which).select("sheet", row.alias("row"), col.alias("col"), F.lit(side).alias("side"), along.alias("along"), F.col("idx").alias(name))

    row, col = F.col("row"), F.col("col")
    own = edge(x == 0, "left", y, row, col, "own").union(edge(y == 0, "up", x, row, col, "own"))
    other = edge(x == tile - 1, "left", y, row, col + 1, "other").union(edge(y == tile - 1, "up", x, row + 1, col, "other"))
    met = own.join(other, ["sheet", "row", "col", "side", "along"])
    return met.groupBy("sheet", "row", "col", "side").agg(F.sum(F.when(F.col("own") != F.col("other"), 1).otherwise(0)).alias("mismatches"))


def route(width: Column, height: Column) -> Column:
    """Sheet, single sprite, or skipped, by size."""
    sheet = (width > 32) & (height > 32) & (width % 16 == 0) & (height % 16 == 0)
    within = width.between(MIN_SIZE, MAX_SIZE) & height.between(MIN_SIZE, MAX_SIZE)
    return F.when(sheet, "sheet").when(within, "individual").otherwise("skipped")


def tile_size(width: Column, height: Column) -> Column:
    large = (width >= 128) & (height >= 128) & (width % 32 == 0) & (height % 32 == 0)
    return F.when(large, 32).otherwise(16)


def slice_mode(width: Column, height: Column) -> Column:
    """How a sheet is cut by the second orchestrator: whole, grid16, or auto16."""
    return F.when((width <= 32) & (height <= 32), "whole").when((width % 16 == 0) & (height % 16 == 0), "grid16").otherwise("auto16")


def empty_cells(px: DataFrame, tile: int, cols: int, rows: int) -> DataFrame:
    """(sheet, row, col) of the cells without a filled pixel."""
    sheets = px.select("sheet").distinct()
    cells = sheets.select("sheet", F.explode(F.sequence(F.lit(0), F.lit(rows * cols - 1))).alias("k"))
    cells = cells.select("sheet", F.floor(F.col("k") / cols).alias("row"), F.pmod("k", F.lit(cols)).cast("long").alias("col"))
    used = px.filter("filled").select("sheet", F.floor(F.col("y") / tile).alias("row"), F.floor(F.col("x") / tile).alias("col")).distinct()
    return cells.join(used, ["sheet", "row", "col"], "left_anti")


def lpc_layout(sheet_x: Column, sheet_y: Column, tile_w: int = 64, tile_h: int = 64) -> Column:
    """A struct (animation_type, pose_direction, frame_index) of a cell of the LPC layout."""
    row = F.floor(sheet_y / tile_h)
    kinds = F.array(*map(F.lit, ("cast", "thrust", "walk", "slash", "shoot")))
    kind = F.when(row == 20, "hurt").when(row.between(0, 19), F.get(kinds, F.floor(row / 4).cast("int")))
    facing = F.when(row.between(0, 19), F.get(F.array(*map(F.lit, "NWSE")), F.pmod(row, F.lit(4)).cast("int"))).when(row == 20, "S")
    return F.struct(kind.alias("animation_type"), facing.alias("pose_direction"), F.floor(sheet_x / tile_w).cast("int").alias("frame_index"))
