"""Two-dimensional operators on flat row-major index grids (0 is transparent), as Column
expressions: a sprite is one row, so none of these shuffles.

A lambda's body is evaluated for every element, and so is any whole array that it names. So no
array is looked into from within a lambda here: neighbours are whole grids moved by one cell, and
what belongs to a cell is zipped with it. The work is linear in the number of cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spritelake.functions import kernels

TRANSPARENT, OUTLINE, STRUCTURAL, SMALL, DETAIL = range(5)
STRUCTURAL_OVER = 6


def neighbours(grid: Column, width: Column) -> list[Column]:
    """The grids of left, right, upper and lower neighbours; outside counts as 0."""
    n, zero = F.size(grid), F.array(F.lit(0))
    before, after = F.concat(zero, F.slice(grid, F.lit(1), n - 1)), F.concat(F.slice(grid, F.lit(2), n - 1), zero)
    row = F.array_repeat(F.lit(0), width)
    return [
        F.transform(before, lambda v, i: F.when(i % width > 0, v).otherwise(0)),
        F.transform(after, lambda v, i: F.when(i % width < width - 1, v).otherwise(0)),
        F.concat(row, F.slice(grid, F.lit(1), n - width)),
        F.concat(F.slice(grid, width + 1, n - width), row),
    ]


def zipped(**arrays: Column) -> Column:
    """One array of structs of these arrays' elements."""
    return F.arrays_zip(*(a.alias(k) for k, a in arrays.items()))


def around(**grids: Column) -> Column:
    """The cells of the grid ``v`` of the given ``width`` with l, r, u, d, and of further grids."""
    width, v = grids.pop("width"), grids.pop("v")
    return zipped(v=v, **dict(zip("lrud", neighbours(v, width), strict=True)), **grids)


def outline(grid: Column, width: Column) -> Column:
    """For each cell whether it is filled and has a transparent neighbour."""
    return F.transform(around(v=grid, width=width), lambda c: (c["v"] > 0) & (F.least(c["l"], c["r"], c["u"], c["d"]) == 0))


def opaque(grid: Column, alpha: Column, least: int) -> Column:
    """The grid with cells of an alpha below ``least`` as transparent ones."""
    return F.transform(zipped(v=grid, a=alpha), lambda c: F.when(c["a"] < least, 0).otherwise(c["v"]))


def orphans(grid: Column, width: Column) -> Column:
    """For each cell whether it is filled and no neighbour has its index."""
    return F.transform(
        around(v=grid, width=width),
        lambda c: (c["v"] > 0) & (c["l"] != c["v"]) & (c["r"] != c["v"]) & (c["u"] != c["v"]) & (c["d"] != c["v"]),
    )


def count_where(cells: Column, test) -> Column:
    return F.size(F.filter(cells, test))


def categories(grid: Column, width: Column, labels: Column, sizes: Column, five: bool = False) -> Column:
    """Category of each cell: transparent, outline, structural (in a region of more than 6 cells),
    small (or with ``five`` small beside a structural cell), and with ``five`` detail. ``labels``
    and ``sizes`` are each cell's region and its size."""
    parts = {"v": grid, "edge": outline(grid, width), "n": sizes}
    if five:
        big = F.transform(sizes, lambda n: F.when(n > STRUCTURAL_OVER, 1).otherwise(0))
        beside = F.transform(around(v=big, width=width), lambda c: F.greatest(c["l"], c["r"], c["u"], c["d"]) == 1)
        parts["shaded"] = kernels.any_in_region(labels, beside)

    def category(c):
        rest = F.when(c["shaded"], SMALL).otherwise(DETAIL) if five else F.lit(SMALL)
        return F.when(c["v"] == 0, TRANSPARENT).when(c["edge"], OUTLINE).when(c["n"] > STRUCTURAL_OVER, STRUCTURAL).otherwise(rest)

    return F.transform(zipped(**parts), category)


def sequence(grid: Column, width: Column, cats: Column, transparent_first: bool = False) -> Column:
    """Tokens (p, x, y) in drawing order: outline, structural, other, transparent; then by row and
    column. One array sort, no window."""
    last = -1 if transparent_first else 3

    def token(c, i):
        k = F.when(c["c"] == OUTLINE, 0).when(c["c"] == STRUCTURAL, 1).when(c["c"] == TRANSPARENT, last).otherwise(2)
        return F.struct(k.alias("k"), F.floor(i / width).cast("int").alias("y"), (i % width).cast("int").alias("x"), c["v"].alias("p"))

    order = F.transform(zipped(v=grid, c=cats), token)
    return F.transform(F.sort_array(order), lambda t: F.struct(t["p"].alias("p"), t["x"].alias("x"), t["y"].alias("y")))


def rows_of(grid: Column, width: Column) -> Column:
    """The grid as an array of rows; null where its length is no multiple of the width."""
    n = F.size(grid)
    return F.when(
        n % width == 0, F.transform(F.sequence(F.lit(0), F.floor(n / width).cast("int") - 1), lambda r: F.slice(grid, r * width + 1, width))
    )


def mirrored(grid: Column, width: Column) -> Column:
    """Left and right exchanged: a sort by the new places."""
    moved = F.transform(grid, lambda v, i: F.struct((F.floor(i / width) * width + width - 1 - i % width).alias("at"), v.alias("v")))
    return F.transform(F.sort_array(moved), lambda c: c["v"])


def zoomed(grid: Column, width: Column, factor: int) -> Column:
    """Each cell repeated ``factor`` times both ways: a sort by the new places."""

    def copies(v, i):
        y, x = F.floor(i / width), i % width
        return F.array(*(
            F.struct(((y * factor + dy) * width * factor + x * factor + dx).alias("at"), v.alias("v")) for dy in range(factor) for dx in range(factor)
        ))

    return F.transform(F.sort_array(F.flatten(F.transform(grid, copies))), lambda c: c["v"])


def average_hash(gray: Column) -> Column:
    """16 hexadecimal digits of an 8x8 grey grid: bit 1 where a cell is at least the mean, first
    cell first."""
    mean = F.aggregate(gray, F.lit(0.0), lambda s, v: s + v.cast("double")) / F.size(gray)
    seen = zipped(v=gray, mean=F.array_repeat(mean, F.size(gray)))
    bits = F.transform(seen, lambda c: F.when(c["v"].cast("double") >= c["mean"], "1").otherwise("0"))
    return F.lower(F.lpad(F.conv(F.array_join(bits, ""), 2, 16), 16, "0"))
