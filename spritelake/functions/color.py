"""Colour arithmetic as Column expressions: nothing here leaves the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SNES_TOP = 248
SNES_STEP = 8
SNES_COLORS = 15


def hex_color(r: Column, g: Column, b: Column) -> Column:
    """``#rrggbb`` in lower case."""
    return F.concat(F.lit("#"), *(F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0") for c in (r, g, b)))


def packed(r: Column, g: Column, b: Column) -> Column:
    """One integer for set operations and equality joins."""
    return (r * 65536 + g * 256 + b).cast("int")


def is_hex(color: Column) -> Column:
    return color.rlike("^#?[0-9A-Fa-f]{6}$")


def channel(color: Column, k: int) -> Column:
    """Channel k (0 red, 1 green, 2 blue) of a hexadecimal colour; null where it is malformed."""
    digits = F.regexp_replace(color, "^#", "")
    return F.when(is_hex(color), F.conv(F.substring(digits, 2 * k + 1, 2), 16, 10).cast("int"))


def distance_sq(a: tuple[Column, Column, Column], b: tuple[Column, Column, Column]) -> Column:
    return reduce(lambda s, t: s + t, ((x - y) * (x - y) for x, y in zip(a, b, strict=True)))


def snes_snap(v: Column) -> Column:
    """The nearest multiple of 8 (halves to the even one) from 0 to 248."""
    step = F.bround(v.cast("double") / SNES_STEP).cast("int") * SNES_STEP
    return F.greatest(F.lit(0), F.least(F.lit(SNES_TOP), step))


def snes_channel_legal(v: Column) -> Column:
    return (v % SNES_STEP == 0) & v.between(0, SNES_TOP)


def snes_legal(color: Column) -> Column:
    """Whether a hexadecimal colour has only channels of the 15-bit grid; malformed is False."""
    return F.coalesce(reduce(lambda a, b: a & b, (snes_channel_legal(channel(color, k)) for k in range(3))), F.lit(False))


def snes_palette_legal(palette: Column) -> Column:
    return (F.size(palette) <= SNES_COLORS) & F.forall(palette, snes_legal)


def luminance(r: Column, g: Column, b: Column) -> Column:
    return r * F.lit(0.299) + g * F.lit(0.587) + b * F.lit(0.114)


def hue(r: Column, g: Column, b: Column) -> Column:
    """Degrees from 0 to 360; grey has 0."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    spread = (top - low).cast("double")
    sector = (
        F.when(top == r, F.pmod((g - b) / spread, F.lit(6.0)))
        .when(top == g, (b - r) / spread + 2.0)
        .otherwise((r - g) / spread + 4.0)
    )
    return F.when(top == low, F.lit(0.0)).otherwise(sector * 60.0)


def hue_distance(a: Column, b: Column) -> Column:
    return F.abs(F.pmod(a - b + 180.0, F.lit(360.0)) - 180.0)


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """A struct (r, g, b) of channels cut to integers."""
    h = F.pmod(h.cast("double"), F.lit(360.0))
    c = v * s
    x = c * (1 - F.abs(F.pmod(h / 60.0, F.lit(2.0)) - 1))
    m, zero = v - c, F.lit(0.0)
    sector = F.floor(h / 60.0)

    def pick(*by_sector):
        out = by_sector[-1]
        for k in range(4, -1, -1):
            out = F.when(sector == k, by_sector[k]).otherwise(out)
        return ((out + m) * 255).cast("int")

    return F.struct(
        pick(c, x, zero, zero, x, c).alias("r"), pick(x, c, c, x, zero, zero).alias("g"), pick(zero, zero, x, c, c, x).alias("b")
    )


def darkened(v: Column, factor: float = 0.55) -> Column:
    return F.greatest(F.lit(0), F.least(F.lit(255), (v * F.lit(factor)).cast("int")))


def pure_black(r: Column, g: Column, b: Column, below: int = 20) -> Column:
    return (r < below) & (g < below) & (b < below)


def aesthetic_score(colors: Column, strict_violation: Column | None = None) -> Column:
    """1.0 up to 30 colours, 0.7 up to 60, else 0.3; a strict violation caps it at 0.3."""
    score = F.when(colors <= 30, 1.0).when(colors <= 60, 0.7).otherwise(0.3)
    return score if strict_violation is None else F.when(strict_violation, F.least(score, F.lit(0.3))).otherwise(score)


def outline_score(black_pixels: Column) -> Column:
    """1 less a fiftieth for each black outline pixel, at least 0."""
    return F.lit(1.0) - F.least(F.lit(1.0), black_pixels / F.lit(50.0))


def nearest(color: tuple[Column, Column, Column], palette: list[tuple[int, int, int]]) -> Column:
    """A struct (distance, position): the nearest of a fixed palette, 1-based, the first of equals.
    A fold over a literal list, so no join and no shuffle."""
    return F.array_min(F.array(*(
        F.struct(distance_sq(color, tuple(map(F.lit, c))).cast("int").alias("distance"), F.lit(i + 1).alias("position"))
        for i, c in enumerate(palette)
    )))
