"""Arrow kernels for the three array algorithms that no Column expression states well."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = T.ArrayType(T.IntegerType())


def label_regions(stack: np.ndarray) -> np.ndarray:
    """4-connected regions of equal index in n grids of one shape: each cell gets the smallest
    place in its region, transparent cells -1. All grids move together, and labels jump to their
    label's label, so the rounds grow with the logarithm of a region's length."""
    n, h, w = stack.shape
    filled = stack > 0
    start = np.where(filled, np.arange(h * w).reshape(1, h, w), h * w)
    label = start
    across, down = (stack[:, :, 1:] == stack[:, :, :-1]) & filled[:, :, 1:], (stack[:, 1:] == stack[:, :-1]) & filled[:, 1:]
    while True:
        new = label.copy()
        low = np.where(across, np.minimum(label[:, :, 1:], label[:, :, :-1]), h * w)
        new[:, :, 1:] = np.minimum(new[:, :, 1:], low)
        new[:, :, :-1] = np.minimum(new[:, :, :-1], low)
        low = np.where(down, np.minimum(new[:, 1:], new[:, :-1]), h * w)
        new[:, 1:] = np.minimum(new[:, 1:], low)
        new[:, :-1] = np.minimum(new[:, :-1], low)
        flat = np.concatenate([new.reshape(n, -1), np.full((n, 1), h * w)], axis=1)
        new = np.minimum(new, np.take_along_axis(flat, flat, axis=1)[:, :-1].reshape(n, h, w))
        if np.array_equal(new, label):
            return np.where(filled, label, -1)
        label = new


@F.pandas_udf(INTEGERS)
def regions(grid: pd.Series, width: pd.Series) -> pd.Series:
    """Region labels of flat grids; null where the width does not divide the length."""
    out: list = [None] * len(grid)
    shapes: dict[tuple[int, int], list[int]] = {}
    for i, (g, w) in enumerate(zip(grid, width, strict=True)):
        if g is not None and w and len(g) and len(g) % w == 0:
            shapes.setdefault((len(g) // w, w), []).append(i)
    for (h, w), places in shapes.items():
        found = label_regions(np.stack([grid[i] for i in places]).reshape(len(places), h, w))
        for i, labels in zip(places, found.reshape(len(places), -1).astype(np.int32), strict=True):
            out[i] = labels
    return pd.Series(out, dtype=object)


@F.pandas_udf(INTEGERS)
def region_sizes(labels: pd.Series) -> pd.Series:
    """For each cell the size of its region; 0 where it has none."""

    def one(r):
        if r is None:
            return None
        r = np.asarray(r)
        counts = np.bincount(r[r >= 0], minlength=len(r) + 1)
        return np.where(r >= 0, counts[r], 0).astype(np.int32)

    return labels.map(one)


@F.pandas_udf(T.ArrayType(T.BooleanType()))
def any_in_region(labels: pd.Series, flags: pd.Series) -> pd.Series:
    """For each cell whether some cell of its region has the flag; False where it has no region."""

    def one(r, f):
        if r is None or f is None:
            return None
        r = np.asarray(r)
        hit = np.zeros(len(r) + 1, bool)
        hit[r[np.asarray(f, bool) & (r >= 0)]] = True
        return hit[r] & (r >= 0)

    return pd.Series([one(r, f) for r, f in zip(labels, flags, strict=True)], dtype=object)


#: Palettes that are merged together, which bounds their distances in memory.
MERGED_TOGETHER = 1024


def merge_closest(colors: np.ndarray, target: int, resnap_each: bool = False) -> np.ndarray:
    """m palettes of n colours, (m, n, 3): in each, merge the two closest colours into their floored
    middle until ``target`` are left; of equal distances the first pair. ``resnap_each`` puts each
    merged colour on the 15-bit grid. All palettes move together; a merge renews the distances of
    one colour."""
    pal = colors.astype(np.int64)
    m, n, _ = pal.shape
    far, each = np.iinfo(np.int64).max, np.arange(m)
    live = np.ones((m, n), bool)
    gap = ((pal[:, :, None] - pal[:, None]) ** 2).sum(3)
    gap[:, np.tri(n, dtype=bool)] = far  # only pairs in order
    for _ in range(n - target):
        i, j = np.divmod(gap.reshape(m, -1).argmin(1), n)
        middle = (pal[each, i] + pal[each, j]) // 2
        if resnap_each:
            middle = np.clip(np.rint(middle / 8).astype(np.int64) * 8, 0, 248)
        pal[each, i], live[each, j] = middle, False
        gap[each, j], gap[each, :, j] = far, far
        fresh = np.where(live, ((pal - middle[:, None]) ** 2).sum(2), far)
        place = np.arange(n)[None]
        gap[each, i] = np.where(place > i[:, None], fresh, far)
        gap[each, :, i] = np.where(place < i[:, None], fresh, far)
    return pal[live].reshape(m, min(n, target), 3)


def palette_reducer(target: int = 15, resnap_each: bool = False):
    """A pandas UDF over arrays of packed colours (r * 65536 + g * 256 + b), in palette order;
    with ``resnap_each`` repeated colours are dropped at the end."""

    @F.pandas_udf(INTEGERS)
    def reduce_palette(palette: pd.Series) -> pd.Series:
        out: list = [None] * len(palette)
        sizes: dict[int, list[int]] = {}
        for i, p in enumerate(palette):
            if p is not None:
                sizes.setdefault(len(p), []).append(i)
        for n, all_of_size in sizes.items():
            for at in range(0, len(all_of_size), MERGED_TOGETHER):
                some = all_of_size[at : at + MERGED_TOGETHER]
                p = np.array([palette.iloc[i] for i in some], np.int64).reshape(len(some), n)
                merged = merge_closest(np.stack([p >> 16, p >> 8 & 255, p & 255], axis=2), target, resnap_each)
                packed = (merged @ np.array([65536, 256, 1])).astype(np.int32)
                for i, row in zip(some, packed, strict=True):
                    out[i] = np.array(list(dict.fromkeys(row.tolist())), np.int32) if resnap_each else row
        return pd.Series(out, dtype=object)

    return reduce_palette


def lanczos_8x8(gray: np.ndarray) -> np.ndarray:
    """A grey image resampled to 8x8 with a three-lobed Lanczos window, one axis after the other,
    rounded to bytes after each."""

    def weights(n: int) -> np.ndarray:
        scale = max(n / 8, 1.0)
        centre = (np.arange(8) + 0.5) * n / 8
        x = (np.arange(n)[None, :] + 0.5 - centre[:, None]) / scale
        w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
        return w / w.sum(1, keepdims=True)

    h, w = gray.shape
    across = np.clip(np.rint(gray @ weights(w).T), 0, 255)
    return np.clip(np.rint(weights(h) @ across), 0, 255)


@F.pandas_udf(INTEGERS)
def resample_8x8(gray: pd.Series, width: pd.Series) -> pd.Series:
    """Flat grey images as flat 8x8 ones."""
    return pd.Series([
        None if g is None or not w else lanczos_8x8(np.asarray(g, float).reshape(-1, w)).astype(np.int32).ravel()
        for g, w in zip(gray, width, strict=True)
    ])


@F.pandas_udf(T.StringType())
def dct_hash(gray: pd.Series) -> pd.Series:
    """A perceptual hash of flat 32x32 grey images: the signs of the low 8x8 cosine coefficients
    against their median (the constant one aside), as 16 hexadecimal digits."""
    k = np.arange(32)
    basis = np.cos(np.pi * (2 * k[None, :] + 1) * np.arange(8)[:, None] / 64)

    def one(g):
        if g is None or len(g) != 1024:
            return None
        low = (basis @ np.asarray(g, float).reshape(32, 32) @ basis.T).ravel()
        bits = low > np.median(low[1:])
        return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"

    return gray.map(one)
