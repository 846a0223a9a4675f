"""Deterministic splits: the order of a seeded hash stands for a seeded shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX_DIGITS = 4


def shuffle_key(seed: int, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def validation_count(n: Column, ratio: float, singletons_train: bool) -> Column:
    """max(1, n * ratio rounded half to even); no row of a group of one if ``singletons_train``."""
    k = F.greatest(F.lit(1), F.bround(n * F.lit(float(ratio)), 0).cast("int"))
    return F.when(n == 1, 0).otherwise(k) if singletons_train else k


def split(rows: DataFrame, id_col: str, ratio: float = 0.1, seed: int = 42, stratum: str | None = None) -> DataFrame:
    """``rows`` with split, train or val: in each stratum (null counts as ''; without one all rows
    together) the first rows in hash order are val.

    Ranks come in two levels, within hash prefixes and over them, so neither all rows nor a large
    stratum go to one task."""
    if not 0 < ratio < 1:
        raise ValueError("the ratio is between 0 and 1")
    group = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    keyed = rows.withColumns({"__g": group, "__h": shuffle_key(seed, id_col)})
    keyed = keyed.withColumn("__p", F.substring("__h", 1, PREFIX_DIGITS))
    counts = keyed.groupBy("__g", "__p").agg(F.count("*").alias("c"))
    own = Window.partitionBy("__g")
    before = F.coalesce(F.sum("c").over(own.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("__g", "__p", before.alias("__b"), F.sum("c").over(own).alias("__n"))
    rank = F.row_number().over(Window.partitionBy("__g", "__p").orderBy("__h", id_col))
    ranked = keyed.withColumn("__r", rank).join(counts, ["__g", "__p"])
    val = F.col("__r") + F.col("__b") <= validation_count(F.col("__n"), ratio, stratum is not None)
    return ranked.withColumn("split", F.when(val, "val").otherwise("train")).drop("__g", "__h", "__p", "__b", "__n", "__r")


def corpus_batch(day: Column, second_from: str) -> Column:
    """1 for what was there before a day, 2 from it on; null days belong to the first."""
    return F.when(day >= F.lit(second_from).cast("date"), 2).otherwise(1)


def bernoulli(rows: DataFrame, key: str, percent: int = 10, seed: int = 0) -> DataFrame:
    """``rows`` with split, decided for each key by itself by a hash."""
    share = F.pmod(F.conv(F.substring(shuffle_key(seed, key), 1, 8), 16, 10).cast("long"), F.lit(100))
    return rows.withColumn("split", F.when(share < percent, "val").otherwise("train"))
