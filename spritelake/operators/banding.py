"""Banding: runs of rows whose brightness moves one way while the hue stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spritelake.functions import color

DEAD_BAND = 2.0
HUE_WITHIN = 5.0
RUN = 4


def row_means(px: DataFrame, key: str = "sprite_id") -> DataFrame:
    """(key, y, r, g, b): floored mean colour of the filled pixels of each row."""
    sums = px.filter("idx > 0").groupBy(key, "y").agg(*(F.sum(c).alias(c) for c in "rgb"), F.count("*").alias("n"))
    return sums.select(key, "y", *(F.floor(F.col(c) / F.col("n")).alias(c) for c in "rgb"))


def banding_rows(px: DataFrame, key: str = "sprite_id") -> DataFrame:
    """(key, y) of the banded rows. A run begins anew where the direction is none or turns, or the
    hue moves; rows from the fourth step of a run on are banded. The run's direction is that of
    the row before, so a lag and a running sum of restarts state the whole loop."""
    w = Window.partitionBy(key).orderBy("y")
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    rows = row_means(px, key).withColumns({"l": color.luminance(r, g, b), "h": color.hue(r, g, b), "i": F.row_number().over(w) - 1})
    d = F.col("l") - F.lag("l").over(w)
    rows = rows.withColumns({
        "d": F.when(d > DEAD_BAND, 1).when(d < -DEAD_BAND, -1).otherwise(0),
        "turn": color.hue_distance(F.col("h"), F.lag("h").over(w)),
    })
    before = F.coalesce(F.lag("d").over(w), F.lit(0))
    rows = rows.withColumn("restart", (F.col("i") == 0) | (F.col("d") == 0) | (F.col("d") != before) | (F.col("turn") >= HUE_WITHIN))
    rows = rows.withColumn("run", F.sum(F.when(F.col("restart"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.row_number().over(Window.partitionBy(key, "run").orderBy("y"))
    return rows.withColumn("at", at).filter(~F.col("restart") & (F.col("at") >= RUN)).select(key, "y")
