"""Places and running sums in a total order, in two levels.

Rows are written once, dealt by ranges of the order, so that no window holds more than a range;
sums over the ranges, a row for each range and group, are joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spritelake.session import shared_path

#: Rows of a range on average.
RANGE_ROWS = 100_000


def running(rows: DataFrame, order: list[str], sums: dict[str, Column], keys: tuple[str, ...] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """``rows`` with ``place`` (from 1, in ``order``, for each group of ``keys``) and, for each of
    ``sums``, its running sum up to and with the row.

    Ranges follow from the number of rows, and a group of any size is spread over them. The dealt
    rows are stored, so both levels see the same ranges whatever is computed again. Nulls of a key
    are a group; rows that are equal in ``order`` have places in any order among each other."""
    spark = rows.sparkSession
    dealt = rows.select("*", *(s.cast("long").alias(f"__{n}") for n, s in sums.items()))
    parts = max(1, -(-rows.count() // range_rows))
    dealt = dealt.repartitionByRange(parts, *keys, *order).withColumn("__part", F.spark_partition_id())
    path = shared_path(spark, "ranges")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    names = [f"__{n}" for n in sums]
    totals = dealt.groupBy(*keys, "__part").agg(F.count("*").alias("__n"), *(F.coalesce(F.sum(n), F.lit(0)).alias(f"{n}_n") for n in names))
    before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *(F.col(k).alias(f"__key_{k}") for k in keys), F.col("__part").alias("__p"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"),
        *(F.coalesce(F.sum(f"{n}_n").over(before), F.lit(0)).alias(f"{n}_n") for n in names),
    )
    own = Window.partitionBy(*keys, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = dealt.withColumns({"__at": F.count("*").over(own), **{f"{n}_at": F.coalesce(F.sum(n).over(own), F.lit(0)) for n in names}})
    on = within["__part"] == totals["__p"]
    for k in keys:
        on &= within[k].eqNullSafe(totals[f"__key_{k}"])
    joined = within.join(totals, on)
    return joined.select(
        *(within[c] for c in rows.columns), (F.col("__at") + F.col("__n")).alias("place"),
        *((F.col(f"__{n}_at") + F.col(f"__{n}_n")).alias(n) for n in sums),
    )
