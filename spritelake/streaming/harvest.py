"""Incremental harvest: files arrive, known keys are skipped, new rows are appended once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spritelake.session import shared_path


def stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """A file stream of Parquet with the schema of what is there. A path that is one file is
    streamed as the one match in its folder."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    single = target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isFile()
    folder, name = path.rstrip("/").rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)


def harvest(new: DataFrame, keys: list[str], trigger: dict | None = None, watermark: tuple[str, str] | None = None) -> DataFrame:
    """The distinct keys of a stream, run until all that is there is taken, read back as a table.

    With ``watermark`` (column, delay) the state is dropped behind it; without, it is the set of
    all keys, as in a manifest."""
    spark = new.sparkSession
    rows = new
    if watermark:
        rows = rows.withWatermark(*watermark).dropDuplicatesWithinWatermark(keys)
    else:
        rows = rows.dropDuplicates(keys)
    out, state = shared_path(spark, "harvested"), shared_path(spark, "state")
    query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    query = query.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


def each_batch(
    new: DataFrame, key: str, manifest_path: str, state: str, process: Callable[[DataFrame, int], None],
    halted: Callable[[], bool] = lambda: False, trigger: dict | None = None,
):
    """Process each micro-batch's unknown rows, then append their keys to the manifest.

    A batch that is repeated after a failure finds the keys that it has appended and skips them;
    ``process`` gets the batch's number to make its own writes idempotent. ``halted`` is asked
    before each batch."""

    def batch(df: DataFrame, number: int) -> None:
        if halted():
            raise RuntimeError("halted")
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(manifest_path)
        known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
        fresh = df.dropDuplicates([key])
        if known:
            fresh = fresh.join(spark.read.parquet(manifest_path).select(key), key, "left_anti")
        fresh = fresh.persist()
        try:
            process(fresh, number)
            fresh.select(key, F.lit(number).alias("batch")).write.mode("append").parquet(manifest_path)
        finally:
            fresh.unpersist()

    query = new.writeStream.foreachBatch(batch).option("checkpointLocation", state)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def halt_file(spark: SparkSession, path: str) -> Callable[[], bool]:
    """Whether the emergency halt file is there, asked anew each time."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return lambda: bool(fs.exists(target))


def was_halted(query) -> bool:
    """Wait for a query's end; whether it was halted. Any other failure is raised."""
    try:
        query.awaitTermination()
    except StreamingQueryException as e:
        if "halted" in str(e):
            return True
        raise
    return False


def windows(events: DataFrame, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n): an extension, counts by event time with late rows up to ``late``."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
