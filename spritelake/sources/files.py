"""Readers and writers of rasters, records, archives and reports."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Records that are no sprites.
NOT_SPRITES = r"(_seq|_cat)\.json$|/(manifest|tileset_meta|candidates|sheet_classification)\.json$"


def images(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    """(path, width, height, channels, data): decoded images, found in all subfolders."""
    rows = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("dropInvalid", True).load(folder)
    return rows.select(F.col("image.origin").alias("path"), "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data")


def _pixels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "x", "y", "r", "g", "b", "a"]
    for batch in batches:
        paths, widths, channels = (batch.column(k).to_pylist() for k in range(3))
        for i in range(batch.num_rows):
            cells = np.frombuffer(batch.column(3)[i].as_buffer(), np.uint8).reshape(-1, channels[i]).astype(np.int32)
            b, g, r = (cells[:, 0],) * 3 if channels[i] == 1 else cells.T[:3]
            alpha = cells[:, 3] if channels[i] == 4 else np.full(len(cells), 255, np.int32)
            y, x = np.divmod(np.arange(len(cells), dtype=np.int32), np.int32(widths[i]))
            path = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(cells), np.int32)), pa.array([paths[i]])).dictionary_decode()
            yield pa.RecordBatch.from_arrays([path, *map(pa.array, (x, y, r, g, b, alpha))], names)


def pixels(decoded: DataFrame) -> DataFrame:
    """(path, x, y, r, g, b, a) of decoded images: bytes come as blue, green, red; a missing alpha
    is 255, grey repeats."""
    rows = decoded.select("path", "width", "channels", "data")
    return rows.mapInArrow(_pixels, "path string, x int, y int, r int, g int, b int, a int")


def png_headers(spark: SparkSession, folder: str) -> DataFrame:
    """(path, width, height, palette_indexed) from the header bytes, without decoding."""

    def number(at: int, n: int) -> Column:
        return F.conv(F.hex(F.substring("content", at, n)), 16, 10).cast("int")

    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.png").load(folder)
    return rows.select("path", number(17, 4).alias("width"), number(21, 4).alias("height"), (number(26, 1) == 3).alias("palette_indexed"))


def sprite_records(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One row a sprite's JSON file, with its path; other records are left out."""
    rows = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    found = rows.json(folder).withColumn("path", F.col("_metadata.file_path"))
    return found.filter(~F.col("path").rlike(NOT_SPRITES))


def manifest(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A JSON array; a missing or empty file has no rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "DROPMALFORMED").json(path)


def manifest_ids(spark: SparkSession, path: str, key: str = "sprite_id") -> DataFrame:
    """(id): the ids that manifests list, in any of three shapes: an array of records, an array of
    ids, or an object with ids as its keys. A missing path has no rows; a file is read whole."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], "id string")
    text = F.trim("value")
    records = F.transform(F.from_json(text, "array<map<string,string>>"), lambda r: F.get(F.array(r[key]), 0))
    ids = F.when(text.startswith("{"), F.json_object_keys(text)).when(text.rlike(r"^\[\s*\{"), records).otherwise(F.from_json(text, "array<string>"))
    rows = spark.read.option("wholetext", True).text(path)
    return rows.select(F.explode(ids).alias("id")).filter("id IS NOT NULL")


def _documents(shape: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [p for batch in batches for p in batch.column(0).to_pylist()]
        a, b = "{}" if shape == "keyed" else "[]"
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([a + ",".join(parts) + b])], ["value"])

    return run


def write_documents(rows: DataFrame, path: str, key: str, shape: str = "records") -> None:
    """Rows as JSON documents, a file for each partition: an array of ``records``, an array of the
    ``ids`` in ``key``, or an object of records ``keyed`` by them."""
    record = F.to_json(F.struct(*rows.columns))
    name = F.to_json(F.array(F.col(key).cast("string")))
    name = F.substring(name, F.lit(2), F.length(name) - 2)  # a JSON string
    part = {"records": record, "ids": name, "keyed": F.concat(name, F.lit(":"), record)}[shape]
    rows.select(part.alias("part")).mapInArrow(_documents(shape), "value string").write.text(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A record a line; bad lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def listed_paths(spark: SparkSession, path: str) -> DataFrame:
    """(path): a list of files made beforehand."""
    return spark.read.text(path).select(F.trim("value").alias("path")).filter("path != ''")


def _members(keep_tree: bool, ending: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                paths, names, data, seen = [], [], [], set()
                with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as z:
                    for name in z.namelist():
                        if not name.lower().endswith(ending) or (keep_tree and name.startswith("__")):
                            continue
                        short = name if keep_tree else posixpath.basename(name)
                        if short not in seen:
                            seen.add(short)
                            paths.append(path)
                            names.append(short)
                            data.append(z.read(name))
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(names, pa.string()), pa.array(data, pa.binary())], ["path", "member", "content"])

    return run


def zip_members(spark: SparkSession, folder: str, keep_tree: bool = False, ending: str = ".png") -> DataFrame:
    """(path, member, content) of the images in all archives: flattened to base names, of which the
    first counts, or with their folders and without names that begin with ``__``."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.zip").load(folder)
    return rows.select("path", "content").mapInArrow(_members(keep_tree, ending), "path string, member string, content binary")


def append(rows: DataFrame, path: str, partition_by: list[str] | None = None, as_json: bool = False) -> None:
    """Add rows to a table of records; the commit protocol makes all of them visible or none."""
    writer = rows.write.mode("append")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    (writer.json if as_json else writer.parquet)(path)


def append_new(rows: DataFrame, path: str, key: str) -> None:
    """Add the rows whose key the table does not have yet, one of each key."""
    spark = rows.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fresh = rows.dropDuplicates([key])
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        fresh = fresh.join(spark.read.parquet(path).select(key), key, "left_anti")
    append(fresh, path)


class Moved(NamedTuple):
    """What a verified move wrote, and what went wrong."""

    rows: int
    errors: list[str]


def verified_move(rows: DataFrame, path: str, source: str | None = None) -> Moved:
    """Write rows, read them back and compare counts and a hash sum. Only where both agree is
    ``source`` (the folder that the rows come from) deleted; a mismatch is an entry in ``errors``."""
    spark = rows.sparkSession
    rows.write.mode("errorifexists").parquet(path)

    def proof(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 40)))).first()

    wrote, read = proof(rows), proof(spark.read.schema(rows.schema).parquet(path))
    if wrote != read:
        return Moved(read[0], [f"{path}: wrote {tuple(wrote)}, read {tuple(read)}"])
    if source is not None:
        target = spark._jvm.org.apache.hadoop.fs.Path(source)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return Moved(read[0], [])


def write_split_manifest(rows: DataFrame, path: str, id_col: str, split_col: str = "split") -> None:
    """The ids of each split in a folder of its own, as JSON records; a manifest that is there is replaced."""
    rows.select(id_col, split_col).write.mode("overwrite").partitionBy(split_col).json(path)


def load_split(spark: SparkSession, path: str, name: str, id_col: str, kind: str = "long") -> DataFrame:
    """(id): the ids of a split. A missing split raises FileNotFoundError, and a record that is no
    record of an id raises where it is read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/split={name}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        raise FileNotFoundError(f"{path}/split={name}")
    return spark.read.schema(f"{id_col} {kind}").option("mode", "FAILFAST").json(f"{path}/split={name}")


def markdown_table(rows: DataFrame, most: int = 1000) -> str:
    """A report's table; an aggregate of at most ``most`` rows."""
    names = rows.columns
    body = [" | ".join("" if v is None else str(v) for v in r) for r in rows.limit(most).collect()]
    return "\n".join([f"| {' | '.join(names)} |", f"|{'---|' * len(names)}", *(f"| {line} |" for line in body)])
