"""Helpers that the operators of this subpackage share.

Everything that has to outlive a task goes to the folder that the session names in
``spark.checkpoint.dir``: the driver and the executors share that folder and nothing else.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where the session names no shared folder, as in tests on one machine.
LOCAL_FOLDER = "/tmp/checkpoints/spritelake"

#: Upper bound of a slice of texts that a Python worker holds as Python objects.
SLICE_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = f"file://{LOCAL_FOLDER}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/spritelake/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: its lineage ends here, and a lost
    executor costs no more than reading the files anew."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`stored` that nothing reads any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        conf = df.sparkSession._jsc.hadoopConfiguration()
        target.getFileSystem(conf).delete(target.getParent(), True)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once a context, so that workers can import it
    wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_spritelake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with tempfile.TemporaryDirectory() as folder:
        path = os.path.join(folder, "spritelake_workers.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for at, _, names in os.walk(root):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(at, n)
                        z.write(full, os.path.join("spritelake", os.path.relpath(full, root)))
        kept = os.path.join(tempfile.mkdtemp(prefix="spritelake-"), "spritelake_workers.zip")
        os.replace(path, kept)
    sc.addPyFile(kept)
    sc._spritelake_shipped = True


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table, made in the plan itself."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    text = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    found = F.from_json(F.lit(text), f"array<struct<{','.join(c.strip().replace(' ', ':') for c in schema.split(','))}>>")
    return spark.range(1).select(F.explode(found).alias("r")).select("r.*")


def utf8(column) -> F.Column:
    """The UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in zero-copy slices whose ``text`` column holds at most ``most``
    bytes, or one row."""
    for batch in batches:
        column = batch.column(text)
        start, total = 0, 0
        for i in range(batch.num_rows):
            size = len(column[i].as_buffer()) if column[i].is_valid else 0
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if batch.num_rows > start:
            yield batch.slice(start)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; once they end, Arrow's pool gives back what it holds for later, as a worker lives on
    into the next stages."""
    yield from batches
    pa.default_memory_pool().release_unused()


def shielded(docs: DataFrame) -> DataFrame:
    """``docs`` with other names for the columns that begin with two underscores, which the operators
    use for their own; ``toDF(*docs.columns)`` gives the names back."""
    taken = {c.lower() for c in docs.columns}
    names = []
    for i, c in enumerate(docs.columns):
        name = c
        if c.startswith("__"):
            name = f"kept{i}"
            while name in taken:
                name += "_"
            taken.add(name)
        names.append(name)
    return docs.toDF(*names)


def written_place(docs: DataFrame) -> F.Column | None:
    """The place of each row in files that Spark wrote one after the other: the number in the file's
    name, then the row's number. None for rows that do not come straight from Parquet files."""
    place = F.expr("coalesce(try_cast(regexp_extract(_metadata.file_name, 'part-([0-9]{1,9})', 1) as bigint), 0) * 1099511627776 + _metadata.row_index")
    if "_metadata" in {c.lower() for c in docs.columns}:
        return None
    try:
        docs.select(place)
    except AnalysisException:
        return None
    return place


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
