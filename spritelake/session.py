"""Sessions and the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

LOCAL_FOLDER = "/tmp/checkpoints/spritelake"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[*]", name: str = "spritelake", **more: str) -> SparkSession:
    """A session with the settings above. Shuffle partitions and file splits are left to the
    cluster: they follow the input's size, not the code."""
    builder = SparkSession.builder.master(master).appName(name)
    for k, v in {**SETTINGS, **more}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"file://{LOCAL_FOLDER}"
    return f"{base.rstrip('/')}/spritelake/{uuid.uuid4().hex}/{name}"
