"""Session settings the engine relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "tripgauge", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with AQE; ``conf`` takes further settings, e.g.
    ``**{"spark.sql.shuffle.partitions": "16"}``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for tables a query writes, which driver and executors all see: below
    ``spark.checkpoint.dir``, or below the warehouse folder where that is unset. A
    warehouse on the driver's own disk serves only a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        master = spark.sparkContext.master
        if shared.startswith("file:") and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{shared.rstrip('/')}/tripgauge/{name}-{uuid.uuid4()}"
