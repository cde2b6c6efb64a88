"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Over-partition the shuffles and let AQE merge small partitions back.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(app_name: str = "mastermill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with UTC time zone and adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own; on a cluster the setting is
    required, because a machine-local folder is not visible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    base = tempfile.mkdtemp(prefix="mastermill-")
    spark.sparkContext.setCheckpointDir(base)
    return base


def new_work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`work_dir`; never reused, so a retry cannot read half-written data."""
    return f"{work_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
