"""Session settings the jobs are designed for."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# AQE picks partition sizes, turns joins into broadcasts once a side has been
# measured, and splits skewed join partitions.  The broadcast limit is left to
# Spark's own size check: no join in this package forces a broadcast of a side
# that grows with the data.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


_local_folders: dict[str, str] = {}


def build_session(app_name: str = "pontualis", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables written between jobs.

    A cluster names it in ``spark.checkpoint.dir``.  Where that is unset, a local
    master gets one temporary folder for its application; any other master gets an
    error, as each executor would write to a disk of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="pontualis-")
    return _local_folders[context.applicationId]
