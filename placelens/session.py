"""Session defaults: adaptive execution with skew splitting, UTC, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans here are built from many small expressions; skip recording a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app_name: str = "placelens", **settings: str) -> SparkSession:
    """A session with the defaults above; keyword settings use ``__`` for dots.

    Nothing here sizes a cluster: set ``spark.sql.shuffle.partitions`` high there
    and let adaptive execution coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder under the cluster's ``spark.checkpoint.dir``, for state that must outlive executors."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint location")
    return f"{root.rstrip('/')}/{name}"
