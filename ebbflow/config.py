"""Defaults and session settings.

The numeric defaults below are fixed values of the modelled application; results only match it when they are
kept as they are. Every operator takes them as keyword arguments, so callers can override them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# --- fixed values (must equal the modelled application's for equal results) ---
INITIAL_BALANCE = 20
LOW_THRESHOLD = 5
HIGH_THRESHOLD = 30
TIMEZONE = "America/Chicago"
DASHBOARD_START_INDEX = 16
TOP_K = 10
DAILY_TOP_K = 5
CRITICAL_LIST_LIMIT = 15
HISTOGRAM_BINS = 50
HOUR_FORMAT = "yyyy-MM-dd HH:00:00"
DEPARTURE_DELTA = -1
ARRIVAL_DELTA = 1
EBIKE_CLASS = "electric_bike"
# --- end of fixed values ---


def configure(spark: SparkSession, timezone: str = TIMEZONE) -> SparkSession:
    """Session settings the operators are designed for (CF1).

    The shuffle partition count is not pinned: AQE coalesces small partitions and splits skewed ones at runtime,
    so the same code runs on a laptop and on a thousand executors.
    """
    conf = {
        "spark.sql.session.timeZone": timezone,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of the session: ``spark.checkpoint.dir``, or the folder given to ``setCheckpointDir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh, never reused folder below ``root`` (default: the session's shared folder)."""
    return f"{(root or checkpoint_root(spark)).rstrip('/')}/ebbflow-scratch/{name}-{uuid.uuid4().hex[:12]}"
