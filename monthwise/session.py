"""Session settings and shared scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on.  Time zone UTC: epoch <-> timestamp_ntz casts
# go through the session zone.  AQE re-plans joins at run time from measured
# shuffle sizes (a checked broadcast), coalesces small partitions and splits
# skewed join partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "monthwise", driver_memory: str | None = None) -> SparkSession:
    """Local/test session.  On a cluster use the existing session and call
    :func:`configure` instead."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the models depend on to an existing session."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def footer_counts(spark: SparkSession) -> Iterator[None]:
    """Parquet read inside uses the v2 scan, whose aggregates may come from file footers.  The
    choice of scan is made where a table is read, so the setting is put back at the end."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")      # no effect on v1 scans
    key = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(key)
    spark.conf.set(key, ",".join(s for s in before.split(",") if s.strip().lower() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Partitioned writes inside keep up to ``most`` files a task open instead of sorting rows by
    file first (only where the files need no order that Spark makes)."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and written tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only a local-mode session
    (tests, local runs) without one gets a fresh temporary folder; on a cluster a
    machine-local folder would not survive a lost executor, so it is an error."""
    try:
        base = spark.sparkContext.getCheckpointDir()
    except Exception:        # no SparkContext on this client
        base = None
    if not base:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                               "distributed file system) before running jobs that write scratch data")
        base = tempfile.mkdtemp(prefix="monthwise-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(base)
            base = spark.sparkContext.getCheckpointDir() or base
        except Exception:
            spark.conf.set("spark.checkpoint.dir", base)
    return base


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused sub-folder of the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


__all__ = ["build_session", "configure", "ensure_utc", "shared_dir", "new_work_path",
           "default_parallelism", "SESSION_CONF"]
