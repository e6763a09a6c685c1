"""N8 as a stream: sessions that grow over runs and are written once they are closed.

``session_window`` keeps each user's open sessions in state (RocksDB, hash-partitioned by
user); in append mode a session leaves the state when the watermark has passed its last
event by more than the gap, so a session that spans several files, batches or runs is one
row.  Sessions are merged within each task before the shuffle, so a hot user leaves a task
as one row per session, not per event.

The watermark follows the events.  So that the last sessions of a quiet source close too,
every run also brings its clock, one row from a second folder: no event older than
``now`` less the lateness is expected after it.  A clock has no user: a filter on it would be
pushed below the watermark and undo it, so clocks form sessions of the NULL user, which
readers leave out.  Events that come later than the watermark are not in any session (the
events load keeps them in its side table).

Sessions are those of :func:`monthwise.operators.sessions.sessionize`: a gap of exactly
``gap_seconds`` does not end one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.operators.ordered import with_neighbours
from monthwise.params import Params
from monthwise.session import new_work_path
from monthwise.streaming.events_stream import MAX_BYTES, event_files, rocksdb_state

CLOCK = T.StructType([T.StructField("now", T.TimestampNTZType())])
CLOSED = "user_id bigint, started_at timestamp_ntz, ended_at timestamp_ntz, events_count bigint"
LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def sessions_stream(spark: SparkSession, source_dir: str, clock_dir: str, gap_seconds: int, file_glob: str = "events.parquet",
                    lateness: str = "1 hour", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Closed sessions (columns of ``CLOSED``) as a streaming frame; those of the NULL user are clocks."""
    events = event_files(spark, source_dir, file_glob, max_bytes).where("user_id IS NOT NULL AND ts IS NOT NULL").select(
        "user_id", F.col("ts").cast("timestamp").alias("at"))
    clocks = spark.readStream.schema(CLOCK).parquet(clock_dir).select(
        F.lit(None).cast("long").alias("user_id"), F.col("now").cast("timestamp").alias("at"))
    rows = events.unionByName(clocks).withWatermark("at", lateness)
    # Spark joins a session that starts exactly where the one before ends (tested).
    window = F.session_window("at", f"{gap_seconds} seconds")
    return rows.groupBy(window, "user_id").agg(
        F.min("at").cast("timestamp_ntz").alias("started_at"), F.max("at").cast("timestamp_ntz").alias("ended_at"),
        F.count(F.lit(1)).alias("events_count")).select("user_id", "started_at", "ended_at", "events_count")


def run_sessions_load(spark: SparkSession, source_dir: str, clock_dir: str, sink_path: str, checkpoint_path: str,
                      now: dt.datetime, gap_seconds: int, file_glob: str = "events.parquet", lateness: str = "1 hour",
                      max_bytes: int = MAX_BYTES) -> None:
    """One load of what arrived up to ``now``: appends the sessions that closed."""
    spark.createDataFrame([(now,)], CLOCK).coalesce(1).write.mode("append").parquet(clock_dir)
    merge = spark.conf.get(LOCAL_MERGE)
    spark.conf.set(LOCAL_MERGE, "true")
    try:
        with rocksdb_state(spark):
            stream = sessions_stream(spark, source_dir, clock_dir, gap_seconds, file_glob, lateness, max_bytes)
            q = (stream.writeStream.format("parquet").option("path", sink_path).option("checkpointLocation", checkpoint_path)
                 .outputMode("append").trigger(availableNow=True).start())
            q.awaitTermination()
    finally:
        spark.conf.set(LOCAL_MERGE, merge)


def read_sessions(spark: SparkSession, sink_path: str) -> DataFrame:
    """The closed sessions with ``session_index``, from 0 per user in the order of their start."""
    closed = spark.read.schema(CLOSED).parquet(sink_path).where("user_id IS NOT NULL")
    numbered = with_neighbours(closed, ["user_id"], ["started_at"], {}, index="session_index")
    return numbered.select("user_id", "session_index", "started_at", "ended_at", "events_count")


def stream_sessions(spark: SparkSession, sf_dir: str, p: Params) -> DataFrame:
    """One load of the event files, its clock far enough past the events' to close every session."""
    clocks, sink, ckpt = (new_work_path(spark, f"sessions-{x}") for x in ("clocks", "sink", "ckpt"))
    gap = p.session_gap_minutes * 60
    now = p.clock("app_db", "events") + dt.timedelta(seconds=gap, hours=2)
    run_sessions_load(spark, sf_dir, clocks, sink, ckpt, now, gap)
    return read_sessions(spark, sink)
