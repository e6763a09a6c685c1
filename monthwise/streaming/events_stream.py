"""The append-only, high-volume events load as Structured Streaming.

File-source ``readStream`` -> event-time watermark -> ``dropDuplicatesWithinWatermark``
on the event -> tables by batch, run with ``trigger(availableNow=True)`` so each run
processes whatever arrived since the last one and stops.  The checkpoint (offsets +
dedup state) lives in the cluster's shared checkpoint folder and replaces the
watermark table for this table: a restarted or retried run resumes from the committed
offsets, and a replayed batch overwrites its own folders, so each batch counts once.

State is kept in RocksDB (spilling to disk, hash-partitioned by event) and batches are
bounded by ``max_bytes``, so a first load over a large history does not need memory for
all of it.

Events later than the watermark cannot be deduplicated against state that has expired,
and events without a time never enter it.  They are not lost: the batch that brings
them writes them to the side table ``late`` under its own id, before Spark commits the batch.
A driver that dies in between replays the batch, both tables included.  Which rows to look
at follows from the batches before: the operator can only have turned away rows no newer
than the greatest event time of an earlier batch less the lateness (the mark each
batch leaves).  Of those the ones whose key neither this batch nor an earlier one has
loaded are late, once each.  No run reads event files of an earlier one."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthwise.session import new_work_path
from monthwise.sources.incremental import table_or_none

# Schema of the driver's events table (the stream source files).
EVENTS_FILE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

LOADED = ("event_id bigint, user_id bigint, event_name string, event_properties string, "
          "occurred_at timestamp_ntz, __key string")
OUTPUT_COLUMNS = ["event_id", "user_id", "event_name", "event_properties", "occurred_at"]
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MAX_BYTES = 16 << 30     # input of one micro-batch


def event_rows(files: DataFrame) -> DataFrame:
    """Output columns and ``__key``, the identity of an event: its id, or the whole row
    where that is NULL."""
    whole = F.md5(F.to_json(F.struct("user_id", "event_type", "props", "ts", "value")))
    return files.select(
        "event_id", "user_id", F.col("event_type").alias("event_name"), F.col("props").alias("event_properties"),
        F.col("ts").alias("occurred_at"),
        F.coalesce(F.col("event_id").cast("string"), F.concat(F.lit("row:"), whole)).alias("__key"))


def event_files(spark: SparkSession, source_dir: str, file_glob: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    return (spark.readStream.schema(EVENTS_FILE_SCHEMA).option("pathGlobFilter", file_glob)
            .option("maxBytesPerTrigger", max_bytes).parquet(source_dir))


def events_stream(spark: SparkSession, source_dir: str, file_glob: str = "events.parquet",
                  lateness: str = "1 hour", max_bytes: int = MAX_BYTES) -> DataFrame:
    """Events in time, once each (``__on_time`` true), and beside them every row that came."""
    # watermarks need a zoned TIMESTAMP; the batch side keeps NTZ
    rows = event_rows(event_files(spark, source_dir, file_glob, max_bytes)).withColumn(
        "__event_time", F.col("occurred_at").cast("timestamp"))
    on_time = (rows.where("occurred_at IS NOT NULL").withWatermark("__event_time", lateness)
               .dropDuplicatesWithinWatermark(["__key"]))
    return on_time.withColumn("__on_time", F.lit(True)).unionByName(rows.withColumn("__on_time", F.lit(False)))


MARKS = "greatest timestamp, turned_away bigint"


class EventTables:
    """What a batch writes: its events in time below ``sink``, its late ones below ``late`` and its
    mark - the greatest event time so far, and how many rows were older than the mark
    before - below ``marks``, each in a folder of the batch that a replay overwrites."""

    def __init__(self, spark: SparkSession, sink: str, late: str, marks: str, lateness: str = "1 hour"):
        self.spark, self.lateness = spark, lateness
        self.sink, self.late, self.marks = (p.rstrip("/") for p in (sink, late, marks))

    def mark_before(self, batch: int):
        """The mark of the batch before (None for the first)."""
        last = table_or_none(self.spark, f"{self.marks}/batch={batch - 1}", MARKS) if batch else None
        return last.first()["greatest"] if last is not None else None

    def load(self, rows: DataFrame, batch: int) -> None:
        mark = self.mark_before(batch)
        old = F.lit(False) if mark is None else F.col("__event_time") <= F.lit(mark) - F.expr(f"INTERVAL {self.lateness}")
        suspect = ~F.col("__on_time") & (F.col("__event_time").isNull() | F.coalesce(old, F.lit(False)))
        seen = Observation(f"batch-{batch}")
        kept = rows.observe(seen, F.max("__event_time").alias("greatest"), F.count_if(suspect).alias("suspects"),
                            F.count_if(suspect & F.col("__event_time").isNotNull()).alias("turned_away"))
        # The batch is computed once and written in parts.
        kept = kept.where(F.col("__on_time") | suspect).persist()
        try:
            loaded = kept.where("__on_time").drop("__on_time", "__event_time")
            loaded.write.mode("overwrite").parquet(f"{self.sink}/batch={batch}")
            if seen.get["suspects"]:
                self.write_late(kept.where("NOT __on_time").drop("__on_time", "__event_time"), batch)
            greatest = max((x for x in (mark, seen.get["greatest"]) if x is not None), default=None)
            self.spark.createDataFrame([(greatest, seen.get["turned_away"])], MARKS).coalesce(1).write.mode(
                "overwrite").parquet(f"{self.marks}/batch={batch}")
        finally:
            kept.unpersist()

    def write_late(self, suspects: DataFrame, batch: int) -> None:
        """The suspects that no batch has loaded and no earlier one has kept as late."""
        keys = suspects.select("__key").distinct()
        for path in (self.sink, self.late):
            known = table_or_none(self.spark, path, f"{LOADED}, batch bigint")
            if known is not None:
                # The large side is only scanned for its keys; the suspects' few keys are the built side.
                mine = known.where(F.col("batch") <= batch if path == self.sink else F.col("batch") < batch)
                keys = keys.join(mine.select("__key").join(keys, "__key", "left_semi").distinct(), "__key", "left_anti")
        late = suspects.join(keys, "__key", "left_semi").dropDuplicates(["__key"])
        late.write.mode("overwrite").parquet(f"{self.late}/batch={batch}")

    def turned_away(self, first_batch: int) -> int:
        marks = table_or_none(self.spark, self.marks, f"{MARKS}, batch bigint")
        found = marks.where(F.col("batch") >= first_batch).agg(F.sum("turned_away")).first()[0] if marks is not None else 0
        return found or 0


def run_events_load(spark: SparkSession, source_dir: str, sink_path: str, checkpoint_path: str, late_path: str,
                    file_glob: str = "events.parquet", lateness: str = "1 hour", max_bytes: int = MAX_BYTES) -> int:
    """One load of what arrived; returns the number of rows older than the watermark allows
    (copies of loaded events among them)."""
    tables = EventTables(spark, sink_path, late_path, f"{checkpoint_path.rstrip('/')}-marks", lateness)
    batches: list[int] = []

    def load(rows: DataFrame, batch: int) -> None:
        batches.append(batch)
        tables.load(rows, batch)

    with rocksdb_state(spark):
        q = (events_stream(spark, source_dir, file_glob, lateness, max_bytes).writeStream.foreachBatch(load)
             .option("checkpointLocation", checkpoint_path).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    return tables.turned_away(min(batches)) if batches else 0


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started within keep their state in RocksDB."""
    store = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, store)


def read_late(spark: SparkSession, late_path: str) -> DataFrame | None:
    """The side table, or None if no run has written it."""
    return table_or_none(spark, late_path, LOADED)


def stream_events_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run one availableNow load of the events files into a fresh sink and return the
    loaded table with its late events."""
    sink, ckpt, late = (new_work_path(spark, f"events-{x}") for x in ("sink", "ckpt", "late"))
    run_events_load(spark, sf_dir, sink, ckpt, late)
    out, side = spark.read.schema(LOADED).parquet(sink), read_late(spark, late)
    out = out.select(*OUTPUT_COLUMNS)
    return out if side is None else out.unionByName(side.select(*OUTPUT_COLUMNS))
