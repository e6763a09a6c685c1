"""Registered load queries over the app tables (A3, B1, B7, B8) and the seed
generators (T1-T3) driven by ids from the test tables.  Pure DataFrame forms of
the loader steps in :mod:`monthwise.sources.incremental` (no files written)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.scalar import ntz_lit
from monthwise.params import CORRECTED, Params
from monthwise.sources import schemas, seedgen
from monthwise.session import new_work_path
from monthwise.sources.incremental import (APP_TABLES, fetch_predicates, incremental_batch, latest_by_key,
                                           mark_histogram, run_loads, upper_case_columns, upsert_latest)
from monthwise.sources.registry import Sources

# The previous run's control state for the registered queries: only ``events``
# has a mark (so the run updates one row and inserts the other tables).
PREVIOUS_MARKS = {"events": "events_mark"}


def _prev_mark(table: str, p: Params) -> dt.datetime | None:
    attr = PREVIOUS_MARKS.get(table)
    return getattr(p, attr) if attr else None


def incremental_extract(src: Sources, p: Params) -> DataFrame:
    """A3 + A5 + B2: the events rows past the stored mark, stamped and upper-cased."""
    batch = incremental_batch(src("app_db", "events"), "occurred_at", p.events_mark, p.clock("app_db", "events"), p.mode)
    return upper_case_columns(batch)


# The integer key by which a day too large for one fetch is sliced; sessions have none.
FETCH_KEYS = {"users": "id", "subscriptions": "id", "events": "event_id", "sessions": None}
FETCH_PARTS = 16


def fetch_parts(src: Sources, p: Params) -> DataFrame:
    """A4: the parts in which a partitioned fetch reads each app table: rows, first and last
    mark of every part, rows dealt by the predicates the fetch hands to the database."""
    out = []
    for spec in APP_TABLES:
        table, mark = src("app_db", spec.name), F.col(spec.watermark_col)
        predicates = fetch_predicates(spec.watermark_col, mark_histogram(table, spec.watermark_col), FETCH_PARTS,
                                      FETCH_KEYS[spec.name])
        part = F.expr("CASE " + " ".join(f"WHEN {q} THEN {i}" for i, q in enumerate(predicates)) + " END")
        out.append(table.groupBy(part.alias("part")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(mark).alias("first_mark"), F.max(mark).alias("last_mark"))
            .select(F.lit(spec.name).alias("table_name"), "part", "n_rows", "first_mark", "last_mark"))
    return _union(out)


def _run_rows(src: Sources, p: Params) -> list[tuple[str, DataFrame, dt.datetime, str]]:
    out = []
    for spec in APP_TABLES:
        now = p.clock("app_db", spec.name)
        batch = incremental_batch(src("app_db", spec.name), spec.watermark_col, _prev_mark(spec.name, p), now,
                                  p.mode)
        out.append((spec.name, batch, now, spec.watermark_col))
    return out


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def load_summary(src: Sources, p: Params) -> DataFrame:
    """One row per loaded table (status, rows); counts are one aggregate each."""
    return _union([b.agg(F.lit(t).alias("table_name"),
                         F.when(F.count(F.lit(1)) == 0, "empty").otherwise("success").alias("status"),
                         F.count(F.lit(1)).alias("rows_loaded"), F.lit(None).cast("string").alias("error"))
                   for t, b, _, _ in _run_rows(src, p)])


def loader_roundtrip(src: Sources, p: Params) -> DataFrame:
    """B1-B8 + Q10 through the loader itself: two loads into one raw folder and state
    table, the second with later events and with a table that fails (its source is
    not there).  Per run and table: outcome, rows loaded, columns without a
    value, and the rows of the raw table after it."""
    spark = src.spark
    state, raw = new_work_path(spark, "loader-state"), new_work_path(spark, "loader-raw")
    events = src("app_db", "events")
    frames = {t: src("app_db", t) for t in ("users", "subscriptions", "events", "sessions")}
    clocks = {s.name: p.clock("app_db", s.name) for s in APP_TABLES}
    first = run_loads(spark, {**frames, "events": events.where(F.col("occurred_at") <= ntz_lit(p.events_mark))},
                      state, raw, {**clocks, "events": p.events_mark}, mode=p.mode)
    counts = [_raw_counts(spark, raw, 1)]
    second = run_loads(spark, {**frames, "users": lambda spec: spark.read.parquet(f"{raw}/lost/{spec.name}")}, state, raw, clocks, mode=p.mode)
    counts.append(_raw_counts(spark, raw, 2))
    runs = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return runs.join(_union(counts), ["run", "table_name"]).select(
        "run", "table_name", "status", "rows_loaded", "all_null_columns", F.col("error").isNotNull().alias("has_error"),
        "raw_rows")


def _raw_counts(spark, raw: str, run: int) -> DataFrame:
    """Rows of the raw tables as they are now (one row per table)."""
    rows = [(run, s.name, spark.read.parquet(f"{raw}/{s.name}").count()) for s in APP_TABLES]
    return spark.createDataFrame(rows, "run int, table_name string, raw_rows bigint")


def watermark_upsert(src: Sources, p: Params) -> DataFrame:
    """Previous control state upserted with this run's marks (latest wins)."""
    ev = src("app_db", "events")
    prev = ev.filter(F.col("occurred_at") <= ntz_lit(p.events_mark)).agg(
        F.lit("events").alias("table_name"), ntz_lit(p.events_mark).alias("last_extracted"),
        F.count(F.lit(1)).alias("rows_extracted"), ntz_lit(p.events_mark).alias("updated_at"))
    ups = []
    for t, b, now, wm in _run_rows(src, p):
        mark = F.coalesce(F.max(wm), ntz_lit(_prev_mark(t, p)) if _prev_mark(t, p) else F.lit(None)) \
            if p.mode == CORRECTED else ntz_lit(now)
        ups.append(b.agg(F.lit(t).alias("table_name"), mark.cast("timestamp_ntz").alias("last_extracted"),
                         F.count(F.lit(1)).alias("rows_extracted"), ntz_lit(now).alias("updated_at")))
    state = prev.select(*[F.col(f.name).cast(f.dataType) for f in schemas.WATERMARKS.fields])
    return upsert_latest(state, _union(ups))


def load_latest_by_key(src: Sources, p: Params) -> DataFrame:
    """B1 + dedup: the raw events table after a full load at the mark and a later
    load that re-appends the last day before it (the duplicate a whole-table
    retry or a clock-based mark produces); latest load wins per event id."""
    ev = src("app_db", "events")
    first = incremental_batch(ev.filter(F.col("occurred_at") <= ntz_lit(p.events_mark)), "occurred_at", None,
                              p.events_mark)
    second = incremental_batch(ev, "occurred_at", p.events_mark - dt.timedelta(days=1),
                               p.clock("app_db", "events"))
    return latest_by_key(first.unionByName(second), ["event_id"], "_loaded_at")


# -------------------------------------------------------------------------- seeds
def seed_users(src: Sources, p: Params) -> DataFrame:
    ids = src("tpch", "customer").select((F.col("c_custkey") + 1).alias("i"))
    return seedgen.seed_users(ids, p.as_of)


def seed_subscriptions(src: Sources, p: Params) -> DataFrame:
    """One subscription per organisation that has a user."""
    ids = src("tpch", "customer").select(
        F.ceil((F.col("c_custkey") + 1) / seedgen.USERS_PER_ORG).cast("bigint").alias("i")).distinct()
    return seedgen.seed_subscriptions(ids, p.as_of)


def seed_events(src: Sources, p: Params) -> DataFrame:
    ids = src("tpch", "orders").select((F.col("o_orderkey") + 1).alias("i"))
    n_users = src("tpch", "customer").agg(F.max(F.col("c_custkey") + 1)).scalar()
    return seedgen.seed_events(ids, p.as_of, n_users)
