"""Sessions from events (gap-based), split so that a hot user never lands in
one task.

Events of one user within a time slice no longer than the gap belong to one session,
whatever lies between them.  So events are first aggregated per (user, slice) - combined
map-side, a hot user leaves each task as one row per slice - and only slices are
ordered per user: a slice opens a session when its first event comes more than the gap
after the last event of the slice before it.  The per-user ordered work is bounded by
the calendar (one row per slice), not by the number of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.params import Params


def sessionize(events: DataFrame, user: str, ts: str, gap_seconds: int,
               extra: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """One row per (user, session): ``session_index`` (0-based per user),
    ``started_at``, ``ended_at``, ``events_count`` and the ``extra`` aggregates, given as
    name -> (SQL aggregate over events, SQL function that merges it).  A new session
    starts after a gap of more than ``gap_seconds`` (compared in microseconds)."""
    extra = extra or {}
    gap = gap_seconds * 1_000_000
    micros = f"unix_micros(CAST({ts} AS TIMESTAMP))"
    slices = (
        events.where(f"{user} IS NOT NULL AND {ts} IS NOT NULL")
        .groupBy(user, F.expr(f"{micros} div {max(gap, 1)}").alias("__slice"), F.expr(f"{micros} < 0").alias("__old"))
        .agg(F.expr(f"min({ts})").alias("__first"), F.expr(f"max({ts})").alias("__last"),
             F.expr("count(1)").alias("__n"), *[F.expr(one).alias(f"__{name}") for name, (one, _) in extra.items()]))
    by_time = f"PARTITION BY {user} ORDER BY __first"
    gap_before = (f"unix_micros(CAST(__first AS TIMESTAMP)) - lag(unix_micros(CAST(__last AS TIMESTAMP))) "
                  f"OVER ({by_time})")
    slices = slices.withColumn("__new", F.expr(f"CAST(coalesce({gap_before} > {gap}, true) AS INT)"))
    slices = slices.withColumn("session_index", F.expr(
        f"CAST(sum(__new) OVER ({by_time} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS BIGINT)"))
    return slices.groupBy(user, "session_index").agg(
        F.expr("min(__first)").alias("started_at"), F.expr("max(__last)").alias("ended_at"),
        F.expr("sum(__n)").alias("events_count"),
        *[F.expr(f"{merge}(__{name})").alias(name) for name, (_, merge) in extra.items()])


def app_sessions(events: DataFrame, p: Params) -> DataFrame:
    """The ``app_db.sessions`` table: sessions of the app events (30-minute gap)."""
    s = sessionize(events, "user_id", "occurred_at", p.session_gap_minutes * 60, {
        "page_views": ("count(CASE WHEN event_name = 'view' THEN 1 END)", "sum"),
        "_loaded_at": ("max(_loaded_at)", "max")})
    return s.selectExpr(
        f"substring({S.surrogate_key('user_id', 'started_at')}, 1, 32) AS session_id",
        "user_id", "started_at", "ended_at", "page_views", "events_count", "_loaded_at", "session_index")
