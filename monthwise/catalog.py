"""Query catalogue: every registered query as ``(spark, sf_dir) -> DataFrame``
over the driver's test tables, with default parameters (FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthwise.fixture import FIXTURE
from monthwise.params import Params
from monthwise.session import ensure_utc
from monthwise.sources.registry import Sources

Query = Callable[[SparkSession, str], DataFrame]


def _model(fn, p: Params = FIXTURE) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_utc(spark)
        return fn(Sources.from_test_tables(spark, sf_dir, p), p)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from monthwise.streaming.events_stream import stream_events_dedup
    ensure_utc(spark)
    return stream_events_dedup(spark, sf_dir)


def _sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    from monthwise.streaming.sessions_stream import stream_sessions
    ensure_utc(spark)
    return stream_sessions(spark, sf_dir, FIXTURE)


def queries(p: Params = FIXTURE) -> dict[str, Query]:
    from monthwise.plans import accounts, build, growth, loads, mrr, periods, quality_suite as qs, reports, series, staging

    models = {
        # staging (M1-M4)
        "stg_subscriptions": staging.stg_subscriptions,
        "stg_invoices": staging.stg_invoices,
        "stg_accounts": staging.stg_accounts,
        "stg_users": staging.stg_users,
        # spine, range expansion, marts, report
        "date_spine": periods.date_spine,
        "subscription_periods": periods.subscription_periods,
        "dim_accounts": accounts.dim_accounts,
        "fct_mrr": mrr.fct_mrr,
        "fct_mrr_transfers": mrr.fct_mrr_transfers,
        "monthly_revenue": reports.monthly_revenue,
        "monthly_revenue_corrected": reports.monthly_revenue_corrected,
        "quarterly_customers": reports.quarterly_customers,
        # movement classifier on order totals (M9)
        "movement_classify": series.movement_series,
        "movement_classify_corrected": series.movement_series_corrected,
        "movement_waterfall": series.movement_waterfall,
        # data quality (Q1-Q11)
        "dq_unique": qs.dq_unique,
        "dq_not_null": qs.dq_not_null,
        "dq_accepted_values": qs.dq_accepted_values,
        "dq_between": qs.dq_between,
        "dq_no_future_dates": qs.dq_no_future_dates,
        "dq_positive_values": qs.dq_positive_values,
        "dq_gate_summary": qs.dq_gate_summary,
        "dq_source_tests": qs.dq_source_tests,
        "source_freshness": qs.source_freshness,
        "stale_sources": qs.stale_sources,
        "all_null_columns": qs.all_null_columns,
        "row_counts": qs.row_counts,
        # incremental loads
        "fetch_parts": loads.fetch_parts,
        "incremental_extract": loads.incremental_extract,
        "watermark_upsert": loads.watermark_upsert,
        "load_latest_by_key": loads.load_latest_by_key,
        "load_summary": loads.load_summary,
        "loader_roundtrip": loads.loader_roundtrip,
        # layered build
        "build_monthly_revenue": build.build_monthly_revenue,
        # seed generators
        "seed_users": loads.seed_users,
        "seed_subscriptions": loads.seed_subscriptions,
        "seed_events": loads.seed_events,
        # declared-only growth models
        "nrr": growth.nrr,
        "cohort_retention": growth.cohort_retention,
        "trial_conversions": growth.trial_conversions,
        "trial_funnel": growth.trial_funnel,
        "feature_adoption": growth.feature_adoption,
        "fct_subscriptions": growth.fct_subscriptions,
        "opportunity_stages": growth.opportunity_stages,
        "opportunity_velocity": growth.opportunity_velocity,
        "scd2_snapshot": growth.scd2_snapshot,
        "scd2_incremental": growth.scd2_incremental,
        "sessions": growth.sessions,
    }
    q: dict[str, Query] = {k: _model(f, p) for k, f in models.items()}
    q["stream_events_dedup"] = _stream      # X1
    q["stream_sessions"] = _sessions_stream      # N8
    return q
