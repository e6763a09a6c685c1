"""The declared data-quality suite and the freshness / load checks (Q1-Q11).

Check lists are the reference's declared column tests, stated as data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.functions.scalar import hours_between_boundaries, ntz_lit, ntz_to_epoch
from monthwise.operators.quality import (ACCEPTED, BETWEEN, NOT_NULL, UNIQUE, Check, batch_profile,
                                         no_future_dates_failures, positive_values_failures, run_checks)
from monthwise.params import Params
from monthwise.plans.periods import billable_subscriptions
from monthwise.plans.staging import stg_accounts
from monthwise.session import new_work_path
from monthwise.sources.registry import Sources

# Accepted value lists of the declared tests.
STRIPE_SUBSCRIPTION_STATUSES = ("active", "canceled", "incomplete", "incomplete_expired", "past_due",
                                "trialing", "unpaid")
OPPORTUNITY_STAGES = ("Prospecting", "Qualification", "Needs Analysis", "Value Proposition",
                      "Closed Won", "Closed Lost")
MRR_TYPES = ("new", "expansion", "contraction", "churn", "reactivation", "retained")
SEGMENTS = ("SMB", "Mid-Market", "Enterprise", "Strategic")


def _uq_nn(model: str, col: str) -> list[Check]:
    return [Check(model, col, UNIQUE), Check(model, col, NOT_NULL)]


SOURCE_CHECKS: list[Check] = [
    *_uq_nn("stripe.subscriptions", "id"),
    Check("stripe.subscriptions", "customer", NOT_NULL),
    Check("stripe.subscriptions", "status", ACCEPTED, STRIPE_SUBSCRIPTION_STATUSES),
    *_uq_nn("stripe.invoices", "id"),
    Check("stripe.invoices", "subscription", NOT_NULL),
    Check("stripe.invoices", "amount_due", NOT_NULL),
    *_uq_nn("stripe.customers", "id"),
    *_uq_nn("stripe.charges", "id"),
    *_uq_nn("salesforce.account", "id"),
    Check("salesforce.account", "name", NOT_NULL),
    *_uq_nn("salesforce.opportunity", "id"),
    Check("salesforce.opportunity", "stage_name", ACCEPTED, OPPORTUNITY_STAGES),
    *_uq_nn("salesforce.contact", "id"),
    *_uq_nn("app_db.users", "id"),
    *_uq_nn("app_db.users", "email"),
    Check("app_db.users", "created_at", NOT_NULL),
    *_uq_nn("app_db.subscriptions", "id"),
    *_uq_nn("app_db.events", "event_id"),
    Check("app_db.events", "user_id", NOT_NULL),
    Check("app_db.events", "event_name", NOT_NULL),
    Check("app_db.events", "occurred_at", NOT_NULL),
    *_uq_nn("app_db.sessions", "session_id"),
]

# The fact's key is a hash of these two columns.
MRR_KEY = Check("fct_mrr", "mrr_id", UNIQUE, key_of=("subscription_id", "month_start"))

MART_CHECKS: list[Check] = [
    MRR_KEY,
    Check("fct_mrr", "mrr_id", NOT_NULL),
    Check("fct_mrr", "month_start", NOT_NULL),
    Check("fct_mrr", "subscription_id", NOT_NULL),
    Check("fct_mrr", "customer_id", NOT_NULL),
    Check("fct_mrr", "mrr", NOT_NULL),
    Check("fct_mrr", "mrr", BETWEEN, min_value=0, max_value=1_000_000),
    Check("fct_mrr", "mrr_type", NOT_NULL),
    Check("fct_mrr", "mrr_type", ACCEPTED, MRR_TYPES),
    Check("fct_mrr", "account_segment", ACCEPTED, SEGMENTS, where="account_segment is not null"),
    Check("fct_mrr", "arr", NOT_NULL),
    *_uq_nn("dim_accounts", "account_id"),
    Check("dim_accounts", "stripe_customer_id", UNIQUE),
    Check("dim_accounts", "account_name", NOT_NULL),
    Check("dim_accounts", "account_segment", NOT_NULL),
    Check("dim_accounts", "account_segment", ACCEPTED, SEGMENTS),
    Check("rpt_monthly_revenue", "month_start", NOT_NULL),
    Check("rpt_monthly_revenue", "account_segment", NOT_NULL),
    Check("rpt_monthly_revenue", "total_mrr", NOT_NULL),
    Check("rpt_monthly_revenue", "total_mrr", BETWEEN, min_value=0, max_value=100_000_000),
]

ALL_CHECKS = SOURCE_CHECKS + MART_CHECKS

# Source freshness limits (warn hours, error hours) and loaded-at columns.
FRESHNESS = {
    "stripe": ("_fivetran_synced", 6, 24, ["subscriptions", "invoices", "customers", "charges"]),
    "salesforce": ("_fivetran_synced", 8, 48, ["account", "opportunity", "contact"]),
    "app_db": ("_loaded_at", 2, 6, ["users", "subscriptions", "events", "sessions"]),
}
# Pre-run stale-source probe: table -> max age in hours.
STALE_PROBE = [("stripe", "subscriptions", 6), ("salesforce", "account", 8),
               ("app_db", "users", 2), ("app_db", "events", 2)]


def repeated_mrr_ids(src: Sources, p: Params) -> DataFrame:
    """(failures): how many values of the fact's key repeat, from the bounds of the rows that
    it is expanded from, without the fact.

    The key is (subscription id, month).  It repeats exactly in the months that two source rows
    of one id share, or where a row's account key repeats, so that its months fan out.  Every
    row opens with its weight (the accounts it meets) in its first month and closes after its
    last; openings are summed per (id, month) before they meet, so an id's ordered work is
    bounded by the calendar.  Where the running weight is 2 or more, the months repeat."""
    fan = (stg_accounts(src, p).where("stripe_customer_id IS NOT NULL").groupBy(F.col("stripe_customer_id").alias("__k"))
           .agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    first, last = f"greatest(__lo, {S.date(p.spine_start)})", f"least(add_months(__hi, -1), {S.date(p.spine_end)})"
    rows = (billable_subscriptions(src, p).selectExpr("subscription_id", "customer_id", f"{first} AS first", f"{last} AS last")
            .where("first <= last").join(fan, F.expr("customer_id = __k"), "left")
            .selectExpr("subscription_id", "inline(array(struct(first AS month, coalesce(__n, 1) AS w), "
                        "struct(add_months(last, 1) AS month, -coalesce(__n, 1) AS w)))"))
    steps = rows.groupBy("subscription_id", "month").agg(F.sum("w").alias("w"))
    by_id = Window.partitionBy("subscription_id").orderBy("month")
    steps = steps.select("month", F.sum("w").over(by_id).alias("depth"), F.lead("month").over(by_id).alias("until"))
    months = F.expr("(year(until) - year(month)) * 12 + month(until) - month(month)").cast("long")
    return steps.where("depth >= 2").agg(F.coalesce(F.sum(months), F.lit(0).cast("long")).alias("failures"))


def _tables(src: Sources, p: Params, checks: list[Check]) -> dict[str, DataFrame]:
    """The tables that ``checks`` read.  The fact is computed only if a check reads its rows, and
    written once with the columns that are read."""
    from monthwise.plans.accounts import dim_accounts
    from monthwise.plans.mrr import fct_mrr
    from monthwise.plans.reports import FACT_INPUT, monthly_revenue_from_fact
    models = {c.model for c in checks}
    out = {m: src(*m.split(".", 1)) for m in sorted(models) if "." in m}
    if "dim_accounts" in models:
        out["dim_accounts"] = dim_accounts(src, p)
    if models & {"fct_mrr", "rpt_monthly_revenue"}:
        mine = [c for c in checks if c.model == "fct_mrr"]
        read = {x for c in mine for x in (c.key_of or (c.column,))}
        if "rpt_monthly_revenue" in models:
            read |= set(FACT_INPUT)
        fact = fct_mrr(src, p)
        path = new_work_path(src.spark, "checked-fact")
        fact.select(*[c for c in fact.columns if c in read or any(c in (ch.where or "") for ch in mine)]).write.parquet(path)
        out["fct_mrr"] = src.spark.read.parquet(path)
        if "rpt_monthly_revenue" in models:
            out["rpt_monthly_revenue"] = monthly_revenue_from_fact(out["fct_mrr"])
    return out


def never_null(src: Sources, p: Params, checks: list[Check]) -> dict[Check, DataFrame]:
    """``not_null`` checks on columns of the fact that cannot be NULL by their expression (the
    key is a hash of columns with a stand-in for NULL): 0 failures without computing them."""
    from monthwise.plans.mrr import fct_mrr
    if not checks:
        return {}
    schema = fct_mrr(src, p).schema
    none = src.spark.range(1).selectExpr("CAST(0 AS BIGINT) AS failures")
    return {c: none for c in checks if not schema[c.column].nullable}


def _suite(kind: str | None, checks: list[Check]):
    chosen = [c for c in checks if kind is None or c.test == kind]

    def run(src: Sources, p: Params) -> DataFrame:
        # nothing is stored here: the fact's key is checked where its rows come from
        counted = {MRR_KEY: repeated_mrr_ids(src, p)} if MRR_KEY in chosen else {}
        counted |= never_null(src, p, [c for c in chosen if c.model == "fct_mrr" and c.test == NOT_NULL])
        tables = _tables(src, p, [c for c in chosen if c not in counted])
        return run_checks(tables, chosen, p.as_of, counted)
    return run


dq_unique = _suite(UNIQUE, ALL_CHECKS)
dq_not_null = _suite(NOT_NULL, ALL_CHECKS)
dq_accepted_values = _suite(ACCEPTED, ALL_CHECKS)
dq_between = _suite(BETWEEN, ALL_CHECKS)
dq_gate_summary = _suite(None, MART_CHECKS)      # the schedule's gate: marts + reporting
dq_source_tests = _suite(None, SOURCE_CHECKS)


def dq_no_future_dates(src: Sources, p: Params) -> DataFrame:
    """The custom test, applied to subscription cancel timestamps (some lie after as_of)."""
    from monthwise.plans.staging import stg_subscriptions
    return no_future_dates_failures(stg_subscriptions(src, p), "canceled_at", p.as_of)


def dq_positive_values(src: Sources, p: Params) -> DataFrame:
    """The custom test, applied to staged plan amounts (zero-priced plans fail)."""
    from monthwise.plans.staging import stg_subscriptions
    s = stg_subscriptions(src, p).select("subscription_id", "plan_amount_dollars")
    return positive_values_failures(s, "plan_amount_dollars")


def newest_load(raw: DataFrame) -> DataFrame:
    """The rows of the newest load date where the loader partitioned the table by it: the latest
    load is among them, so the other folders are not read.  Other tables stay whole."""
    day = next((c for c in raw.columns if c.upper() == "LOAD_DATE"), None)
    return raw if day is None else raw.where(F.col(day) == raw.agg(F.max(day)).scalar())


def source_freshness(src: Sources, p: Params) -> DataFrame:
    """Q7: ``max(loaded_at)`` per source table vs the table's clock -> pass / warn / error.
    Age is elapsed seconds; a table with no rows (NULL max) is an error."""
    parts = []
    for system, (col, warn_h, err_h, tables) in FRESHNESS.items():
        for t in tables:
            as_of = p.clock(system, t)
            agg = newest_load(src(system, t)).agg(F.max(col).alias("max_loaded_at"))
            age = ntz_to_epoch(ntz_lit(as_of)) - ntz_to_epoch(F.col("max_loaded_at"))
            parts.append(agg.select(
                F.lit(system).alias("source_name"), F.lit(t).alias("table_name"), "max_loaded_at",
                ntz_lit(as_of).alias("snapshotted_at"), age.cast("bigint").alias("age_seconds"),
                F.lit(warn_h).alias("warn_after_hours"), F.lit(err_h).alias("error_after_hours"),
                F.when(F.col("max_loaded_at").isNull() | (age > err_h * 3600), "error")
                 .when(age > warn_h * 3600, "warn").otherwise("pass").alias("status")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def stale_sources(src: Sources, p: Params) -> DataFrame:
    """Q8: pre-run probe - hours since the latest load (hour boundaries crossed),
    stale when over the limit.  Reads each source's own loaded-at column, and only
    a missing value (empty table) counts as unknown age, never an age of 0."""
    parts = []
    for system, table, max_h in STALE_PROBE:
        col = FRESHNESS[system][0]
        as_of = p.clock(system, table)
        agg = newest_load(src(system, table)).agg(F.max(col).alias("latest_sync"))
        hours = hours_between_boundaries(F.col("latest_sync"), ntz_lit(as_of))
        parts.append(agg.select(
            F.lit(f"{system}.{table}").alias("table_name"), "latest_sync",
            hours.alias("hours_old"), F.lit(max_h).alias("max_hours"),
            (F.col("latest_sync").isNull() | (hours > max_h)).alias("is_stale")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def all_null_columns(src: Sources, p: Params) -> DataFrame:
    """Q10 over this run's batch of every loaded table (events: past the mark)."""
    from monthwise.sources.incremental import APP_TABLES, incremental_batch
    parts = []
    for spec in APP_TABLES:
        mark = p.events_mark if spec.name == "events" else None
        batch = incremental_batch(src("app_db", spec.name), spec.watermark_col, mark, p.clock("app_db", spec.name))
        parts.append(batch_profile(batch, spec.name))
    return reduce(DataFrame.unionByName, parts)


def row_counts(src: Sources, p: Params) -> DataFrame:
    """Q11: load confirmation - row count per app table (union all of counts), from the
    file footers."""
    parts = [src.counted("app_db", t).agg(F.lit(t).alias("tbl"), F.count(F.lit(1)).alias("row_count"))
             for t in ("users", "subscriptions", "events")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out
