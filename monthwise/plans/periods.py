"""M5 ``subscription_periods``: one row per (subscription, active month)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.functions.scalar import MONEY
from monthwise.operators.range_expand import expand_months
from monthwise.params import CORRECTED, Params
from monthwise.plans.staging import stg_subscriptions
from monthwise.sources.registry import Sources

PERIOD_COLUMNS = [
    "subscription_id", "customer_id", "plan_id", "month_start", "plan_type", "billing_cycle",
    "subscription_status", "mrr", "is_first_month", "is_churn_month", "period_start_at",
    "canceled_at", "trial_start_at", "trial_end_at",
]


def normalised_mrr_sql(cycle: str, dollars: str) -> str:
    """Annual plans / 12, monthly as is, anything else falls back to monthly."""
    return (f"CAST(CASE WHEN {cycle} = 'annual' THEN {dollars} / 12 WHEN {cycle} = 'monthly' THEN {dollars} "
            f"ELSE {dollars} END AS {MONEY})")


def normalised_mrr(cycle: str, dollars: str) -> F.Column:
    return F.expr(normalised_mrr_sql(cycle, dollars))


def start_column(p: Params) -> str:
    """Where a subscription's months start.  Exact: the current billing period (earlier
    history is lost); corrected: the subscription's creation."""
    return "created_at" if p.mode == CORRECTED else "period_start_at"


def billable_subscriptions(src: Sources, p: Params) -> DataFrame:
    """Subscriptions with a positive amount, their MRR and active-month bounds
    (``__lo`` inclusive, ``__hi`` exclusive), one row per subscription."""
    s = stg_subscriptions(src, p).where("plan_amount_dollars > 0")
    return s.withColumns({
        "mrr": normalised_mrr("billing_cycle", "plan_amount_dollars"),
        "__lo": F.expr(S.month_of(start_column(p))),
        "__cancel_month": F.expr(S.month_of("canceled_at")),
    }).withColumn("__hi", F.expr(open_until(p)))


def open_until(p: Params) -> str:
    """The exclusive last month of a subscription, from its ``__cancel_month``."""
    hi = f"coalesce(__cancel_month, {S.date(p.open_end)})"
    if p.mode == CORRECTED:
        # keep the cancel month itself, as a zero-MRR churn row
        hi = f"CASE WHEN __cancel_month IS NOT NULL THEN add_months({hi}, 1) ELSE {hi} END"
    return hi


def with_month_flags(df: DataFrame, p: Params) -> DataFrame:
    """First-month and churn-month flags of expanded rows.  Both months are
    per-subscription constants computed before the expansion (``__lo`` is the
    start month in either mode), so each expanded row only compares dates."""
    first = S.flag("__lo = month_start")
    churn = S.flag("__cancel_month = month_start")
    cols = {"is_first_month": F.expr(first), "is_churn_month": F.expr(churn)}
    if p.mode == CORRECTED:
        cols["mrr"] = F.expr(f"CASE WHEN {churn} THEN CAST(0 AS {MONEY}) ELSE mrr END")
    return df.withColumns(cols)


def subscription_periods(src: Sources, p: Params) -> DataFrame:
    subs = billable_subscriptions(src, p)
    ex = expand_months(subs, "__lo", "__hi", p.spine_start, p.spine_end)
    return with_month_flags(ex, p).select(*PERIOD_COLUMNS)


def date_spine(src: Sources, p: Params) -> DataFrame:
    """H11 calendar spine from the subscriptions' first start month, though not before
    ``spine_start``, to the current (as_of) month; empty if that first month lies past it.
    Bounds come from one global min aggregate; the spine itself is bounded by the calendar."""
    lo = stg_subscriptions(src, p).agg(F.expr(
        f"greatest(min({S.month_of(start_column(p))}), {S.date(p.spine_start)})").alias("lo"))
    return lo.where(f"lo <= {S.date(p.spine_end)}").selectExpr(
        f"explode(sequence(lo, {S.date(p.spine_end)}, INTERVAL 1 MONTH)) AS month_start")
