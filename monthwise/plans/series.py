"""M9 applied to a series that reaches every movement arm: order totals per
customer and month, zero-filled from the customer's first month to the month of
``as_of``, or to the customer's last month with orders if that is later."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.functions.spine import month_sequence
from monthwise.operators.movement import CHURN, CONTRACTION, EXPANSION, NEW, REACTIVATION, add_movement
from monthwise.params import CORRECTED, Params
from monthwise.sources.registry import Sources


def zero_filled_monthly_totals(orders: DataFrame, p: Params) -> DataFrame:
    """(customer_key, month_start, order_cents, prior_cents) with a zero row for
    every month without orders from the customer's first month to the later of the
    last month with orders and the month of ``as_of``; ``prior_cents`` is the previous
    row of that series.  No order is left out.

    Totals are aggregated first (map-side combined, so a hot customer shrinks to
    one row per month per task); the gaps are then filled by expanding each
    month up to the next month with orders (``lead``), so the per-customer
    ordered work is bounded by the number of months, never by order count."""
    end = F.lit(p.spine_end)
    monthly = orders.where("o_orderdate IS NOT NULL").groupBy(F.col("o_custkey").alias("customer_key"),
                        F.expr(S.month_of("o_orderdate")).alias("month_start")).agg(
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
    w = Window.partitionBy("customer_key").orderBy("month_start")
    fill_to = F.coalesce(F.add_months(F.lead("month_start").over(w), -1), F.greatest("month_start", end))
    # the row before this month in the zero-filled series: NULL at the first
    # month, the previous total when that month is adjacent, else a filled zero
    prior_first = F.expr("CASE WHEN lag(month_start) OVER (PARTITION BY customer_key ORDER BY month_start) "
                         "IS NULL THEN NULL WHEN lag(month_start) OVER (PARTITION BY customer_key ORDER BY "
                         "month_start) = add_months(month_start, -1) THEN lag(cents) OVER (PARTITION BY "
                         "customer_key ORDER BY month_start) ELSE 0 END")
    g = monthly.withColumns({"__to": fill_to, "__prior0": prior_first})
    g = g.select("customer_key", "cents", "__prior0",
                 F.posexplode(month_sequence(F.col("month_start"), F.col("__to"))).alias("__pos", "month_start"))
    # lag over the zero-filled series, from the position: pos 0 -> __prior0,
    # pos 1 -> this month's total, later filled months -> 0
    return g.selectExpr(
        "customer_key", "month_start",
        "CAST(CASE WHEN __pos = 0 THEN cents ELSE 0 END AS BIGINT) AS order_cents",
        "CAST(CASE WHEN __pos = 0 THEN __prior0 WHEN __pos = 1 THEN cents ELSE 0 END AS BIGINT) AS prior_cents")


def movement_series(src: Sources, p: Params) -> DataFrame:
    """Movement classes over the zero-filled series.  ``lag`` over a month
    series is fixed by the expansion (see :func:`zero_filled_monthly_totals`),
    so only the monthly totals are ordered - never the filled rows."""
    s = zero_filled_monthly_totals(src("tpch", "orders"), p)
    return add_movement(s, "order_cents", "prior_cents", change_col="cents_change", type_col="movement",
                        mode=p.mode)


def movement_waterfall(src: Sources, p: Params) -> DataFrame:
    """Monthly waterfall over the corrected series, in which every movement occurs.  The
    series has one row per (customer, month), so distinct customers are plain counts."""
    s = movement_series_corrected(src, p)

    def cents(kind: str, value: str) -> str:
        return f"CAST(sum(CASE WHEN movement = '{kind}' THEN {value} ELSE 0 END) AS BIGINT)"
    return s.groupBy("month_start").agg(
        F.expr("CAST(sum(order_cents) AS BIGINT)").alias("total_cents"),
        F.expr(cents(NEW, "order_cents")).alias("new_cents"),
        F.expr(cents(EXPANSION, "cents_change")).alias("expansion_cents"),
        F.expr(cents(CONTRACTION, "cents_change")).alias("contraction_cents"),
        F.expr(cents(CHURN, "prior_cents")).alias("churned_cents"),
        F.expr(cents(REACTIVATION, "order_cents")).alias("reactivation_cents"),
        F.expr("count(CASE WHEN order_cents > 0 THEN customer_key END)").alias("active_customers"),
        F.expr(f"count(CASE WHEN movement = '{NEW}' THEN customer_key END)").alias("new_customers"),
        F.expr(f"count(CASE WHEN movement = '{CHURN}' THEN customer_key END)").alias("churned_customers"))


def movement_series_corrected(src: Sources, p: Params) -> DataFrame:
    return movement_series(src, p.with_(mode=CORRECTED))
