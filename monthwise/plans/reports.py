"""M8 ``rpt_monthly_revenue``: MRR totals, waterfall, customer counts, ARPU and
month-over-month growth per (month, segment)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.operators.movement import CHURN, CONTRACTION, EXPANSION, NEW, REACTIVATION
from monthwise.params import CORRECTED, Params
from monthwise.operators.ordered import with_neighbours
from monthwise.plans.mrr import fct_mrr
from monthwise.session import new_work_path
from monthwise.sources.registry import Sources

REPORT_COLUMNS = [
    "month_start", "account_segment", "total_mrr", "total_arr", "new_mrr", "expansion_mrr",
    "contraction_mrr", "churned_mrr", "reactivation_mrr", "active_customer_count",
    "new_customer_count", "churned_customer_count", "arpu", "prior_month_mrr", "mom_growth_rate",
]


# What the report reads of the fact.
FACT_INPUT = ["month_start", "account_segment", "customer_id", "mrr", "mrr_type", "mrr_change", "prior_month_mrr"]


def _sum_when_type(t: str, v: str) -> Column:
    return F.expr(f"sum(CASE WHEN mrr_type = '{t}' THEN {S.money_micros(v)} ELSE 0 END)")


def safe_ratio_sql(num: str, den: str) -> str:
    """``num / nullif(den, 0)`` as DOUBLE (ratios are computed last, from exact sums)."""
    return f"CASE WHEN {den} <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def monthly_revenue_from_fact(fact: DataFrame) -> DataFrame:
    """Two aggregation levels instead of three ``count(distinct)``s:

    * level 1 groups by (month, segment, customer): sums plus "any new / any
      churn" flags.  It is combined map-side, so a hot customer shrinks to one row
      per map task before the shuffle, and no ``Expand`` multiplies the fact.
    * level 2 groups ~one row per customer into (month, segment): distinct
      customer counts become plain counts of non-NULL customer ids.

    Level 1 sums exact micro-unit longs (a customer's monthly MRR is far below
    the long range; ANSI mode would raise, not wrap, on overflow); level 2 sums
    in DECIMAL, so the totals are exact at any size."""
    lvl1 = fact.groupBy("month_start", "account_segment", "customer_id").agg(
        F.expr(f"sum({S.money_micros('mrr')})").alias("mrr"),
        _sum_when_type(NEW, "mrr").alias("new_mrr"),
        _sum_when_type(EXPANSION, "mrr_change").alias("expansion_mrr"),
        _sum_when_type(CONTRACTION, "mrr_change").alias("contraction_mrr"),
        _sum_when_type(CHURN, "prior_month_mrr").alias("churned_mrr"),
        _sum_when_type(REACTIVATION, "mrr").alias("reactivation_mrr"),
        F.expr(f"max(CAST(mrr_type = '{NEW}' AS INT))").alias("any_new"),
        F.expr(f"max(CAST(mrr_type = '{CHURN}' AS INT))").alias("any_churn"),
    )
    rep = lvl1.groupBy("month_start", "account_segment").agg(
        F.expr(S.micros_sum_to_money("mrr")).alias("total_mrr"),
        F.expr(S.micros_sum_to_money("mrr * 12")).alias("total_arr"),
        *[F.expr(S.micros_sum_to_money(c)).alias(c) for c in
          ("new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr", "reactivation_mrr")],
        F.expr("count(customer_id)").alias("active_customer_count"),
        F.expr("count(CASE WHEN any_new = 1 THEN customer_id END)").alias("new_customer_count"),
        F.expr("count(CASE WHEN any_churn = 1 THEN customer_id END)").alias("churned_customer_count"),
    )
    # one lag, reused for the growth rate (the reference writes it three times)
    w = Window.partitionBy("account_segment").orderBy("month_start")
    rep = rep.withColumns({"arpu": F.expr(safe_ratio_sql("total_mrr", "active_customer_count")),
                           "prior_month_mrr": F.lag("total_mrr").over(w)})
    rep = rep.withColumn("mom_growth_rate",
                         F.expr(safe_ratio_sql("total_mrr - prior_month_mrr", "prior_month_mrr")))
    return rep.select(*REPORT_COLUMNS).orderBy(F.desc("month_start"), F.asc_nulls_last("account_segment"))


def monthly_revenue(src: Sources, p: Params) -> DataFrame:
    return monthly_revenue_from_fact(fct_mrr(src, p))


def monthly_revenue_corrected(src: Sources, p: Params) -> DataFrame:
    return monthly_revenue(src, p.with_(mode=CORRECTED))


def customer_bitmaps(fact: DataFrame) -> DataFrame:
    """(month_start, account_segment, bucket, active, new, churned): per month and segment the sets of
    customers as bitmaps of 32,768 dense customer numbers each.  Sets of any months and segments
    merge by ``bitmap_or_agg``, so exact distinct counts need neither the fact nor the customers again.

    Customers are numbered in their order, without one task for all of them.  The fact is reduced to
    a row per (month, segment, customer) within each task before it meets the numbers."""
    rows = fact.where("customer_id IS NOT NULL").groupBy("month_start", "account_segment", "customer_id").agg(
        F.expr(f"max(mrr_type = '{NEW}')").alias("is_new"), F.expr(f"max(mrr_type = '{CHURN}')").alias("is_churned"))
    path = new_work_path(fact.sparkSession, "customer-months")
    rows.write.parquet(path)                    # read twice
    rows = fact.sparkSession.read.parquet(path)
    numbers = with_neighbours(rows.select("customer_id").distinct(), [], ["customer_id"], {}, index="number")
    rows = rows.join(numbers.withColumn("number", F.col("number") + 1), "customer_id")       # buckets are 1..32768 and on
    bit = F.bitmap_bit_position("number")
    return rows.groupBy("month_start", "account_segment", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("active"), F.bitmap_construct_agg(F.when(F.col("is_new"), bit)).alias("new"),
        F.bitmap_construct_agg(F.when(F.col("is_churned"), bit)).alias("churned"))


def distinct_customers(bitmaps: DataFrame, *by) -> DataFrame:
    """Exact distinct customers per group of ``by`` (columns over month_start and account_segment)."""
    merged = bitmaps.groupBy(*by, "bucket").agg(*[F.bitmap_or_agg(c).alias(c) for c in ("active", "new", "churned")])
    return merged.drop("bucket").groupBy(*[c for c in merged.columns if c not in ("bucket", "active", "new", "churned")]).agg(
        *[F.sum(F.bitmap_count(c)).alias(f"{c}_customers") for c in ("active", "new", "churned")])


def quarterly_customers(src: Sources, p: Params) -> DataFrame:
    """E5 / E6 by quarter: distinct customers per segment and, as segment ``All``, over all of them."""
    path = new_work_path(src.spark, "customer-bitmaps")
    customer_bitmaps(fct_mrr(src, p)).write.parquet(path)
    bitmaps = src.spark.read.parquet(path)
    quarter = F.expr("CAST(date_trunc('quarter', month_start) AS DATE)").alias("quarter_start")
    return distinct_customers(bitmaps, quarter, "account_segment").unionByName(
        distinct_customers(bitmaps, quarter).withColumn("account_segment", F.lit("All")))
