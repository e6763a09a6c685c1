"""Checks and reports that do not read the expanded fact, against the fact itself."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from monthwise.fixture import FIXTURE
from monthwise.operators.quality import unique_failures
from monthwise.params import CORRECTED
from monthwise.plans import growth, quality_suite, reports
from monthwise.plans.mrr import fct_mrr
from monthwise.sources.registry import Sources

DAY = 86_400


def epoch(year, month, day=1):
    return int(dt.datetime(year, month, day, tzinfo=dt.timezone.utc).timestamp())


def with_subscriptions(spark, rows):
    """The test sources, their subscriptions replaced: (id, customer, start, cancel)."""
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    raw = src("stripe", "subscriptions")
    some = raw.where("NOT _fivetran_deleted AND plan_amount > 0").limit(1)
    made = spark.createDataFrame(rows, "n_id string, n_customer string, n_start long, n_cancel long")
    mine = made.crossJoin(F.broadcast(some)).withColumns({
        "id": F.col("n_id"), "customer": F.col("n_customer"), "created": F.col("n_start"), "current_period_start": F.col("n_start"),
        "canceled_at": F.col("n_cancel")}).select(*raw.columns)
    return src.replaced("stripe", "subscriptions", mine)


CASES = {
    "no repeat": [("a", "cus_1", epoch(1996, 1), epoch(1996, 4)), ("a", "cus_2", epoch(1996, 4), epoch(1996, 9)), ("b", "cus_1", epoch(1996, 1), None)],
    "overlap": [("a", "cus_1", epoch(1996, 1), epoch(1996, 6)), ("a", "cus_2", epoch(1996, 4, 20), epoch(1996, 9))],
    "three deep": [("a", "cus_1", epoch(1996, 1), epoch(1996, 6))] * 3 + [("a", "cus_2", epoch(1996, 5), epoch(1996, 8))],
    "nested and apart": [("a", "cus_1", epoch(1996, 1), epoch(1997, 1)), ("a", "cus_1", epoch(1996, 3), epoch(1996, 5)), ("a", "cus_1", epoch(1996, 9), epoch(1996, 10))],
    "open ends": [("a", "cus_1", epoch(1996, 1), None), ("a", "cus_2", epoch(1999, 1), None)],
    "before the calendar": [("a", "cus_1", epoch(1980, 1), epoch(1994, 12)), ("a", "cus_1", epoch(1980, 1), epoch(1995, 3)), ("a", "cus_1", epoch(1990, 1), epoch(1995, 2))],
    "canceled at once": [("a", "cus_1", epoch(1996, 1, 3), epoch(1996, 1, 20)), ("a", "cus_1", epoch(1996, 1), epoch(1996, 3))],
    "no id": [(None, "cus_1", epoch(1996, 1), epoch(1996, 3)), (None, "cus_2", epoch(1996, 2), epoch(1996, 4))],
    "none": [],
}


@pytest.mark.parametrize("mode", [FIXTURE.mode, CORRECTED])
@pytest.mark.parametrize("name", CASES)
def test_repeated_keys_by_intervals(spark, name, mode):
    p = FIXTURE.with_(mode=mode)
    src = with_subscriptions(spark, CASES[name])
    want = unique_failures(fct_mrr(src, p), "mrr_id").count()
    assert quality_suite.repeated_mrr_ids(src, p).first().failures == want


def test_repeated_account_keys_fan_out(spark):
    src = with_subscriptions(spark, [("a", "cus_1", epoch(1996, 1), epoch(1996, 4)), ("b", "cus_2", epoch(1996, 1), epoch(1996, 3)),
                                     ("b", "cus_1", epoch(1996, 3), epoch(1996, 5))])
    accounts = src("salesforce", "account")
    twice = accounts.unionByName(accounts.where("stripe_customer_id__c = 'cus_1'").withColumn("id", F.lit("again")))
    assert twice.count() > accounts.count()
    src = src.replaced("salesforce", "account", twice)
    want = unique_failures(fct_mrr(src, FIXTURE), "mrr_id").count()
    assert want > 0 and quality_suite.repeated_mrr_ids(src, FIXTURE).first().failures == want


def test_the_fact_is_not_expanded_for_its_key(spark):
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    plan = quality_suite.repeated_mrr_ids(src, FIXTURE)._jdf.queryExecution().toString()
    assert "sequence(" not in plan and "md5" not in plan
    unique = quality_suite.dq_unique(src, FIXTURE)._jdf.queryExecution().toString()
    assert "sequence(" not in unique


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_nrr_reads_one_fact(spark):
    """Scans and exchanges of the fact's own plan, and two exchanges of aggregated rows more."""
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    fact, out = executed(fct_mrr(src, FIXTURE)), executed(growth.nrr(src, FIXTURE))
    assert out.count("FileScan") <= fact.count("FileScan") and "Join" not in out[:out.index("Union")]
    assert out.count("Exchange") <= fact.count("Exchange") + 3


def test_bitmaps_count_exactly_over_many_buckets(spark):
    """70,000 customers need three bitmaps; sets of months and segments merge exactly."""
    fact = spark.range(140_000).selectExpr(
        "CAST(id % 70000 AS STRING) AS customer_id", "add_months(DATE '2020-01-01', CAST(id % 5 AS INT)) AS month_start",
        "CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 'SMB' ELSE 'Enterprise' END AS account_segment",
        "CASE WHEN id % 7 = 0 THEN 'new' WHEN id % 7 = 1 THEN 'churn' ELSE 'retained' END AS mrr_type")
    fact = fact.unionByName(fact.limit(10).withColumn("customer_id", F.lit(None).cast("string")))
    bitmaps = reports.customer_bitmaps(fact)
    assert bitmaps.select("bucket").distinct().count() == 3

    def values(df):
        return sorted(str(tuple(r)) for r in df.collect())
    for by in (("month_start", "account_segment"), ("account_segment",), ("month_start",), ()):
        got = reports.distinct_customers(bitmaps, *by)
        assert values(got) == sorted(str(tuple(r)) for r in fact.where("customer_id IS NOT NULL").groupBy(*by).agg(
            F.countDistinct("customer_id"), F.countDistinct(F.expr("CASE WHEN mrr_type = 'new' THEN customer_id END")),
            F.countDistinct(F.expr("CASE WHEN mrr_type = 'churn' THEN customer_id END"))).collect())
    assert reports.distinct_customers(reports.customer_bitmaps(fact.where("false")), "month_start").count() == 0


def test_columns_that_cannot_be_null_are_not_computed(spark):
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    checks = [c for c in quality_suite.MART_CHECKS if c.model == "fct_mrr" and c.test == "not_null"]
    sure = quality_suite.never_null(src, FIXTURE, checks)
    assert "mrr_id" in {c.column for c in sure} and "mrr" not in {c.column for c in sure}
    for c in sure:
        assert fct_mrr(src, FIXTURE).where(F.col(c.column).isNull()).isEmpty()
