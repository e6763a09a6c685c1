"""The fact's runs of months: lag windows, customers' MRR and the bucketed write without a row per month."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from monthwise.fixture import FIXTURE
from monthwise.operators.movement import movement_classify, prior_in_runs
from monthwise.operators.range_expand import expand_months
from monthwise.params import CORRECTED
from monthwise.plans import growth, mrr
from monthwise.sources.registry import Sources
from monthwise.plans.build import materialize_table


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def before_sort(df):
    """The plan below the month expansion is where sorts, windows and groups belong."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[:plan.index("Generate posexplode(sequence")] if "posexplode(sequence" in plan else plan[:plan.index("Generate explode(sequence")]


def test_lag_over_runs_is_the_lag_over_months(spark):
    """Apart, adjacent, nested, equal and crossing runs of one key, against a row per month."""
    runs = [("a", 1, 1, 5, 10), ("a", 2, 3, 8, 20), ("a", 3, 12, 14, 5), ("b", 1, 1, 12, 1), ("b", 2, 4, 4, 2), ("b", 3, 4, 6, 3),
            ("c", 1, 1, 2, 7), ("c", 2, 3, 3, 8), ("c", 3, 3, 9, 9), ("c", 4, 3, 3, 4), ("d", 1, 2, 2, 6)]
    df = spark.createDataFrame(runs, "k string, o int, f int, t int, v int").selectExpr(
        "k", "o", "v", "add_months(DATE '1999-12-01', f) AS first", "add_months(DATE '1999-12-01', t) AS last")

    def months(d):
        return expand_months(d, "first", "add_months(last, 1)", FIXTURE.spine_start, FIXTURE.spine_end, out="m", position="at")
    want = movement_classify(months(df), ["k"], ["m", "o"], "v").select("k", "o", "m", "v", "prior_value")
    got = months(prior_in_runs(df, ["k"], "first", "last", ["o"], "v", "p0", "p1")).selectExpr(
        "k", "o", "m", "v", "CASE WHEN at > 0 THEN p1 ELSE p0 END AS prior_value")
    assert rows_of(got) == rows_of(want)


def test_transfers_order_runs_not_months(spark):
    """the windows of shared ids lie below the expansion."""
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    above = before_sort(mrr.fct_mrr_transfers(src, FIXTURE))
    assert not any(x in above for x in ("Window", "Sort", "Exchange", "Aggregate"))


@pytest.mark.parametrize("mode", [FIXTURE.mode, CORRECTED])
@pytest.mark.parametrize("model", ["nrr", "cohort_retention"])
def test_customer_runs_against_the_fact(spark, model, mode):
    """the models from the fact's runs are those from its rows, and no window sees months."""
    p = FIXTURE.with_(mode=mode)
    src = Sources.from_test_tables(spark, SF_SMALL, p)
    accounts = src("salesforce", "account")
    src = src.replaced("salesforce", "account", accounts.unionByName(accounts.where("id < 'a_2'").withColumn("id", F.lit("again"))))
    out = getattr(growth, model)(src, p)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("explode(sequence") == 1      # after the customers' sums
    assert plan.index("explode(sequence") < plan.index("Window [lead(")
    cm = growth.customer_month_mrr(mrr.fct_mrr(src, p))
    if model == "nrr":
        later = cm.selectExpr("customer_id", "add_months(month_start, -12) AS month_start", "mrr AS now")
        want = cm.join(later, ["customer_id", "month_start"], "left").where(F.expr("add_months(month_start, 12)") <= F.lit(p.spine_end)).groupBy(
            F.expr("add_months(month_start, 12)").alias("month_start")).agg(F.count("mrr"), F.count("now"), F.sum("mrr"), F.coalesce(F.sum("now"), F.lit(0)))
        got = out.selectExpr("month_start", "cohort_customers", "retained_customers", "CAST(starting_mrr * 1000000 AS BIGINT)",
                             "CAST(retained_mrr * 1000000 AS BIGINT)")
    else:
        first = cm.withColumn("cohort_month", F.min("month_start").over(Window.partitionBy("customer_id")))
        want = first.groupBy("cohort_month", F.expr("CAST(months_between(month_start, cohort_month) AS INT)")).count()
        got = out.select("cohort_month", "months_since", "active_customers")
    assert rows_of(got) == rows_of(want) and got.count() > 12
    assert rows_of(getattr(growth, model)(src, p, mrr.fct_mrr(src, p))) == rows_of(out)     # from a written fact


def test_a_dealt_fact_is_written_without_exchange(spark, workdir):
    """above the expansion nothing is moved, though the accounts come by a shuffle; each bucket
    is written by several tasks of bounded rows, and read as one."""
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k in before:
            spark.conf.set(k, "-1")
        fact = mrr.fct_mrr(src, FIXTURE, parts=8)
        assert not any(x in before_sort(fact) for x in ("Sort", "Exchange"))
        out = materialize_table(spark, fact, workdir, "marts", "dealt", "prod", "x", "r2", bucket_by="subscription_id", buckets=4, dealt=True)
        assert rows_of(out) == rows_of(mrr.fct_mrr(src, FIXTURE))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert out.count() == mrr.fact_months(src, FIXTURE)
    buckets = out.withColumn("bucket", F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1).cast("int")).groupBy("subscription_id").agg(
        F.countDistinct("bucket").alias("n"), F.min("bucket").alias("b"))
    assert buckets.where("n <> 1 OR b <> pmod(hash(subscription_id), 4)").isEmpty()
    again = out.groupBy("subscription_id").count()
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()


def test_ids_of_one_row_are_not_moved_by_id(spark, monkeypatch):
    """the fact's rows move once, to their accounts.  F3: where many ids are shared, once by id
    and once to the accounts."""
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    keys = ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}

    def final(df):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan[:plan.index("Initial Plan")]
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        one = final(mrr.fct_mrr(src, FIXTURE))
        monkeypatch.setattr(mrr, "FEW_SHARED", 10)
        several = final(mrr.fct_mrr_transfers(src, FIXTURE))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "hashpartitioning(subscription_id" in final(mrr.fct_mrr(src, FIXTURE))      # small accounts: the rows are spread all the same
    assert "hashpartitioning(subscription_id" not in one and one.count("Exchange hashpartitioning(customer_id") == 1
    assert several.count("REPARTITION_BY_NUM") == 1 and several.count("Exchange hashpartitioning(customer_id") == 1


@pytest.mark.parametrize("mode", [FIXTURE.mode, CORRECTED])
def test_windows_over_all_runs_leave_lone_ids_alone(spark, monkeypatch, mode):
    """with many shared ids, all rows go through the windows; the rows of other ids and those
    without an id (each on its own) come as they do from the branch of one row an id."""
    p = FIXTURE.with_(mode=mode)
    src = Sources.from_test_tables(spark, SF_SMALL, p)
    subs = src("stripe", "subscriptions").withColumn("id", F.expr("CASE WHEN CAST(substring(id, 5) AS BIGINT) % 7 <> 0 THEN id END"))
    more = subs.where("id IS NOT NULL").orderBy("id").limit(1)
    shared = more.first().id
    keep = f"NOT (subscription_id <=> '{shared}')"
    alone = mrr.fct_mrr(src.replaced("stripe", "subscriptions", subs), p)
    few = mrr.fct_mrr(src.replaced("stripe", "subscriptions", subs.unionByName(more)), p)
    monkeypatch.setattr(mrr, "FEW_SHARED", 0)
    beside = mrr.fct_mrr(src.replaced("stripe", "subscriptions", subs.unionByName(more)), p)
    assert rows_of(beside) == rows_of(few)
    assert rows_of(beside.where(keep)) == rows_of(alone.where(keep))
    assert not alone.where("subscription_id IS NULL").isEmpty()


@pytest.mark.parametrize("blocks", [6, 85])
def test_the_fact_comes_month_after_month(spark, workdir, blocks):
    """nothing above the runs is sorted, in the plan or by the write; a bucket has one file a month, in the order of its ids."""
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    fact = mrr.fct_mrr(src, FIXTURE, parts=2, blocks=blocks)
    parts = fact.select("month_start", "subscription_id").rdd.glom().collect()
    assert len(parts) == 2 * blocks and all([*map(tuple, x)] == sorted(map(tuple, x)) for x in parts)
    out = materialize_table(spark, fact, workdir, "marts", "dealt", "prod", "x", f"r{blocks}", bucket_by="subscription_id", buckets=2, dealt=True,
                            plain=("mrr_id",))
    assert rows_of(out) == rows_of(mrr.fct_mrr(src, FIXTURE))
    files = out.select(F.input_file_name().alias("f"), "month_start", F.expr("pmod(hash(subscription_id), 2)").alias("b")).distinct()
    assert files.count() == files.select("month_start", "b").distinct().count()
    for f in [r.f for r in files.limit(5).collect()]:
        ids = [r.subscription_id for r in spark.read.parquet(f).collect()]
        assert ids == sorted(ids)
