"""Edge cases on hand-written frames (FIXTURES.md section 3): quirks kept in
exact mode, their corrections, and the column helpers."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.functions.scalar import hours_between_boundaries
from monthwise.operators.movement import movement_classify
from monthwise.operators.quality import GateFailed, batch_profile, gate
from monthwise.fixture import FIXTURE
from monthwise.params import CORRECTED, Params
from monthwise.plans import mrr, periods, quality_suite, staging
from monthwise.sources import schemas
from monthwise.sources.incremental import incremental_batch, latest_by_key
from monthwise.sources.registry import Sources

EPOCH = dt.datetime(1970, 1, 1)


def ep(ts):
    return int((ts - EPOCH).total_seconds())


def raw_sub(i, start, cancel=None, amount=9900, cycle="monthly", deleted=False, customer=None, meta=None):
    meta = meta if meta is not None else f'{{"plan_type":"growth","billing_cycle":"{cycle}"}}'
    return (f"sub_{i}", customer or f"cus_{i}", "plan_1", "active", meta, amount, ep(start), ep(start),
            ep(start) + 86400 * 30, None, None, ep(cancel) if cancel else None, ep(cancel) if cancel else None,
            False, deleted, dt.datetime(2001, 12, 31))


def subs_source(spark, rows, accounts=None, users=None, p=FIXTURE):
    loaders = {("stripe", "subscriptions"): lambda: spark.createDataFrame(rows, schemas.STRIPE_SUBSCRIPTIONS),
               ("salesforce", "account"): lambda: spark.createDataFrame(accounts or [], schemas.SALESFORCE_ACCOUNT),
               ("app_db", "users"): lambda: spark.createDataFrame(users or [], schemas.APP_USERS)}
    return Sources(spark, loaders, p)


def account(i, stripe_id, employees):
    return (f"a_{i}", stripe_id, f"Acct {i}", "Customer", "TECH", employees, 1.0, "X", "Y", "o",
            dt.datetime(2000, 1, 1), dt.datetime(2000, 1, 1), dt.datetime(2001, 12, 31), False)


def test_malformed_json_and_null_delete_flag(spark):
    rows = [raw_sub(1, dt.datetime(2001, 1, 5), meta="{not json"),
            raw_sub(2, dt.datetime(2001, 1, 5))]
    rows.append(tuple(list(raw_sub(3, dt.datetime(2001, 1, 5)))[:14] + [None, dt.datetime(2001, 12, 31)]))
    s = staging.stg_subscriptions(subs_source(spark, rows), FIXTURE).orderBy("subscription_id").collect()
    assert [r.subscription_id for r in s] == ["sub_1", "sub_2"]          # NULL flag dropped
    assert s[0].plan_type is None and s[0].billing_cycle is None          # malformed JSON -> NULL
    assert s[1].billing_cycle == "monthly"


def test_cancel_before_start_and_same_month_cancel_give_no_rows(spark):
    rows = [raw_sub(1, dt.datetime(2001, 6, 1), cancel=dt.datetime(2001, 3, 1)),
            raw_sub(2, dt.datetime(2001, 6, 1), cancel=dt.datetime(2001, 6, 20)),
            raw_sub(3, dt.datetime(2001, 6, 1), cancel=dt.datetime(2001, 8, 2))]
    out = periods.subscription_periods(subs_source(spark, rows), FIXTURE).collect()
    assert sorted((r.subscription_id, r.month_start) for r in out) == [
        ("sub_3", dt.date(2001, 6, 1)), ("sub_3", dt.date(2001, 7, 1))]
    assert not any(r.is_churn_month for r in out)        # the reference never reaches it


def test_corrected_mode_emits_churn_row(spark):
    p = FIXTURE.with_(mode=CORRECTED)
    rows = [raw_sub(3, dt.datetime(2001, 6, 1), cancel=dt.datetime(2001, 8, 2))]
    src = subs_source(spark, rows, p=p)
    out = mrr.fct_mrr(src, p).orderBy("month_start").collect()
    assert [r.mrr_type for r in out] == ["new", "retained", "churn"]
    assert out[-1].mrr == Decimal("0") and out[-1].is_churn_month


def test_corrected_start_from_creation_unassigned_segment_and_key_prefix(spark):
    p = FIXTURE.with_(mode=CORRECTED)
    row = list(raw_sub(1, dt.datetime(2001, 10, 5), customer="cus_x"))
    row[6] = ep(dt.datetime(2001, 8, 20))                 # created two months before the current period
    out = mrr.fct_mrr(subs_source(spark, [tuple(row)], p=p), p).orderBy("month_start").collect()
    assert [r.month_start.month for r in out][:3] == [8, 9, 10] and out[0].is_first_month
    assert {r.account_segment for r in out} == {"Unassigned"}
    # exact mode: starts at the current period, segment stays NULL
    ex = mrr.fct_mrr(subs_source(spark, [tuple(row)]), FIXTURE).orderBy("month_start").collect()
    assert ex[0].month_start == dt.date(2001, 10, 1) and ex[0].account_segment is None
    # the CRM key prefix is a parameter
    users = [(1, "u@x", "A", "B", 7, "cus_1", "member", "active", "organic", None, dt.datetime(2000, 1, 1),
              None, None, None, dt.datetime(2001, 12, 31))]
    accts = [account(7, "cus_7", 5)]
    acct = [account(0, "cus_0", 5)]
    acct[0] = tuple(["org-7"] + list(acct[0][1:]))
    from monthwise.plans import accounts
    pp = FIXTURE.with_(account_key_prefix="org-")
    d = accounts.dim_accounts(subs_source(spark, [], acct, users, p=pp), pp).first()
    assert d.account_id == "org-7" and d.total_user_count == 1
    d2 = accounts.dim_accounts(subs_source(spark, [], accts, users), FIXTURE).first()
    assert d2.account_id == "a_7" and d2.total_user_count == 1


def test_annual_mrr_and_spine_clipping(spark):
    p = FIXTURE
    rows = [raw_sub(1, dt.datetime(1990, 3, 1), amount=4900, cycle="annual")]
    out = periods.subscription_periods(subs_source(spark, rows), p).agg(
        F.min("month_start"), F.max("month_start"), F.count("*"), F.max("mrr")).first()
    assert out[0] == p.spine_start and out[1] == p.spine_end and out[2] == 85
    assert out[3] == Decimal("4.083333")                   # 49.00 / 12 rounded to 6 places


def test_movement_exact_vs_corrected(spark):
    df = spark.createDataFrame([(1, m, v) for m, v in enumerate([10, 12, 5, 0, 0, 7, 7])],
                               "k int, m int, v int")
    exact = [r.movement for r in movement_classify(df, ["k"], "m", "v").orderBy("m").collect()]
    assert exact == ["new", "expansion", "contraction", "churn", "new", "new", "retained"]
    corr = movement_classify(df, ["k"], "m", "v", mode=CORRECTED).orderBy("m").collect()
    assert [(r.m, r.movement) for r in corr] == [(0, "new"), (1, "expansion"), (2, "contraction"),
                                                  (3, "churn"), (5, "reactivation"), (6, "retained")]


def test_duplicate_crm_customer_fans_out_but_keeps_lag(spark):
    rows = [raw_sub(1, dt.datetime(2001, 10, 1), customer="cus_9")]
    accts = [account(1, "cus_9", 5), account(2, "cus_9", 500)]
    out = mrr.fct_mrr(subs_source(spark, rows, accts), FIXTURE).orderBy("account_id", "month_start").collect()
    assert len(out) == 2 * 4                                   # Oct..Jan, once per matching account
    for acct in ("a_1", "a_2"):
        types = [r.mrr_type for r in out if r.account_id == acct]
        assert types == ["new", "retained", "retained", "retained"]


def test_duplicated_subscription_id_follows_lag_over_all_rows(spark):
    # two source rows for one id with disjoint ranges: lag() links them
    rows = [raw_sub(1, dt.datetime(2001, 1, 3), cancel=dt.datetime(2001, 4, 2), amount=9900),
            raw_sub(1, dt.datetime(2001, 5, 3), cancel=dt.datetime(2001, 8, 2), amount=4900),
            raw_sub(2, dt.datetime(2001, 11, 3))]
    out = mrr.fct_mrr(subs_source(spark, rows), FIXTURE).orderBy("subscription_id", "month_start").collect()
    s1 = [(r.month_start.month, r.prior_month_mrr, r.mrr_type) for r in out if r.subscription_id == "sub_1"]
    assert s1 == [(1, None, "new"), (2, Decimal("99"), "retained"), (3, Decimal("99"), "retained"),
                  (5, Decimal("99"), "contraction"), (6, Decimal("49"), "retained"), (7, Decimal("49"), "retained")]
    s2 = [(r.month_start, r.mrr_type) for r in out if r.subscription_id == "sub_2"]
    assert s2 == [(dt.date(2001, 11, 1), "new"), (dt.date(2001, 12, 1), "retained"), (dt.date(2002, 1, 1), "retained")]


def test_subscription_handed_to_another_customer_keeps_its_lag(spark):
    rows = [raw_sub(1, dt.datetime(2001, 1, 3), cancel=dt.datetime(2001, 3, 2), amount=1000, customer="cus_1"),
            raw_sub(1, dt.datetime(2001, 3, 3), cancel=dt.datetime(2001, 5, 2), amount=3000, customer="cus_2")]
    for accts in ([], [account(1, "cus_1", 5)], [account(1, "cus_1", 5), account(2, "cus_2", 5)]):
        out = mrr.fct_mrr(subs_source(spark, rows, accts), FIXTURE).orderBy("month_start").collect()
        assert [(r.prior_month_mrr, r.mrr_type) for r in out] == [
            (None, "new"), (Decimal(10), "retained"), (Decimal(10), "expansion"), (Decimal(30), "retained")]


def test_date_spine_starts_at_spine_start_and_may_be_empty(spark):
    early = subs_source(spark, [raw_sub(1, dt.datetime(1990, 3, 1))])
    assert periods.date_spine(early, FIXTURE).agg(F.min("month_start")).first()[0] == FIXTURE.spine_start
    future = subs_source(spark, [raw_sub(1, dt.datetime(2010, 3, 1))])
    assert periods.date_spine(future, FIXTURE).count() == 0


def test_fct_subscriptions_agrees_with_the_fact_in_both_modes(spark):
    from monthwise.plans.growth import fct_subscriptions
    rows = [raw_sub(1, dt.datetime(2001, 1, 3), cancel=dt.datetime(2001, 4, 2)), raw_sub(2, dt.datetime(2001, 11, 3))]
    for mode in ("exact", CORRECTED):
        p = FIXTURE.with_(mode=mode)
        src = subs_source(spark, rows, p=p)
        tenure = {r.subscription_id: r.tenure_months for r in fct_subscriptions(src, p).collect()}
        months = {r.subscription_id: r.n for r in mrr.fct_mrr(src, p).where("mrr > 0").groupBy("subscription_id").agg(
            F.count("*").alias("n")).collect()}
        assert tenure == months


def test_hot_customer_does_not_skew_the_expanded_fact(spark):
    # 40% of subscriptions belong to one customer (also matched by the CRM)
    rows = [raw_sub(i, dt.datetime(1999, 1 + i % 12, 2), customer="cus_hot" if i % 5 < 2 else None)
            for i in range(600)]
    src = subs_source(spark, rows, [account(0, "cus_hot", 50)])
    fact = mrr.fct_mrr(src, FIXTURE)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # 600 rows would be one partition
    try:
        sizes = [r["n"] for r in fact.groupBy(F.spark_partition_id().alias("pid")).agg(
            F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == fact.count() and len(sizes) == 8
    assert max(sizes) < 2 * (sum(sizes) / len(sizes))      # spread by subscription, not by customer


def test_null_employee_count_segment(spark):
    accts = [account(1, "cus_1", None)]
    src = subs_source(spark, [], accts)
    assert staging.stg_accounts(src, FIXTURE).first().account_segment == "Strategic"
    pc = FIXTURE.with_(mode=CORRECTED)
    assert staging.stg_accounts(subs_source(spark, [], accts, p=pc), pc).first().account_segment == "Unknown"


def test_hour_boundaries_and_surrogate_key(spark):
    r = spark.range(1).select(
        hours_between_boundaries(F.lit(dt.datetime(2024, 1, 1, 0, 59)).cast("timestamp_ntz"),
                                 F.lit(dt.datetime(2024, 1, 1, 2, 1)).cast("timestamp_ntz")).alias("h"),
        F.expr(S.surrogate_key("'sub_1'", "DATE '2024-01-01'")).alias("k"),
        F.expr(S.surrogate_key("NULL", "1")).alias("n")).first()
    assert r.h == 2
    import hashlib
    assert r.k == hashlib.md5(b"sub_1-2024-01-01").hexdigest()
    assert r.n == hashlib.md5(b"_dbt_utils_surrogate_key_null_-1").hexdigest()


def test_batch_profile_all_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    rows = {r.column_name: r for r in batch_profile(df, "t").collect()}
    assert rows["b"].is_all_null and not rows["a"].is_all_null and not rows["a"].is_empty_batch
    empty = batch_profile(df.limit(0), "t").collect()
    assert all(r.is_empty_batch and not r.is_all_null for r in empty)


def test_incremental_null_mark_and_latest_by_key(spark):
    schema = "id long, updated_at timestamp_ntz, v string"
    src = spark.createDataFrame([(1, dt.datetime(2024, 1, 10), "a"), (2, None, "open"),
                                 (3, dt.datetime(2024, 1, 20), "c")], schema)
    mark = dt.datetime(2024, 1, 15)
    exact = incremental_batch(src, "updated_at", mark, dt.datetime(2024, 2, 1))
    assert [r.id for r in exact.collect()] == [3]
    corr = incremental_batch(src, "updated_at", mark, dt.datetime(2024, 2, 1), CORRECTED)
    assert sorted(r.id for r in corr.collect()) == [2, 3]
    loads = spark.createDataFrame([(1, "old", dt.datetime(2024, 1, 1)), (1, "new", dt.datetime(2024, 1, 2)),
                                   (2, "x", dt.datetime(2024, 1, 1))], "id long, v string, _loaded_at timestamp_ntz")
    assert sorted((r.id, r.v) for r in latest_by_key(loads, ["id"], "_loaded_at").collect()) == [(1, "new"), (2, "x")]


def test_freshness_zero_age_is_fresh_and_empty_is_stale(spark):
    p = FIXTURE
    users = spark.createDataFrame([], schemas.APP_USERS)
    loaders = {
        ("stripe", "subscriptions"): lambda: spark.createDataFrame(
            [tuple([None] * 15 + [dt.datetime(2002, 1, 1)])], schemas.STRIPE_SUBSCRIPTIONS),
        ("salesforce", "account"): lambda: spark.createDataFrame(
            [tuple([None] * 12 + [dt.datetime(2001, 12, 31, 15, 30), None])], schemas.SALESFORCE_ACCOUNT),
        ("app_db", "users"): lambda: users,
        ("app_db", "events"): lambda: spark.createDataFrame([], schemas.APP_EVENTS),
    }
    rows = {r.table_name: r for r in quality_suite.stale_sources(Sources(spark, loaders, p), p).collect()}
    assert rows["stripe.subscriptions"].hours_old == 0 and not rows["stripe.subscriptions"].is_stale
    assert rows["salesforce.account"].hours_old == 9 and rows["salesforce.account"].is_stale
    assert rows["app_db.users"].is_stale and rows["app_db.users"].hours_old is None


def test_gate_raises_on_failures(spark):
    summary = spark.createDataFrame([("m", "c", "not_null", 3, "fail"), ("m", "d", "unique", 0, "pass")],
                                    "model string, column_name string, test_name string, failures long, status string")
    with pytest.raises(GateFailed):
        gate(summary)
    gate(summary.filter("failures = 0"))
