"""Adapters: derive raw source tables of the reference's shape from the driver's
test tables (orders, customer, nation, events).

Each adapter is a projection (accounts also join nation), so it is a narrow stage
that Catalyst fuses into the consumer's scan.
The formulas are deterministic functions of the row keys; they are written out
once more in SQL in :mod:`monthwise.oracle_sql`."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.fixture import FIXTURE
from monthwise.params import Params
from monthwise.sources import schemas
from monthwise.sources.seedgen import FEATURES, FIRST_NAMES, LAST_NAMES, PLAN_NAMES, PRICES_CENTS, SIGNUP_SOURCES

DAY = 86_400

# Fixed values (shared with the SQL oracle).
PLAN_TYPES = [n.lower() for n in PLAN_NAMES]
CYCLES = ["annual", "monthly", "quarterly"]
ACCOUNT_TYPES = ["Customer", "Partner", "Prospect"]
BILLING_REASONS = ["subscription_create", "subscription_cycle", "manual"]
OPPORTUNITY_STAGES = ["Prospecting", "Qualification", "Needs Analysis", "Value Proposition",
                      "Closed Won", "Closed Lost"]
# Hours by which each source's sync lags as_of (exercises pass / warn / error).
STRIPE_SYNC_LAG_H = 3
SALESFORCE_SYNC_LAG_H = 10
APP_LOAD_LAG_H = 7
USERS_EPOCH = dt.datetime(1995, 1, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lits(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def _pick(values, idx: str) -> str:
    """SQL for ``values[idx]`` with a 0-based index expression."""
    return f"element_at(array({_lits(values)}), CAST(({idx}) + 1 AS INT))"


def _ntz(ts: dt.datetime) -> str:
    return f"TIMESTAMP_NTZ '{ts:%Y-%m-%d %H:%M:%S.%f}'"


def _hours_before(ts: dt.datetime, hours: str) -> str:
    return f"{_ntz(ts)} - make_dt_interval(0, CAST({hours} AS INT))"


def _days_after(ts: str, days: str) -> str:
    return f"{ts} + make_dt_interval(CAST({days} AS INT))"


def _epoch(ts: str) -> str:
    return f"unix_seconds(CAST({ts} AS TIMESTAMP))"


def _project(df: DataFrame, exprs: dict[str, str], schema) -> DataFrame:
    """One ``selectExpr`` (parsed JVM-side) per adapter, conformed to the contract."""
    return schemas.conform(df.selectExpr(*[f"`{n}`" if e == n else f"{e} AS `{n}`" for n, e in exprs.items()]),
                           schema)


# Projections are written as Spark SQL expressions: one client call per column,
# whatever its complexity.
# --------------------------------------------------------------------------- stripe
def stripe_subscriptions(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    created = _epoch("o_orderdate")
    canceled = f"CASE WHEN o_orderstatus = 'F' THEN {created} + ((o_orderkey * 37) % 900) * {DAY} END"
    return _project(read_table(spark, sf_dir, "orders"), {
        "id": "concat('sub_', o_orderkey)",
        "customer": "concat('cus_', o_custkey)",
        "plan_id": "concat('plan_', o_orderkey % 4)",
        "status": "CASE WHEN o_orderstatus = 'F' THEN 'canceled' WHEN o_orderstatus = 'O' THEN 'active' "
                  "WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'trialing' "
                  "WHEN o_orderstatus = 'P' THEN 'past_due' ELSE 'incomplete' END",
        "metadata": f"to_json(named_struct('plan_type', {_pick(PLAN_TYPES, 'o_orderkey % 4')}, "
                    f"'billing_cycle', {_pick(CYCLES, 'o_orderkey % 3')}, 'acquisition_channel', "
                    f"CASE WHEN o_orderkey % 13 <> 0 THEN {_pick(SIGNUP_SOURCES, 'o_orderkey % 4')} END))",
        "plan_amount": f"CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE {_pick(PRICES_CENTS, 'o_orderkey % 4')} END",
        "created": created,
        "current_period_start": created,
        "current_period_end": f"{created} + 30 * {DAY}",
        "trial_start": f"CASE WHEN o_orderstatus = 'P' THEN {created} END",
        "trial_end": f"CASE WHEN o_orderstatus = 'P' THEN {created} + ((o_orderkey * 13) % 400) * {DAY} END",
        "canceled_at": canceled,
        "ended_at": canceled,
        "cancel_at_period_end": "o_orderkey % 7 = 0",
        "_fivetran_deleted": "o_orderkey % 50 = 0",
        "_fivetran_synced": _hours_before(p.as_of, f"{STRIPE_SYNC_LAG_H} + o_orderkey % 48"),
    }, schemas.STRIPE_SUBSCRIPTIONS)


def stripe_invoices(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    created = _epoch("o_orderdate")
    total = "CAST(round(o_totalprice * 100) AS BIGINT)"
    tax = f"CAST(floor({total} / 10) AS BIGINT)"
    paid = f"CASE WHEN o_orderstatus = 'F' THEN {total} ELSE 0 END"
    return _project(read_table(spark, sf_dir, "orders"), {
        "id": "concat('in_', o_orderkey)",
        "subscription": "concat('sub_', o_orderkey)",
        "customer": "concat('cus_', o_custkey)",
        "charge": "concat('ch_', o_orderkey)",
        "number": "concat('INV-', o_orderkey)",
        "status": "CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'draft' END",
        "billing_reason": _pick(BILLING_REASONS, "o_orderkey % 3"),
        "amount_due": total,
        "amount_paid": paid,
        "amount_remaining": f"{total} - {paid}",
        "subtotal": f"{total} - {tax}",
        "tax": tax,
        "total": total,
        "currency": "'usd'",
        "created": created,
        "period_start": created,
        "period_end": f"{created} + 30 * {DAY}",
        "due_date": f"{created} + 30 * {DAY}",
        "paid_at": f"CASE WHEN o_orderstatus = 'F' THEN {created} + (o_orderkey % 5) * {DAY} END",
        "paid": "o_orderstatus = 'F'",
        "attempted": "o_orderstatus <> 'P'",
        "forgiven": "o_orderkey % 97 = 0",
        "_fivetran_deleted": "o_orderkey % 50 = 0",
        "_fivetran_synced": _hours_before(p.as_of, f"{STRIPE_SYNC_LAG_H} + o_orderkey % 48"),
    }, schemas.STRIPE_INVOICES)


def stripe_customers(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    return _project(read_table(spark, sf_dir, "customer"), {
        "id": "concat('cus_', c_custkey)",
        "email": "concat('user_', c_custkey, '@company.example')",
        "created": _epoch(_days_after(_ntz(USERS_EPOCH), "c_custkey % 700")),
        "_fivetran_deleted": "false",
        "_fivetran_synced": _hours_before(p.as_of, f"{STRIPE_SYNC_LAG_H} + c_custkey % 48"),
    }, schemas.STRIPE_CUSTOMERS)


def stripe_charges(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    return _project(read_table(spark, sf_dir, "orders"), {
        "id": "concat('ch_', o_orderkey)",
        "customer": "concat('cus_', o_custkey)",
        "invoice": "concat('in_', o_orderkey)",
        "amount": "CAST(round(o_totalprice * 100) AS BIGINT)",
        "status": "CASE WHEN o_orderstatus = 'F' THEN 'succeeded' WHEN o_orderstatus = 'O' THEN 'pending' "
                  "ELSE 'failed' END",
        "created": _epoch("o_orderdate"),
        "_fivetran_deleted": "false",
        "_fivetran_synced": _hours_before(p.as_of, f"{STRIPE_SYNC_LAG_H} + o_orderkey % 48"),
    }, schemas.STRIPE_CHARGES)


# ----------------------------------------------------------------------- salesforce
def salesforce_account(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = cust.join(nation, F.expr("c_nationkey = n_nationkey"), "left")
    created = _days_after(_ntz(USERS_EPOCH), "c_custkey % 700")
    return _project(j, {
        "id": "concat('a_', c_custkey)",
        "stripe_customer_id__c": "CASE WHEN c_custkey % 11 <> 0 THEN concat('cus_', c_custkey) END",
        "name": "c_name",
        "type": _pick(ACCOUNT_TYPES, "c_custkey % 3"),
        "industry": "c_mktsegment",
        "numberofemployees": "CASE WHEN c_custkey % 97 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN c_custkey % 10 "
                             "WHEN c_custkey % 4 = 1 THEN 10 + c_custkey % 190 "
                             "WHEN c_custkey % 4 = 2 THEN 200 + c_custkey % 800 ELSE 1000 + c_custkey END",
        "annualrevenue": "c_acctbal * 1000",
        "billingcountry": "n_name",
        "billingstate": "concat('S', c_custkey % 50)",
        "ownerid": "concat('005', c_custkey % 7)",
        "createddate": created,
        "lastmodifieddate": _days_after(created, "c_custkey % 300"),
        "_fivetran_synced": _hours_before(p.as_of, f"{SALESFORCE_SYNC_LAG_H} + c_custkey % 60"),
        "isdeleted": "c_custkey % 40 = 0",
    }, schemas.SALESFORCE_ACCOUNT)


def salesforce_opportunity(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    return _project(read_table(spark, sf_dir, "orders"), {
        "id": "concat('op_', o_orderkey)",
        "accountid": "concat('a_', o_custkey)",
        "stage_name": _pick(OPPORTUNITY_STAGES, "o_orderkey % 6"),
        "amount": "CAST(o_totalprice AS DECIMAL(18,2))",
        "createddate": "o_orderdate",
        "closedate": f"CASE WHEN o_orderkey % 6 >= 4 THEN {_days_after('o_orderdate', 'o_orderkey % 60')} END",
        "isdeleted": "false",
        "_fivetran_synced": _hours_before(p.as_of, f"{SALESFORCE_SYNC_LAG_H} + o_orderkey % 60"),
    }, schemas.SALESFORCE_OPPORTUNITY)


def salesforce_contact(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    return _project(read_table(spark, sf_dir, "customer"), {
        "id": "concat('003', c_custkey)",
        "accountid": "concat('a_', c_custkey)",
        "email": "concat('contact_', c_custkey, '@company.example')",
        "isdeleted": "c_custkey % 40 = 0",
        "_fivetran_synced": _hours_before(p.as_of, f"{SALESFORCE_SYNC_LAG_H} + c_custkey % 60"),
    }, schemas.SALESFORCE_CONTACT)


# --------------------------------------------------------------------------- app db
def app_users(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    created = _days_after(_ntz(USERS_EPOCH), "c_custkey % 700")
    return _project(read_table(spark, sf_dir, "customer"), {
        "id": "c_custkey",
        "email": "concat(' User_', c_custkey, '@Company.example ')",
        "first_name": f"CASE WHEN c_custkey % 17 <> 0 THEN {_pick(FIRST_NAMES, 'c_custkey % 8')} END",
        "last_name": _pick(LAST_NAMES, "c_custkey % 8"),
        "organization_id": "CASE WHEN c_custkey % 25 <> 0 THEN floor(c_custkey / 4) + 1 END",
        "stripe_customer_id": "concat('cus_', c_custkey)",
        "role": "CASE WHEN c_custkey % 5 = 0 THEN 'admin' ELSE 'member' END",
        "status": "CASE WHEN c_custkey % 20 = 0 THEN 'deactivated' WHEN c_custkey % 20 = 1 THEN 'invited' "
                  "ELSE 'active' END",
        "signup_source": _pick(SIGNUP_SOURCES, "c_custkey % 4"),
        "referral_code": "CAST(NULL AS STRING)",
        "created_at": created,
        "updated_at": _days_after(created, "c_custkey % 50"),
        "last_login_at": _days_after(created, "c_custkey % 90"),
        "email_verified_at": f"CASE WHEN c_custkey % 9 <> 0 THEN {_days_after(created, '1')} END",
        "_loaded_at": _hours_before(p.as_of, f"{APP_LOAD_LAG_H} + c_custkey % 10"),
    }, schemas.APP_USERS)


def app_subscriptions(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    canceled = f"CASE WHEN o_orderstatus = 'F' THEN {_days_after('o_orderdate', '(o_orderkey * 37) % 900')} END"
    return _project(read_table(spark, sf_dir, "orders"), {
        "id": "o_orderkey",
        "user_id": "o_custkey",
        "organization_id": "floor(o_custkey / 4) + 1",
        "stripe_sub_id": "concat('sub_', o_orderkey)",
        "plan_name": _pick(PLAN_NAMES, "o_orderkey % 4"),
        "plan_type": "CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'monthly' END",
        "status": "CASE WHEN o_orderstatus = 'F' THEN 'canceled' ELSE 'active' END",
        "amount_cents": f"CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE {_pick(PRICES_CENTS, 'o_orderkey % 4')} END",
        "started_at": "o_orderdate",
        "canceled_at": canceled,
        "updated_at": f"coalesce({canceled}, o_orderdate)",
        "_loaded_at": _hours_before(p.as_of, str(APP_LOAD_LAG_H)),
    }, schemas.APP_SUBSCRIPTIONS)


def app_events(spark: SparkSession, sf_dir: str, p: Params = FIXTURE) -> DataFrame:
    k = "CAST(get_json_object(props, '$.k') AS BIGINT)"
    return _project(read_table(spark, sf_dir, "events"), {
        "event_id": "event_id",
        "user_id": "user_id",
        "session_id": "CAST(NULL AS STRING)",
        "event_name": "event_type",
        "event_properties": f"to_json(named_struct('source', 'web', 'feature', {_pick(FEATURES, k + ' % 4')}, "
                            f"'k', {k}))",
        "occurred_at": "ts",
        "_loaded_at": "ts + INTERVAL 1 HOUR",
    }, schemas.APP_EVENTS)


ADAPTERS = {
    ("stripe", "subscriptions"): stripe_subscriptions,
    ("stripe", "invoices"): stripe_invoices,
    ("stripe", "customers"): stripe_customers,
    ("stripe", "charges"): stripe_charges,
    ("salesforce", "account"): salesforce_account,
    ("salesforce", "opportunity"): salesforce_opportunity,
    ("salesforce", "contact"): salesforce_contact,
    ("app_db", "users"): app_users,
    ("app_db", "subscriptions"): app_subscriptions,
    ("app_db", "events"): app_events,
}
