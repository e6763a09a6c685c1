"""The app database seed (users, subscriptions, events) as Spark jobs.

Rows are generated from an id column - ``spark.range`` for a stand-alone seed,
or ids taken from an existing table - so generation is spread over the id
frame's partitions.  The original draws ``random()``/``now()``; here every
"random" fraction comes from an MD5 of the id and times count back from ``as_of``, so a seed is repeatable (and reproducible in SQL)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions.scalar import ntz_lit

# Fixed values of the seed.
FIRST_NAMES = ["Alice", "Bob", "Carol", "David", "Eva", "Frank", "Grace", "Henry"]
LAST_NAMES = ["Smith", "Jones", "Williams", "Brown", "Davis", "Miller", "Wilson", "Moore"]
SIGNUP_SOURCES = ["organic", "paid_search", "referral", "product_led"]
PLAN_NAMES = ["Starter", "Growth", "Business", "Enterprise"]
PRICES_CENTS = [4900, 9900, 29900, 99900]
EVENT_NAMES = ["page_view", "feature_click", "export_data", "invite_member", "create_project",
               "dashboard_view", "api_call", "settings_update", "report_generated"]
FEATURES = ["analytics", "reports", "integrations", "settings"]
USERS_PER_ORG = 4


def unit_fraction(i: Column, salt: int) -> Column:
    """Deterministic fraction in [0, 1) from an id (stand-in for ``random()``): the
    first 32 bits of an MD5, so ids of any size work."""
    digits = F.substring(F.md5(F.concat(i.cast("string"), F.lit(f"|{salt}"))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / 2.0**32


def seconds_before(as_of: dt.datetime, frac: Column, days: int) -> Column:
    secs = F.floor(frac * days * 86400).cast("int")
    return ntz_lit(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def _pick(values, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def _uuid_like(prefix: str, i: Column) -> Column:
    h = F.md5(F.concat(F.lit(prefix), i.cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(1, n + 1).withColumnRenamed("id", "i")


def seed_users(id_frame: DataFrame, as_of: dt.datetime) -> DataFrame:
    i = F.col("i")
    org = F.ceil(i / USERS_PER_ORG)
    return id_frame.select(
        i.alias("id"),
        F.concat(F.lit("user_"), i.cast("string"), F.lit("@company_"), org.cast("string"), F.lit(".com"))
        .alias("email"),
        _pick(FIRST_NAMES, i).alias("first_name"),
        _pick(LAST_NAMES, i).alias("last_name"),
        org.cast("bigint").alias("organization_id"),
        F.concat(F.lit("cus_"), F.md5(i.cast("string"))).alias("stripe_customer_id"),
        F.when(i % 5 == 0, "admin").otherwise("member").alias("role"),
        F.when(i % 20 == 0, "deactivated").otherwise("active").alias("status"),
        _pick(SIGNUP_SOURCES, i).alias("signup_source"),
        seconds_before(as_of, unit_fraction(i, 1), 730).alias("created_at"),
        seconds_before(as_of, unit_fraction(i, 2), 30).alias("updated_at"),
        seconds_before(as_of, unit_fraction(i, 3), 7).alias("last_login_at"),
        seconds_before(as_of, unit_fraction(i, 4), 700).alias("email_verified_at"),
    )


def seed_subscriptions(id_frame: DataFrame, as_of: dt.datetime) -> DataFrame:
    """One subscription per organisation ``i``."""
    i = F.col("i")
    return id_frame.select(
        i.alias("id"),
        (i * USERS_PER_ORG).cast("bigint").alias("user_id"),
        i.alias("organization_id"),
        F.concat(F.lit("sub_"), F.md5(i.cast("string"))).alias("stripe_sub_id"),
        _pick(PLAN_NAMES, i).alias("plan_name"),
        F.when(i % 3 == 0, "annual").otherwise("monthly").alias("plan_type"),
        F.when(i % 15 == 0, "canceled").otherwise("active").alias("status"),
        _pick(PRICES_CENTS, i).cast("bigint").alias("amount_cents"),
        seconds_before(as_of, unit_fraction(i, 5), 600).alias("started_at"),
    )


def seed_events(id_frame: DataFrame, as_of: dt.datetime, n_users: Column) -> DataFrame:
    """Events spread over the users 1 to ``n_users``."""
    i = F.col("i")
    props = F.concat(F.lit('{"source": "web", "feature": "'), _pick(FEATURES, i), F.lit('"}'))
    return id_frame.select(
        _uuid_like("e", i).alias("event_id"),
        (i % n_users + 1).cast("bigint").alias("user_id"),
        _uuid_like("s", i).alias("session_id"),
        _pick(EVENT_NAMES, i).alias("event_name"),
        props.alias("event_properties"),
        seconds_before(as_of, unit_fraction(i, 6), 90).alias("occurred_at"),
    )
