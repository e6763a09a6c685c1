"""Raw table contracts (explicit ``StructType`` per source table).

Only the app tables have declared DDL upstream; billing and CRM types are the
ones staging relies on.  Every adapter and loader projects onto these."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B, NTZ = (T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(),
                      T.BooleanType(), T.TimestampNTZType())
DOLLARS = T.DecimalType(18, 2)


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STRIPE_SUBSCRIPTIONS = _schema(
    ("id", S), ("customer", S), ("plan_id", S), ("status", S), ("metadata", S),
    ("plan_amount", L), ("created", L), ("current_period_start", L), ("current_period_end", L),
    ("trial_start", L), ("trial_end", L), ("canceled_at", L), ("ended_at", L),
    ("cancel_at_period_end", B), ("_fivetran_deleted", B), ("_fivetran_synced", NTZ),
)

STRIPE_INVOICES = _schema(
    ("id", S), ("subscription", S), ("customer", S), ("charge", S), ("number", S),
    ("status", S), ("billing_reason", S),
    ("amount_due", L), ("amount_paid", L), ("amount_remaining", L), ("subtotal", L), ("tax", L),
    ("total", L), ("currency", S),
    ("created", L), ("period_start", L), ("period_end", L), ("due_date", L), ("paid_at", L),
    ("paid", B), ("attempted", B), ("forgiven", B), ("_fivetran_deleted", B), ("_fivetran_synced", NTZ),
)

STRIPE_CUSTOMERS = _schema(("id", S), ("email", S), ("created", L), ("_fivetran_deleted", B),
                           ("_fivetran_synced", NTZ))

STRIPE_CHARGES = _schema(("id", S), ("customer", S), ("invoice", S), ("amount", L), ("status", S),
                         ("created", L), ("_fivetran_deleted", B), ("_fivetran_synced", NTZ))

SALESFORCE_ACCOUNT = _schema(
    ("id", S), ("stripe_customer_id__c", S), ("name", S), ("type", S), ("industry", S),
    ("numberofemployees", I), ("annualrevenue", D), ("billingcountry", S), ("billingstate", S),
    ("ownerid", S), ("createddate", NTZ), ("lastmodifieddate", NTZ), ("_fivetran_synced", NTZ),
    ("isdeleted", B),
)

SALESFORCE_OPPORTUNITY = _schema(
    ("id", S), ("accountid", S), ("stage_name", S), ("amount", DOLLARS), ("createddate", NTZ),
    ("closedate", NTZ), ("isdeleted", B), ("_fivetran_synced", NTZ),
)

SALESFORCE_CONTACT = _schema(("id", S), ("accountid", S), ("email", S), ("isdeleted", B),
                             ("_fivetran_synced", NTZ))

APP_USERS = _schema(
    ("id", L), ("email", S), ("first_name", S), ("last_name", S), ("organization_id", L),
    ("stripe_customer_id", S), ("role", S), ("status", S), ("signup_source", S), ("referral_code", S),
    ("created_at", NTZ), ("updated_at", NTZ), ("last_login_at", NTZ), ("email_verified_at", NTZ),
    ("_loaded_at", NTZ),
)

APP_SUBSCRIPTIONS = _schema(
    ("id", L), ("user_id", L), ("organization_id", L), ("stripe_sub_id", S), ("plan_name", S),
    ("plan_type", S), ("status", S), ("amount_cents", L), ("started_at", NTZ), ("canceled_at", NTZ),
    ("updated_at", NTZ), ("_loaded_at", NTZ),
)

APP_EVENTS = _schema(
    ("event_id", L), ("user_id", L), ("session_id", S), ("event_name", S), ("event_properties", S),
    ("occurred_at", NTZ), ("_loaded_at", NTZ),
)

APP_SESSIONS = _schema(
    ("session_id", S), ("user_id", L), ("started_at", NTZ), ("ended_at", NTZ), ("page_views", L),
    ("events_count", L), ("_loaded_at", NTZ),
)

# Control table of the incremental loader (one row per loaded table).
WATERMARKS = T.StructType([
    T.StructField("table_name", S, False),
    T.StructField("last_extracted", NTZ, True),
    T.StructField("rows_extracted", L, True),
    T.StructField("updated_at", NTZ, True),
])

RAW = {
    ("stripe", "subscriptions"): STRIPE_SUBSCRIPTIONS,
    ("stripe", "invoices"): STRIPE_INVOICES,
    ("stripe", "customers"): STRIPE_CUSTOMERS,
    ("stripe", "charges"): STRIPE_CHARGES,
    ("salesforce", "account"): SALESFORCE_ACCOUNT,
    ("salesforce", "opportunity"): SALESFORCE_OPPORTUNITY,
    ("salesforce", "contact"): SALESFORCE_CONTACT,
    ("app_db", "users"): APP_USERS,
    ("app_db", "subscriptions"): APP_SUBSCRIPTIONS,
    ("app_db", "events"): APP_EVENTS,
    ("app_db", "sessions"): APP_SESSIONS,
}


def conform(df, schema: T.StructType):
    """Project ``df`` onto a contract: same column order, explicit casts where
    the type differs (one ``selectExpr``; columns already of the right type stay
    bare, so equal subplans stay equal for exchange reuse)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.selectExpr(*[f"`{f.name}`" if have.get(f.name) == f.dataType
                           else f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
                           for f in schema.fields])
