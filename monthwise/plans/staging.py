"""Staging models (M1-M4): rename, type, soft-delete filter.  Narrow projections
only: no shuffle; filters reach the parquet scan.  Written as SQL projections
(``selectExpr``), like the models they restate."""

from __future__ import annotations

from pyspark.sql import DataFrame

from monthwise.functions import sql as S
from monthwise.params import CORRECTED, Params
from monthwise.sources.registry import Sources

# Employee-count segment bounds (upper bounds are exclusive).
SEGMENTS = [(10, "SMB"), (200, "Mid-Market"), (1000, "Enterprise")]
SEGMENT_ELSE = "Strategic"
SEGMENT_UNKNOWN = "Unknown"   # corrected mode only


def not_deleted(flag_col: str) -> str:
    """``where flag = false``: NULL flags are dropped as in SQL."""
    return f"{flag_col} = false"


def _select(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    # a bare column stays bare: a same-name alias would make otherwise equal
    # subplans differ (and block exchange reuse between branches of one query)
    return df.selectExpr(*[f"`{n}`" if e == n else f"{e} AS `{n}`" for n, e in exprs.items()])


def stg_subscriptions(src: Sources, p: Params) -> DataFrame:
    raw = src("stripe", "subscriptions").where(not_deleted("_fivetran_deleted"))
    return _select(raw, {
        "subscription_id": "id",
        "customer_id": "customer",
        "plan_id": "plan_id",
        "subscription_status": "status",
        "plan_type": S.json_text("metadata", "plan_type"),
        "billing_cycle": S.json_text("metadata", "billing_cycle"),
        "acquisition_channel": S.json_text("metadata", "acquisition_channel"),
        "plan_amount_cents": "plan_amount",
        "plan_amount_dollars": S.cents_to_dollars("plan_amount"),
        "created_at": S.epoch_to_ntz("created"),
        "period_start_at": S.epoch_to_ntz("current_period_start"),
        "period_end_at": S.epoch_to_ntz("current_period_end"),
        "trial_start_at": S.epoch_to_ntz("trial_start"),
        "trial_end_at": S.epoch_to_ntz("trial_end"),
        "canceled_at": S.epoch_to_ntz("canceled_at"),
        "ended_at": S.epoch_to_ntz("ended_at"),
        "is_cancel_at_period_end": "cancel_at_period_end",
        "is_in_trial": S.flag(f"trial_end IS NOT NULL AND {S.epoch_to_ntz('trial_end')} > {S.ntz(p.as_of)}"),
        "_fivetran_synced_at": "_fivetran_synced",
    })


def stg_invoices(src: Sources, p: Params) -> DataFrame:
    raw = src("stripe", "invoices").where(not_deleted("_fivetran_deleted"))
    return _select(raw, {
        "invoice_id": "id",
        "subscription_id": "subscription",
        "customer_id": "customer",
        "charge_id": "charge",
        "invoice_number": "number",
        "invoice_status": "status",
        "billing_reason": "billing_reason",
        "amount_due_dollars": S.cents_to_dollars("amount_due"),
        "amount_paid_dollars": S.cents_to_dollars("amount_paid"),
        "amount_remaining_dollars": S.cents_to_dollars("amount_remaining"),
        "subtotal_dollars": S.cents_to_dollars("subtotal"),
        "tax_dollars": S.cents_to_dollars("tax"),
        "total_dollars": S.cents_to_dollars("total"),
        "currency_code": "upper(currency)",
        "created_at": S.epoch_to_ntz("created"),
        "period_start_at": S.epoch_to_ntz("period_start"),
        "period_end_at": S.epoch_to_ntz("period_end"),
        "due_at": S.epoch_to_ntz("due_date"),
        "paid_at": S.epoch_to_ntz("paid_at"),
        "is_paid": "paid",
        "is_attempted": "attempted",
        "is_forgiven": "forgiven",
        "_fivetran_synced_at": "_fivetran_synced",
    })


def account_segment(employees: str, mode: str) -> str:
    arms = " ".join(f"WHEN {employees} < {bound} THEN '{name}'" for bound, name in SEGMENTS)
    if mode == CORRECTED:
        arms += f" WHEN {employees} IS NULL THEN '{SEGMENT_UNKNOWN}'"
    return f"CASE {arms} ELSE '{SEGMENT_ELSE}' END"


def stg_accounts(src: Sources, p: Params) -> DataFrame:
    raw = src("salesforce", "account").where(not_deleted("isdeleted"))
    return _select(raw, {
        "account_id": "id",
        "stripe_customer_id": "stripe_customer_id__c",
        "account_name": "name",
        "account_type": "type",
        "industry": "industry",
        "employee_count": "numberofemployees",
        "annual_revenue_dollars": "annualrevenue",
        "account_segment": account_segment("numberofemployees", p.mode),
        "billing_country": "billingcountry",
        "billing_state": "billingstate",
        "account_owner_id": "ownerid",
        "created_at": "CAST(createddate AS TIMESTAMP_NTZ)",
        "updated_at": "CAST(lastmodifieddate AS TIMESTAMP_NTZ)",
        "_fivetran_synced_at": "_fivetran_synced",
        "isdeleted": "isdeleted",
    })


def stg_users(src: Sources, p: Params) -> DataFrame:
    return _select(src("app_db", "users"), {
        "user_id": "id",
        "stripe_customer_id": "stripe_customer_id",
        "organization_id": "organization_id",
        "email": "email",
        "email_hash": "md5(lower(trim(email)))",
        "first_name": "first_name",
        "last_name": "last_name",
        "full_name": "concat(first_name, ' ', last_name)",
        "user_role": "role",
        "user_status": "status",
        "signup_source": "signup_source",
        "referral_code": "referral_code",
        "created_at": "CAST(created_at AS TIMESTAMP_NTZ)",
        "updated_at": "CAST(updated_at AS TIMESTAMP_NTZ)",
        "last_login_at": "CAST(last_login_at AS TIMESTAMP_NTZ)",
        "email_verified_at": "CAST(email_verified_at AS TIMESTAMP_NTZ)",
        "is_email_verified": S.flag("email_verified_at IS NOT NULL"),
        "is_active": S.flag("status = 'active'"),
        "_loaded_at": "_loaded_at",
    })
