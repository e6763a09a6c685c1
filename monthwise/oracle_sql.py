"""DuckDB SQL for every registered query (the correctness oracle).

The SQL restates the adapters and the models in plain SQL over the driver's test
views (orders, customer, nation, events).  It is written the way the reference
writes its models - e.g. the subscription x month *range join* - so it checks
the Spark rewrites (bounded expansion, two-level distinct counts, bucketed
ordered operators) rather than repeating them."""

from __future__ import annotations

from monthwise.fixture import FIXTURE
from monthwise.params import CORRECTED, Params
from monthwise.sources import adapters as A


def _arr(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _ts(x) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


def _d(x) -> str:
    return f"DATE '{x:%Y-%m-%d}'"


def ctes(p: Params = FIXTURE) -> dict[str, tuple[str, list[str]]]:
    """name -> (body, dependencies)."""
    as_of = _ts(p.as_of)
    corrected = p.mode == CORRECTED
    ep = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', {})"
    c = {}
    c["raw_stripe_subscriptions"] = (f"""
    SELECT 'sub_' || o_orderkey AS id,
           'cus_' || o_custkey AS customer,
           'plan_' || (o_orderkey % 4) AS plan_id,
           CASE WHEN o_orderstatus = 'F' THEN 'canceled' WHEN o_orderstatus = 'O' THEN 'active'
                WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'trialing'
                WHEN o_orderstatus = 'P' THEN 'past_due' ELSE 'incomplete' END AS status,
           '{{"plan_type":"' || {_arr(A.PLAN_TYPES)}[o_orderkey % 4 + 1]
             || '","billing_cycle":"' || {_arr(A.CYCLES)}[o_orderkey % 3 + 1] || '"'
             || CASE WHEN o_orderkey % 13 = 0 THEN ''
                     ELSE ',"acquisition_channel":"' || {_arr(A.SIGNUP_SOURCES)}[o_orderkey % 4 + 1] || '"' END
             || '}}' AS metadata,
           CAST(CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE {_arr(A.PRICES_CENTS)}[o_orderkey % 4 + 1] END AS BIGINT) AS plan_amount,
           {ep.format('o_orderdate')} AS created,
           {ep.format('o_orderdate')} AS current_period_start,
           {ep.format('o_orderdate')} + 30 * 86400 AS current_period_end,
           CASE WHEN o_orderstatus = 'P' THEN {ep.format('o_orderdate')} END AS trial_start,
           CASE WHEN o_orderstatus = 'P' THEN {ep.format('o_orderdate')} + ((o_orderkey * 13) % 400) * 86400 END AS trial_end,
           CASE WHEN o_orderstatus = 'F' THEN {ep.format('o_orderdate')} + ((o_orderkey * 37) % 900) * 86400 END AS canceled_at,
           CASE WHEN o_orderstatus = 'F' THEN {ep.format('o_orderdate')} + ((o_orderkey * 37) % 900) * 86400 END AS ended_at,
           o_orderkey % 7 = 0 AS cancel_at_period_end,
           o_orderkey % 50 = 0 AS _fivetran_deleted,
           {as_of} - to_hours(CAST({A.STRIPE_SYNC_LAG_H} + o_orderkey % 48 AS INTEGER)) AS _fivetran_synced
    FROM orders""", [])
    c["raw_stripe_invoices"] = (f"""
    SELECT 'in_' || o_orderkey AS id, 'sub_' || o_orderkey AS subscription, 'cus_' || o_custkey AS customer,
           'ch_' || o_orderkey AS charge, 'INV-' || o_orderkey AS number,
           CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'draft' END AS status,
           {_arr(A.BILLING_REASONS)}[o_orderkey % 3 + 1] AS billing_reason,
           CAST(round(o_totalprice * 100) AS BIGINT) AS total,
           CAST(round(o_totalprice * 100) AS BIGINT) AS amount_due,
           CAST(round(o_totalprice * 100) AS BIGINT) // 10 AS tax,
           CASE WHEN o_orderstatus = 'F' THEN CAST(round(o_totalprice * 100) AS BIGINT) ELSE 0 END AS amount_paid,
           'usd' AS currency,
           {ep.format('o_orderdate')} AS created,
           CASE WHEN o_orderstatus = 'F' THEN {ep.format('o_orderdate')} + (o_orderkey % 5) * 86400 END AS paid_at,
           o_orderstatus = 'F' AS paid, o_orderstatus <> 'P' AS attempted, o_orderkey % 97 = 0 AS forgiven,
           o_orderkey % 50 = 0 AS _fivetran_deleted,
           {as_of} - to_hours(CAST({A.STRIPE_SYNC_LAG_H} + o_orderkey % 48 AS INTEGER)) AS _fivetran_synced
    FROM orders""", [])
    c["raw_salesforce_account"] = (f"""
    SELECT 'a_' || c_custkey AS id,
           CASE WHEN c_custkey % 11 <> 0 THEN 'cus_' || c_custkey END AS stripe_customer_id__c,
           c_name AS name, {_arr(A.ACCOUNT_TYPES)}[c_custkey % 3 + 1] AS type, c_mktsegment AS industry,
           CAST(CASE WHEN c_custkey % 97 = 0 THEN NULL
                     WHEN c_custkey % 4 = 0 THEN c_custkey % 10
                     WHEN c_custkey % 4 = 1 THEN 10 + c_custkey % 190
                     WHEN c_custkey % 4 = 2 THEN 200 + c_custkey % 800
                     ELSE 1000 + c_custkey END AS INTEGER) AS numberofemployees,
           c_acctbal * 1000 AS annualrevenue, n_name AS billingcountry,
           'S' || (c_custkey % 50) AS billingstate, '005' || (c_custkey % 7) AS ownerid,
           TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER)) AS createddate,
           TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER))
               + to_days(CAST(c_custkey % 300 AS INTEGER)) AS lastmodifieddate,
           {as_of} - to_hours(CAST({A.SALESFORCE_SYNC_LAG_H} + c_custkey % 60 AS INTEGER)) AS _fivetran_synced,
           c_custkey % 40 = 0 AS isdeleted
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""", [])
    c["raw_app_users"] = (f"""
    SELECT c_custkey AS id,
           ' User_' || c_custkey || '@Company.example ' AS email,
           CASE WHEN c_custkey % 17 <> 0 THEN {_arr(A.FIRST_NAMES)}[c_custkey % 8 + 1] END AS first_name,
           {_arr(A.LAST_NAMES)}[c_custkey % 8 + 1] AS last_name,
           CASE WHEN c_custkey % 25 <> 0 THEN c_custkey // 4 + 1 END AS organization_id,
           'cus_' || c_custkey AS stripe_customer_id,
           CASE WHEN c_custkey % 5 = 0 THEN 'admin' ELSE 'member' END AS role,
           CASE WHEN c_custkey % 20 = 0 THEN 'deactivated' WHEN c_custkey % 20 = 1 THEN 'invited'
                ELSE 'active' END AS status,
           {_arr(A.SIGNUP_SOURCES)}[c_custkey % 4 + 1] AS signup_source,
           CAST(NULL AS VARCHAR) AS referral_code,
           TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER)) AS created_at,
           TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER))
               + to_days(CAST(c_custkey % 50 AS INTEGER)) AS updated_at,
           TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(c_custkey % 700 AS INTEGER))
               + to_days(CAST(c_custkey % 90 AS INTEGER)) AS last_login_at,
           CASE WHEN c_custkey % 9 <> 0 THEN TIMESTAMP '1995-01-01 00:00:00'
               + to_days(CAST(c_custkey % 700 AS INTEGER)) + to_days(1) END AS email_verified_at,
           {as_of} - to_hours(CAST({A.APP_LOAD_LAG_H} + c_custkey % 10 AS INTEGER)) AS _loaded_at
    FROM customer""", [])
    c["raw_app_events"] = (f"""
    SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS session_id, event_type AS event_name,
           '{{"source":"web","feature":"'
             || {_arr(A.FEATURES)}[CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 + 1]
             || '","k":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}}' AS event_properties,
           {_arr(A.FEATURES)}[CAST(json_extract_string(props, '$.k') AS BIGINT) % 4 + 1] AS feature,
           ts AS occurred_at, ts + INTERVAL 1 HOUR AS _loaded_at
    FROM events""", [])
    c["raw_stripe_customers"] = ("SELECT 'cus_' || c_custkey AS id FROM customer", [])
    c["raw_stripe_charges"] = ("SELECT 'ch_' || o_orderkey AS id FROM orders", [])
    c["raw_salesforce_contact"] = ("SELECT '003' || c_custkey AS id FROM customer", [])
    c["raw_app_subscriptions"] = (f"""
    SELECT *, coalesce(canceled_at, started_at) AS updated_at,
           {as_of} - to_hours({A.APP_LOAD_LAG_H}) AS _loaded_at FROM (
      SELECT o_orderkey AS id, o_custkey AS user_id, o_custkey // 4 + 1 AS organization_id,
             'sub_' || o_orderkey AS stripe_sub_id, {_arr(A.PLAN_NAMES)}[o_orderkey % 4 + 1] AS plan_name,
             CASE WHEN o_orderkey % 3 = 0 THEN 'annual' ELSE 'monthly' END AS plan_type,
             CASE WHEN o_orderstatus = 'F' THEN 'canceled' ELSE 'active' END AS status,
             CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE {_arr(A.PRICES_CENTS)}[o_orderkey % 4 + 1] END AS amount_cents,
             o_orderdate AS started_at,
             CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST((o_orderkey * 37) % 900 AS INTEGER)) END
               AS canceled_at
      FROM orders)""", [])
    c["app_sessions"] = ("""
    SELECT user_id, session_index, started_at, ended_at, events_count FROM app_sessions_wide""", ["app_sessions_wide"])
    c["app_sessions_wide"] = ("""
    SELECT user_id, session_index, min(occurred_at) AS started_at, max(occurred_at) AS ended_at,
           count(*) AS events_count, count(*) FILTER (WHERE event_name = 'view') AS page_views,
           max(_loaded_at) AS _loaded_at
    FROM (SELECT *, CAST(sum(is_new) OVER (PARTITION BY user_id ORDER BY occurred_at
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS BIGINT) AS session_index
          FROM (SELECT user_id, occurred_at, event_name, _loaded_at,
                       CASE WHEN occurred_at - lag(occurred_at) OVER (PARTITION BY user_id ORDER BY occurred_at)
                                 <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS is_new
                FROM raw_app_events WHERE user_id IS NOT NULL AND occurred_at IS NOT NULL))
    GROUP BY 1, 2""", ["raw_app_events"])
    c["raw_app_sessions"] = ("""
    SELECT md5(coalesce(CAST(user_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
               coalesce(CAST(started_at AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS session_id,
           user_id, started_at, ended_at, page_views, events_count, _loaded_at
    FROM app_sessions_wide""", ["app_sessions_wide"])
    c["raw_salesforce_opportunity"] = (f"""
    SELECT 'op_' || o_orderkey AS id, 'a_' || o_custkey AS accountid,
           {_arr(A.OPPORTUNITY_STAGES)}[o_orderkey % 6 + 1] AS stage_name,
           CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderdate AS createddate,
           CASE WHEN o_orderkey % 6 >= 4 THEN o_orderdate + to_days(CAST(o_orderkey % 60 AS INTEGER)) END AS closedate,
           false AS isdeleted
    FROM orders""", [])

    # ---------------------------------------------------------------- staging
    def e2ts(col):
        return f"make_timestamp(CAST({col} AS BIGINT) * 1000000)"
    c["stg_subscriptions"] = (f"""
    SELECT id AS subscription_id, customer AS customer_id, plan_id, status AS subscription_status,
           json_extract_string(metadata, '$.plan_type') AS plan_type,
           json_extract_string(metadata, '$.billing_cycle') AS billing_cycle,
           json_extract_string(metadata, '$.acquisition_channel') AS acquisition_channel,
           plan_amount AS plan_amount_cents,
           CAST(plan_amount / 100.0 AS DECIMAL(18,2)) AS plan_amount_dollars,
           {e2ts('created')} AS created_at, {e2ts('current_period_start')} AS period_start_at,
           {e2ts('current_period_end')} AS period_end_at, {e2ts('trial_start')} AS trial_start_at,
           {e2ts('trial_end')} AS trial_end_at, {e2ts('canceled_at')} AS canceled_at,
           {e2ts('ended_at')} AS ended_at, cancel_at_period_end AS is_cancel_at_period_end,
           CASE WHEN trial_end IS NOT NULL AND {e2ts('trial_end')} > {as_of} THEN true ELSE false END AS is_in_trial,
           _fivetran_synced AS _fivetran_synced_at
    FROM raw_stripe_subscriptions WHERE _fivetran_deleted = false""", ["raw_stripe_subscriptions"])
    c["stg_invoices"] = (f"""
    SELECT id AS invoice_id, subscription AS subscription_id, customer AS customer_id, charge AS charge_id,
           number AS invoice_number, status AS invoice_status, billing_reason,
           CAST(total / 100.0 AS DECIMAL(18,2)) AS amount_due_dollars,
           CAST(amount_paid / 100.0 AS DECIMAL(18,2)) AS amount_paid_dollars,
           CAST((total - amount_paid) / 100.0 AS DECIMAL(18,2)) AS amount_remaining_dollars,
           CAST((total - tax) / 100.0 AS DECIMAL(18,2)) AS subtotal_dollars,
           CAST(tax / 100.0 AS DECIMAL(18,2)) AS tax_dollars,
           CAST(total / 100.0 AS DECIMAL(18,2)) AS total_dollars,
           upper(currency) AS currency_code,
           {e2ts('created')} AS created_at, {e2ts('created')} AS period_start_at,
           {e2ts('created + 30 * 86400')} AS period_end_at, {e2ts('created + 30 * 86400')} AS due_at,
           {e2ts('paid_at')} AS paid_at,
           paid AS is_paid, attempted AS is_attempted, forgiven AS is_forgiven,
           _fivetran_synced AS _fivetran_synced_at
    FROM raw_stripe_invoices WHERE _fivetran_deleted = false""", ["raw_stripe_invoices"])
    unknown = "WHEN numberofemployees IS NULL THEN 'Unknown'" if corrected else ""
    c["stg_accounts"] = (f"""
    SELECT id AS account_id, stripe_customer_id__c AS stripe_customer_id, name AS account_name,
           type AS account_type, industry, numberofemployees AS employee_count,
           annualrevenue AS annual_revenue_dollars,
           CASE WHEN numberofemployees < 10 THEN 'SMB' WHEN numberofemployees < 200 THEN 'Mid-Market'
                WHEN numberofemployees < 1000 THEN 'Enterprise' {unknown} ELSE 'Strategic' END AS account_segment,
           billingcountry AS billing_country, billingstate AS billing_state, ownerid AS account_owner_id,
           createddate AS created_at, lastmodifieddate AS updated_at,
           _fivetran_synced AS _fivetran_synced_at, isdeleted
    FROM raw_salesforce_account WHERE isdeleted = false""", ["raw_salesforce_account"])
    c["stg_users"] = ("""
    SELECT id AS user_id, stripe_customer_id, organization_id, email, md5(lower(trim(email))) AS email_hash,
           first_name, last_name, first_name || ' ' || last_name AS full_name,
           role AS user_role, status AS user_status, signup_source, referral_code,
           created_at, updated_at, last_login_at, email_verified_at,
           CASE WHEN email_verified_at IS NOT NULL THEN true ELSE false END AS is_email_verified,
           CASE WHEN status = 'active' THEN true ELSE false END AS is_active,
           _loaded_at
    FROM raw_app_users""", ["raw_app_users"])

    # ----------------------------------------------------------- intermediate
    c["months"] = (f"""
    SELECT CAST(g AS DATE) AS month_start
    FROM generate_series({_ts(p.spine_start)}, {_ts(p.spine_end)}, INTERVAL 1 MONTH) t(g)""", [])
    # corrected mode: months start at the creation, and a zero row marks the cancel month
    start = "created_at" if corrected else "period_start_at"
    churned = ("WHEN CAST(date_trunc('month', s.canceled_at) AS DATE) = m.month_start THEN 0" if corrected else "")
    upto = "<=" if corrected else "<"
    c["subscription_periods"] = (f"""
    SELECT s.subscription_id, s.customer_id, s.plan_id, m.month_start, s.plan_type, s.billing_cycle,
           s.subscription_status,
           CAST(CASE {churned} WHEN s.billing_cycle = 'annual' THEN s.plan_amount_dollars / 12.0
                     WHEN s.billing_cycle = 'monthly' THEN s.plan_amount_dollars
                     ELSE s.plan_amount_dollars END AS DECIMAL(18,6)) AS mrr,
           CASE WHEN CAST(date_trunc('month', s.{start}) AS DATE) = m.month_start
                THEN true ELSE false END AS is_first_month,
           CASE WHEN s.canceled_at IS NOT NULL AND CAST(date_trunc('month', s.canceled_at) AS DATE) = m.month_start
                THEN true ELSE false END AS is_churn_month,
           s.period_start_at, s.canceled_at, s.trial_start_at, s.trial_end_at
    FROM stg_subscriptions s
    JOIN months m
      ON m.month_start >= CAST(date_trunc('month', s.{start}) AS DATE)
     AND m.month_start {upto} coalesce(CAST(date_trunc('month', s.canceled_at) AS DATE), {_d(p.open_end)})
    WHERE s.plan_amount_dollars > 0""", ["stg_subscriptions", "months"])
    c["app_users_rollup"] = ("""
    SELECT organization_id, min(created_at) AS first_user_created_at,
           count(DISTINCT user_id) AS total_user_count,
           count(DISTINCT CASE WHEN is_active THEN user_id END) AS active_user_count
    FROM stg_users GROUP BY 1""", ["stg_users"])
    c["dim_accounts"] = ("""
    SELECT sa.account_id, sa.stripe_customer_id, sa.account_name, sa.account_type, sa.account_segment,
           sa.industry, sa.employee_count, sa.annual_revenue_dollars, sa.billing_country, sa.billing_state,
           au.total_user_count, au.active_user_count, au.first_user_created_at AS product_first_used_at,
           sa.created_at AS account_created_at, sa.updated_at AS account_updated_at,
           CASE WHEN sa.account_type = 'Customer' THEN true ELSE false END AS is_customer
    FROM stg_accounts sa
    LEFT JOIN app_users_rollup au ON sa.account_id = 'a_' || CAST(au.organization_id AS VARCHAR)""",
                         ["stg_accounts", "app_users_rollup"])
    c["mrr_with_lag"] = ("""
    SELECT p.*, lag(p.mrr) OVER (PARTITION BY p.subscription_id ORDER BY p.month_start) AS prior_month_mrr
    FROM subscription_periods p""", ["subscription_periods"])
    c["mrr_movements"] = ("""
    SELECT * FROM (
    SELECT *, CAST(mrr - coalesce(prior_month_mrr, 0) AS DECIMAL(18,6)) AS mrr_change,
           CASE WHEN prior_month_mrr IS NULL AND mrr > 0 THEN 'new'
                WHEN prior_month_mrr IS NULL OR (prior_month_mrr = 0 AND mrr = 0) THEN 'inactive'
                WHEN prior_month_mrr = 0 AND mrr > 0 THEN 'reactivation'
                WHEN mrr > prior_month_mrr THEN 'expansion'
                WHEN mrr = 0 AND prior_month_mrr > 0 THEN 'churn'
                WHEN mrr < prior_month_mrr THEN 'contraction'
                ELSE 'retained' END AS mrr_type
    FROM mrr_with_lag) WHERE mrr_type <> 'inactive'""" if corrected else """
    SELECT *, CAST(mrr - coalesce(prior_month_mrr, 0) AS DECIMAL(18,6)) AS mrr_change,
           CASE WHEN prior_month_mrr IS NULL OR prior_month_mrr = 0 THEN 'new'
                WHEN mrr > prior_month_mrr THEN 'expansion'
                WHEN mrr < prior_month_mrr AND mrr > 0 THEN 'contraction'
                WHEN mrr = 0 AND prior_month_mrr > 0 THEN 'churn'
                WHEN prior_month_mrr = 0 AND mrr > 0 THEN 'reactivation'
                ELSE 'retained' END AS mrr_type
    FROM mrr_with_lag""", ["mrr_with_lag"])
    segment = "coalesce(a.account_segment, 'Unassigned') AS account_segment" if corrected else "a.account_segment"
    c["fct_mrr"] = (f"""
    SELECT md5(coalesce(CAST(m.subscription_id AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
               coalesce(CAST(m.month_start AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS mrr_id,
           m.month_start, m.subscription_id, m.customer_id, m.plan_id, m.plan_type, m.billing_cycle,
           m.subscription_status, a.account_id, a.account_name, {segment}, a.industry,
           a.billing_country, m.mrr, m.prior_month_mrr, m.mrr_change, m.mrr_type,
           m.is_first_month, m.is_churn_month, CAST(m.mrr * 12 AS DECIMAL(18,6)) AS arr
    FROM mrr_movements m LEFT JOIN dim_accounts a ON m.customer_id = a.stripe_customer_id""",
                    ["mrr_movements", "dim_accounts"])
    c["monthly_by_segment"] = ("""
    SELECT month_start, account_segment,
           CAST(sum(mrr) AS DECIMAL(28,6)) AS total_mrr,
           CAST(sum(mrr) * 12 AS DECIMAL(28,6)) AS total_arr,
           CAST(sum(CASE WHEN mrr_type = 'new' THEN mrr ELSE 0 END) AS DECIMAL(28,6)) AS new_mrr,
           CAST(sum(CASE WHEN mrr_type = 'expansion' THEN mrr_change ELSE 0 END) AS DECIMAL(28,6)) AS expansion_mrr,
           CAST(sum(CASE WHEN mrr_type = 'contraction' THEN mrr_change ELSE 0 END) AS DECIMAL(28,6)) AS contraction_mrr,
           CAST(sum(CASE WHEN mrr_type = 'churn' THEN prior_month_mrr ELSE 0 END) AS DECIMAL(28,6)) AS churned_mrr,
           CAST(sum(CASE WHEN mrr_type = 'reactivation' THEN mrr ELSE 0 END) AS DECIMAL(28,6)) AS reactivation_mrr,
           count(DISTINCT customer_id) AS active_customer_count,
           count(DISTINCT CASE WHEN mrr_type = 'new' THEN customer_id END) AS new_customer_count,
           count(DISTINCT CASE WHEN mrr_type = 'churn' THEN customer_id END) AS churned_customer_count,
           CAST(CAST(sum(mrr) AS DECIMAL(28,6)) AS DOUBLE)
               / CAST(nullif(count(DISTINCT customer_id), 0) AS DOUBLE) AS arpu
    FROM fct_mrr GROUP BY 1, 2""", ["fct_mrr"])
    c["monthly_revenue"] = ("""
    SELECT *,
           lag(total_mrr) OVER (PARTITION BY account_segment ORDER BY month_start) AS prior_month_mrr,
           CAST(total_mrr - lag(total_mrr) OVER (PARTITION BY account_segment ORDER BY month_start) AS DOUBLE)
             / CAST(nullif(lag(total_mrr) OVER (PARTITION BY account_segment ORDER BY month_start), 0) AS DOUBLE)
             AS mom_growth_rate
    FROM monthly_by_segment""", ["monthly_by_segment"])
    return c


def with_ctes(final: str, needs: list[str], p: Params = FIXTURE) -> str:
    """Prefix ``final`` with the CTEs it needs, dependencies first."""
    defs = ctes(p)
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for d in defs[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({defs[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


def oracle_sql(p: Params = FIXTURE) -> dict[str, str]:
    q: dict[str, str] = {}
    q["stg_subscriptions"] = with_ctes("SELECT * FROM stg_subscriptions", ["stg_subscriptions"], p)
    q["stg_invoices"] = with_ctes("SELECT * FROM stg_invoices", ["stg_invoices"], p)
    q["stg_accounts"] = with_ctes("SELECT * FROM stg_accounts", ["stg_accounts"], p)
    q["stg_users"] = with_ctes("SELECT * FROM stg_users", ["stg_users"], p)
    q["subscription_periods"] = with_ctes("SELECT * FROM subscription_periods", ["subscription_periods"], p)
    q["dim_accounts"] = with_ctes("SELECT * FROM dim_accounts", ["dim_accounts"], p)
    q["fct_mrr"] = with_ctes("SELECT * FROM fct_mrr", ["fct_mrr"], p)
    q["monthly_revenue"] = with_ctes(
        "SELECT * FROM monthly_revenue ORDER BY month_start DESC, account_segment", ["monthly_revenue"], p)
    fixed = p.with_(mode=CORRECTED)
    by_quarter = """
    SELECT CAST(date_trunc('quarter', month_start) AS DATE) AS quarter_start, {segment} AS account_segment,
           count(DISTINCT customer_id) AS active_customers,
           count(DISTINCT CASE WHEN mrr_type = 'new' THEN customer_id END) AS new_customers,
           count(DISTINCT CASE WHEN mrr_type = 'churn' THEN customer_id END) AS churned_customers
    FROM fct_mrr WHERE customer_id IS NOT NULL GROUP BY 1, 2"""
    q["quarterly_customers"] = with_ctes(
        by_quarter.format(segment="account_segment") + "\n    UNION ALL" + by_quarter.format(segment="'All'"), ["fct_mrr"], p)
    q["monthly_revenue_corrected"] = with_ctes("SELECT * FROM monthly_revenue", ["monthly_revenue"], fixed)
    q["build_monthly_revenue"] = q["monthly_revenue"]
    # two orders share a subscription id, mostly with different customers
    q["fct_mrr_transfers"] = q["fct_mrr"].replace("'sub_' || o_orderkey AS id", "'sub_' || (o_orderkey // 2) AS id", 1).replace(
        "PARTITION BY p.subscription_id ORDER BY p.month_start",
        "PARTITION BY p.subscription_id ORDER BY p.month_start, p.customer_id, p.period_start_at")
    q["date_spine"] = with_ctes(f"""
    SELECT CAST(g AS DATE) AS month_start
    FROM (SELECT greatest(min(CAST(date_trunc('month', period_start_at) AS DATE)), {_d(p.spine_start)}) AS lo
          FROM stg_subscriptions) b,
         generate_series(CAST(b.lo AS TIMESTAMP), {_ts(p.spine_end)}, INTERVAL 1 MONTH) t(g)""",
                                ["stg_subscriptions"], p)
    q.update(_movement_sql(p))
    q.update(_quality_sql(p))
    q.update(_load_sql(p))
    q.update(_seed_sql(p))
    q.update(_growth_sql(p))
    return q


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


# ------------------------------------------------------------------- movement
def _movement_sql(p: Params) -> dict[str, str]:
    end = _ts(p.spine_end)
    base = f"""
    WITH monthly AS (
        SELECT o_custkey AS customer_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS m,
               sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
    firsts AS (SELECT customer_key, min(m) AS first_m, greatest(max(m), CAST({end} AS DATE)) AS last_m
               FROM monthly GROUP BY 1),
    calendar AS (SELECT CAST(g AS DATE) AS month_start
                 FROM generate_series((SELECT CAST(min(first_m) AS TIMESTAMP) FROM firsts),
                                      (SELECT CAST(max(last_m) AS TIMESTAMP) FROM firsts), INTERVAL 1 MONTH) t(g)),
    series AS (
        SELECT f.customer_key, c.month_start, CAST(coalesce(mo.cents, 0) AS BIGINT) AS order_cents
        FROM firsts f JOIN calendar c ON c.month_start BETWEEN f.first_m AND f.last_m
        LEFT JOIN monthly mo ON mo.customer_key IS NOT DISTINCT FROM f.customer_key AND mo.m = c.month_start),
    lagged AS (SELECT *, lag(order_cents) OVER (PARTITION BY customer_key ORDER BY month_start) AS prior_cents
               FROM series)"""
    exact = f"""{base}
    SELECT customer_key, month_start, order_cents, prior_cents,
           order_cents - coalesce(prior_cents, 0) AS cents_change,
           CASE WHEN prior_cents IS NULL OR prior_cents = 0 THEN 'new'
                WHEN order_cents > prior_cents THEN 'expansion'
                WHEN order_cents < prior_cents AND order_cents > 0 THEN 'contraction'
                WHEN order_cents = 0 AND prior_cents > 0 THEN 'churn'
                WHEN prior_cents = 0 AND order_cents > 0 THEN 'reactivation'
                ELSE 'retained' END AS movement
    FROM lagged"""
    corrected = f"""{base}
    SELECT * FROM (
    SELECT customer_key, month_start, order_cents, prior_cents,
           order_cents - coalesce(prior_cents, 0) AS cents_change,
           CASE WHEN prior_cents IS NULL AND order_cents > 0 THEN 'new'
                WHEN prior_cents IS NULL OR (prior_cents = 0 AND order_cents = 0) THEN 'inactive'
                WHEN prior_cents = 0 AND order_cents > 0 THEN 'reactivation'
                WHEN order_cents > prior_cents THEN 'expansion'
                WHEN order_cents = 0 AND prior_cents > 0 THEN 'churn'
                WHEN order_cents < prior_cents THEN 'contraction'
                ELSE 'retained' END AS movement
    FROM lagged) WHERE movement <> 'inactive'"""
    waterfall = f"""
    SELECT month_start, CAST(sum(order_cents) AS BIGINT) AS total_cents,
           CAST(sum(CASE WHEN movement = 'new' THEN order_cents ELSE 0 END) AS BIGINT) AS new_cents,
           CAST(sum(CASE WHEN movement = 'expansion' THEN cents_change ELSE 0 END) AS BIGINT) AS expansion_cents,
           CAST(sum(CASE WHEN movement = 'contraction' THEN cents_change ELSE 0 END) AS BIGINT) AS contraction_cents,
           CAST(sum(CASE WHEN movement = 'churn' THEN prior_cents ELSE 0 END) AS BIGINT) AS churned_cents,
           CAST(sum(CASE WHEN movement = 'reactivation' THEN order_cents ELSE 0 END) AS BIGINT) AS reactivation_cents,
           count(DISTINCT CASE WHEN order_cents > 0 THEN customer_key END) AS active_customers,
           count(DISTINCT CASE WHEN movement = 'new' THEN customer_key END) AS new_customers,
           count(DISTINCT CASE WHEN movement = 'churn' THEN customer_key END) AS churned_customers
    FROM ({corrected}) GROUP BY 1"""
    return {"movement_classify": exact, "movement_classify_corrected": corrected, "movement_waterfall": waterfall}


# -------------------------------------------------------------------- quality
_CHECK_TABLE = {
    "stripe.subscriptions": "raw_stripe_subscriptions", "stripe.invoices": "raw_stripe_invoices",
    "stripe.customers": "raw_stripe_customers", "stripe.charges": "raw_stripe_charges",
    "salesforce.account": "raw_salesforce_account", "salesforce.opportunity": "raw_salesforce_opportunity",
    "salesforce.contact": "raw_salesforce_contact", "app_db.users": "raw_app_users",
    "app_db.subscriptions": "raw_app_subscriptions", "app_db.events": "raw_app_events",
    "app_db.sessions": "raw_app_sessions", "fct_mrr": "fct_mrr", "dim_accounts": "dim_accounts",
    "rpt_monthly_revenue": "monthly_revenue",
}


def _check_count_sql(ch) -> str:
    t, c = _CHECK_TABLE[ch.model], ch.column
    where = f"WHERE {ch.where}" if ch.where else ""
    if ch.test == "unique":
        return f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
    if ch.test == "not_null":
        return f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"
    if ch.test == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in ch.values)
        return f"(SELECT count(*) FROM (SELECT {c} AS v FROM {t} {where} GROUP BY {c}) WHERE v NOT IN ({vals}))"
    if ch.test == "between":
        return f"(SELECT count(*) FROM {t} WHERE NOT ({c} >= {ch.min_value} AND {c} <= {ch.max_value}))"
    raise ValueError(ch.test)


def _suite_sql(checks, p: Params) -> str:
    rows = [f"SELECT '{ch.model}' AS model, '{ch.column}' AS column_name, '{ch.test}' AS test_name, "
            f"CAST({_check_count_sql(ch)} AS BIGINT) AS failures" for ch in checks]
    body = "\n    UNION ALL ".join(rows)
    needs = sorted({_CHECK_TABLE[ch.model] for ch in checks})
    return with_ctes(f"SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status FROM (\n    {body})",
                     needs, p)


def _quality_sql(p: Params) -> dict[str, str]:
    from monthwise.plans import quality_suite as QS
    q = {}
    for kind, name in [("unique", "dq_unique"), ("not_null", "dq_not_null"),
                       ("accepted_values", "dq_accepted_values"), ("between", "dq_between")]:
        q[name] = _suite_sql([c for c in QS.ALL_CHECKS if c.test == kind], p)
    q["dq_gate_summary"] = _suite_sql(QS.MART_CHECKS, p)
    q["dq_source_tests"] = _suite_sql(QS.SOURCE_CHECKS, p)
    q["dq_no_future_dates"] = with_ctes(f"""
    SELECT canceled_at, count(*) AS num_records FROM stg_subscriptions
    WHERE canceled_at > {_ts(p.as_of)} GROUP BY 1 HAVING count(*) > 0""", ["stg_subscriptions"], p)
    q["dq_positive_values"] = with_ctes("""
    SELECT subscription_id, plan_amount_dollars FROM stg_subscriptions WHERE plan_amount_dollars <= 0""",
                                        ["stg_subscriptions"], p)

    fresh_cols = {"stripe": "_fivetran_synced", "salesforce": "_fivetran_synced", "app_db": "_loaded_at"}
    raw_sync = {  # loaded-at expressions of the raw tables not spelled out as CTEs above
        ("stripe", "customers"): (f"{_ts(p.as_of)} - to_hours(CAST({A.STRIPE_SYNC_LAG_H} + c_custkey % 48 AS INTEGER))",
                                  "customer"),
        ("stripe", "charges"): (f"{_ts(p.as_of)} - to_hours(CAST({A.STRIPE_SYNC_LAG_H} + o_orderkey % 48 AS INTEGER))",
                                "orders"),
        ("salesforce", "opportunity"): (
            f"{_ts(p.as_of)} - to_hours(CAST({A.SALESFORCE_SYNC_LAG_H} + o_orderkey % 60 AS INTEGER))", "orders"),
        ("salesforce", "contact"): (
            f"{_ts(p.as_of)} - to_hours(CAST({A.SALESFORCE_SYNC_LAG_H} + c_custkey % 60 AS INTEGER))", "customer"),
        ("app_db", "subscriptions"): (f"{_ts(p.as_of)} - to_hours({A.APP_LOAD_LAG_H})", "orders"),
    }
    cte_tables = {("stripe", "subscriptions"): "raw_stripe_subscriptions",
                  ("stripe", "invoices"): "raw_stripe_invoices",
                  ("salesforce", "account"): "raw_salesforce_account",
                  ("app_db", "users"): "raw_app_users", ("app_db", "events"): "raw_app_events"}

    def max_loaded(system, table):
        col = fresh_cols[system]
        if (system, table) in cte_tables:
            return f"(SELECT max({col}) FROM {cte_tables[(system, table)]})", [cte_tables[(system, table)]]
        if (system, table) == ("app_db", "sessions"):
            return "(SELECT max(occurred_at + INTERVAL 1 HOUR) FROM raw_app_events)", ["raw_app_events"]
        expr, base = raw_sync[(system, table)]
        return f"(SELECT max({expr}) FROM {base})", []

    def clock(system, table):
        return p.clock(system, table)

    rows, needs = [], set()
    for system, (_, warn_h, err_h, tables) in QS.FRESHNESS.items():
        for t in tables:
            m, n = max_loaded(system, t)
            needs.update(n)
            now = _ts(clock(system, t))
            age = f"date_diff('second', {m}, {now})"
            rows.append(f"""SELECT '{system}' AS source_name, '{t}' AS table_name, {m} AS max_loaded_at,
               {now} AS snapshotted_at, {age} AS age_seconds, {warn_h} AS warn_after_hours,
               {err_h} AS error_after_hours,
               CASE WHEN {m} IS NULL OR {age} > {err_h * 3600} THEN 'error'
                    WHEN {age} > {warn_h * 3600} THEN 'warn' ELSE 'pass' END AS status""")
    q["source_freshness"] = with_ctes("\n    UNION ALL ".join(rows), sorted(needs), p)

    rows, needs = [], set()
    for system, table, max_h in QS.STALE_PROBE:
        m, n = max_loaded(system, table)
        needs.update(n)
        hours = f"date_diff('hour', {m}, {_ts(clock(system, table))})"
        rows.append(f"""SELECT '{system}.{table}' AS table_name, {m} AS latest_sync, {hours} AS hours_old,
               {max_h} AS max_hours, ({m} IS NULL OR {hours} > {max_h}) AS is_stale""")
    q["stale_sources"] = with_ctes("\n    UNION ALL ".join(rows), sorted(needs), p)

    ev_cols = ["event_id", "user_id", "session_id", "event_name", "event_properties", "occurred_at", "_loaded_at"]
    user_cols = ["id", "email", "first_name", "last_name", "organization_id", "stripe_customer_id", "role", "status",
                 "signup_source", "referral_code", "created_at", "updated_at", "last_login_at", "email_verified_at",
                 "_loaded_at"]

    def profile(table, src_sql, cols):
        parts = [f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS non_null_count, "
                 f"count(*) AS batch_rows, (count({c}) = 0 AND count(*) > 0) AS is_all_null, "
                 f"count(*) = 0 AS is_empty_batch FROM {src_sql}" for c in cols]
        return "\n    UNION ALL ".join(parts)
    batch = (f"(SELECT event_id, user_id, session_id, event_name, event_properties, occurred_at, "
             f"{_ts(p.clock("app_db", "events"))} AS _loaded_at FROM raw_app_events WHERE occurred_at > {_ts(p.events_mark)})")
    sub_cols = ["id", "user_id", "organization_id", "stripe_sub_id", "plan_name", "plan_type", "status",
                "amount_cents", "started_at", "canceled_at", "updated_at", "_loaded_at"]
    session_cols = ["session_id", "user_id", "started_at", "ended_at", "page_views", "events_count", "_loaded_at"]
    q["all_null_columns"] = with_ctes(
        "\n    UNION ALL ".join([profile("events", batch, ev_cols), profile("users", "raw_app_users", user_cols),
                                 profile("subscriptions", "raw_app_subscriptions", sub_cols),
                                 profile("sessions", "raw_app_sessions", session_cols)]),
        ["raw_app_events", "raw_app_users", "raw_app_subscriptions", "raw_app_sessions"], p)
    q["row_counts"] = with_ctes("""
    SELECT 'users' AS tbl, count(*) AS row_count FROM raw_app_users
    UNION ALL SELECT 'subscriptions', count(*) FROM raw_app_subscriptions
    UNION ALL SELECT 'events', count(*) FROM raw_app_events""",
                                ["raw_app_users", "raw_app_subscriptions", "raw_app_events"], p)
    return q


# ---------------------------------------------------------------------- loads
def _load_sql(p: Params) -> dict[str, str]:
    q = {}
    mark, ev_now, now = _ts(p.events_mark), _ts(p.clock("app_db", "events")), _ts(p.as_of)
    # 16 fetches of nearly equal rows a table; a day above such a share is cut by its key
    fetches, views = [], []
    for t, mark_col, key in (("users", "updated_at", "id"), ("subscriptions", "updated_at", "id"),
                             ("events", "occurred_at", "event_id"), ("sessions", "ended_at", None)):
        views.append(f"raw_app_{t}")
        cut = (lambda n: f"CASE WHEN {n} > 1 THEN abs(coalesce({key}, 0)) % {n} ELSE 0 END") if key else lambda n: "0"
        fetches.append(f"""
    SELECT '{t}' AS table_name, CAST(part AS INTEGER) AS part, count(*) AS n_rows, min(m) AS first_mark, max(m) AS last_mark
    FROM (
      WITH by_day AS (SELECT CAST({mark_col} AS DATE) AS d, count(*) AS n FROM raw_app_{t} GROUP BY 1),
      shares AS (SELECT d, n, (coalesce(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 16)
                        // sum(n) OVER () AS share, (n * 16 + sum(n) OVER () - 1) // sum(n) OVER () AS slices
                 FROM by_day WHERE d IS NOT NULL),
      ranges AS (SELECT *, CASE WHEN slices = 1 AND share = lag(CASE WHEN slices = 1 THEN share END) OVER (ORDER BY d)
                                THEN 0 ELSE slices END AS adds FROM shares),
      days AS (SELECT d, slices, sum(adds) OVER (ORDER BY d) - slices AS first_part FROM ranges),
      unmarked AS (SELECT greatest(1, (coalesce(sum(CASE WHEN d IS NULL THEN n END), 0) * 16 + sum(n) - 1) // sum(n)) AS slices
                   FROM by_day)
      SELECT r.{mark_col} AS m,
             CASE WHEN r.{mark_col} IS NOT NULL THEN days.first_part + {cut('days.slices')}
                  ELSE greatest((SELECT sum(adds) FROM ranges), 1) + {cut('(SELECT slices FROM unmarked)')} END AS part
      FROM raw_app_{t} r LEFT JOIN days ON CAST(r.{mark_col} AS DATE) = days.d)
    GROUP BY 2""")
    q["fetch_parts"] = with_ctes("    UNION ALL".join(fetches), views, p)
    q["incremental_extract"] = with_ctes(f"""
    SELECT event_id AS "EVENT_ID", user_id AS "USER_ID", session_id AS "SESSION_ID", event_name AS "EVENT_NAME",
           event_properties AS "EVENT_PROPERTIES", occurred_at AS "OCCURRED_AT", {ev_now} AS "_LOADED_AT"
    FROM raw_app_events WHERE occurred_at > {mark}""", ["raw_app_events"], p)
    counts = {
        "users": ("(SELECT count(*) FROM raw_app_users)", now),
        "subscriptions": ("(SELECT count(*) FROM raw_app_subscriptions)", now),
        "events": (f"(SELECT count(*) FROM raw_app_events WHERE occurred_at > {mark})", ev_now),
        "sessions": ("(SELECT count(*) FROM app_sessions)", ev_now),
    }
    needs = ["raw_app_users", "raw_app_subscriptions", "raw_app_events", "app_sessions"]
    q["load_summary"] = with_ctes("\n    UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CASE WHEN {c} = 0 THEN 'empty' ELSE 'success' END AS status, {c} AS rows_loaded, CAST(NULL AS VARCHAR) AS error"
        for t, (c, _) in counts.items()), needs, p)
    # both runs of the loader; the second reads strictly past the first one's clock
    upto = f"(SELECT count(*) FROM raw_app_events WHERE occurred_at <= {mark})"
    past = {"users": ("raw_app_users", "updated_at", now), "subscriptions": ("raw_app_subscriptions", "updated_at", now),
            "events": ("raw_app_events", "occurred_at", mark), "sessions": ("raw_app_sessions", "ended_at", ev_now)}
    nulls = {"users": "REFERRAL_CODE", "subscriptions": "", "events": "SESSION_ID", "sessions": ""}
    runs = []
    for t, (view, col, clk) in past.items():
        one = upto if t == "events" else f"(SELECT count(*) FROM {view})"
        two = f"(SELECT count(*) FROM {view} WHERE {col} > {clk})"
        runs.append(f"SELECT 1 AS run, '{t}' AS table_name, 'success' AS status, {one} AS rows_loaded, "
                    f"'{nulls[t]}' AS all_null_columns, false AS has_error, {one} AS raw_rows")
        if t == "users":
            runs.append(f"SELECT 2, '{t}', 'failed', NULL, NULL, true, {one}")
        else:
            runs.append(f"SELECT 2, '{t}', CASE WHEN {two} = 0 THEN 'empty' ELSE 'success' END, {two}, "
                        f"CASE WHEN {two} = 0 THEN '' ELSE '{nulls[t]}' END, false, {one} + {two}")
    q["loader_roundtrip"] = with_ctes("\n    UNION ALL ".join(runs),
                                      [v for v, _, _ in past.values()], p)
    ups = "\n        UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {clk} AS last_extracted, {c} AS rows_extracted, {clk} AS updated_at"
        for t, (c, clk) in counts.items())
    q["watermark_upsert"] = with_ctes(f"""
    SELECT table_name, last_extracted, rows_extracted, updated_at FROM (
        SELECT 'events' AS table_name, {mark} AS last_extracted,
               (SELECT count(*) FROM raw_app_events WHERE occurred_at <= {mark}) AS rows_extracted,
               {mark} AS updated_at
        UNION ALL {ups})
    QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY updated_at DESC) = 1""", needs, p)
    q["load_latest_by_key"] = with_ctes(f"""
    SELECT event_id, user_id, session_id, event_name, event_properties, occurred_at, _loaded_at FROM (
        SELECT event_id, user_id, session_id, event_name, event_properties, occurred_at, {mark} AS _loaded_at
        FROM raw_app_events WHERE occurred_at <= {mark}
        UNION ALL
        SELECT event_id, user_id, session_id, event_name, event_properties, occurred_at, {ev_now} AS _loaded_at
        FROM raw_app_events WHERE occurred_at > {mark} - INTERVAL 1 DAY)
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY _loaded_at DESC) = 1""", ["raw_app_events"], p)
    q["stream_events_dedup"] = """
    SELECT event_id, user_id, event_type AS event_name, props AS event_properties, ts AS occurred_at
    FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1"""
    return q


# ---------------------------------------------------------------------- seeds
def _seed_sql(p: Params) -> dict[str, str]:
    from monthwise.sources import seedgen as S
    now = _ts(p.as_of)

    def frac(salt):
        return f"(CAST(('0x' || substr(md5(i || '|{salt}'), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"

    def before(salt, days):
        return f"{now} - to_seconds(CAST(floor({frac(salt)} * {days} * 86400) AS BIGINT))"

    def pick(values, expr="i"):
        return f"{_arr(values)}[{expr} % {len(values)} + 1]"

    def uuid_like(prefix):
        h = f"md5('{prefix}' || CAST(i AS VARCHAR))"
        return (f"substring({h}, 1, 8) || '-' || substring({h}, 9, 4) || '-' || substring({h}, 13, 4) || '-' || "
                f"substring({h}, 17, 4) || '-' || substring({h}, 21, 12)")
    org = f"CAST(ceil(i / {S.USERS_PER_ORG}) AS BIGINT)"
    q = {}
    q["seed_users"] = f"""
    SELECT i AS id, 'user_' || i || '@company_' || {org} || '.com' AS email,
           {pick(S.FIRST_NAMES)} AS first_name, {pick(S.LAST_NAMES)} AS last_name, {org} AS organization_id,
           'cus_' || md5(CAST(i AS VARCHAR)) AS stripe_customer_id,
           CASE WHEN i % 5 = 0 THEN 'admin' ELSE 'member' END AS role,
           CASE WHEN i % 20 = 0 THEN 'deactivated' ELSE 'active' END AS status,
           {pick(S.SIGNUP_SOURCES)} AS signup_source,
           {before(1, 730)} AS created_at, {before(2, 30)} AS updated_at,
           {before(3, 7)} AS last_login_at, {before(4, 700)} AS email_verified_at
    FROM (SELECT c_custkey + 1 AS i FROM customer)"""
    q["seed_subscriptions"] = f"""
    SELECT i AS id, CAST(i * {S.USERS_PER_ORG} AS BIGINT) AS user_id, i AS organization_id,
           'sub_' || md5(CAST(i AS VARCHAR)) AS stripe_sub_id, {pick(S.PLAN_NAMES)} AS plan_name,
           CASE WHEN i % 3 = 0 THEN 'annual' ELSE 'monthly' END AS plan_type,
           CASE WHEN i % 15 = 0 THEN 'canceled' ELSE 'active' END AS status,
           CAST({pick(S.PRICES_CENTS)} AS BIGINT) AS amount_cents, {before(5, 600)} AS started_at
    FROM (SELECT DISTINCT CAST(ceil((c_custkey + 1) / {S.USERS_PER_ORG}) AS BIGINT) AS i FROM customer)"""
    q["seed_events"] = f"""
    SELECT {uuid_like('e')} AS event_id, CAST(i % (SELECT max(c_custkey) + 1 FROM customer) + 1 AS BIGINT) AS user_id,
           {uuid_like('s')} AS session_id, {pick(S.EVENT_NAMES)} AS event_name,
           '{{"source": "web", "feature": "' || {pick(S.FEATURES)} || '"}}' AS event_properties,
           {before(6, 90)} AS occurred_at
    FROM (SELECT o_orderkey + 1 AS i FROM orders)"""
    return q


# --------------------------------------------------------------------- growth
def _growth_sql(p: Params) -> dict[str, str]:
    q = {}
    cm = """
    cm AS (SELECT customer_id, month_start, sum(mrr) AS mrr FROM fct_mrr WHERE customer_id IS NOT NULL
           GROUP BY 1, 2 HAVING sum(mrr) > 0)"""
    q["nrr"] = with_ctes(f"""
    , {cm.strip()}
    SELECT CAST(c1.month_start + INTERVAL 12 MONTH AS DATE) AS month_start, count(*) AS cohort_customers,
           count(c2.mrr) AS retained_customers, CAST(sum(c1.mrr) AS DECIMAL(28,6)) AS starting_mrr,
           CAST(sum(coalesce(c2.mrr, 0)) AS DECIMAL(28,6)) AS retained_mrr,
           {_ratio('CAST(sum(coalesce(c2.mrr, 0)) AS DECIMAL(28,6))', 'CAST(sum(c1.mrr) AS DECIMAL(28,6))')} AS nrr
    FROM cm c1 LEFT JOIN cm c2
      ON c2.customer_id = c1.customer_id AND c2.month_start = CAST(c1.month_start + INTERVAL 12 MONTH AS DATE)
    WHERE CAST(c1.month_start + INTERVAL 12 MONTH AS DATE) <= {_d(p.spine_end)}
    GROUP BY 1""", ["fct_mrr"], p).replace(")\n    , cm AS", "),\n    cm AS", 1)
    q["cohort_retention"] = with_ctes(f"""
    , {cm.strip()},
    c AS (SELECT *, min(month_start) OVER (PARTITION BY customer_id) AS cohort_month FROM cm),
    a AS (SELECT cohort_month, CAST(date_diff('month', cohort_month, month_start) AS INTEGER) AS months_since,
                 count(customer_id) AS active_customers FROM c GROUP BY 1, 2)
    SELECT *, {_ratio('active_customers', 'cohort_size')} AS retention_rate FROM (
      SELECT *, max(CASE WHEN months_since = 0 THEN active_customers END)
                  OVER (PARTITION BY cohort_month) AS cohort_size FROM a)""", ["fct_mrr"], p
                                      ).replace(")\n    , cm AS", "),\n    cm AS", 1)
    now = _ts(p.as_of)
    q["trial_funnel"] = with_ctes(f"""
    SELECT *, {_ratio('trials_converted', 'trials_ended')} AS conversion_rate FROM (
    SELECT CAST(date_trunc('month', trial_start_at) AS DATE) AS month_start, acquisition_channel,
           count(*) AS trials_started,
           count(*) FILTER (WHERE trial_end_at <= {now}) AS trials_ended,
           count(*) FILTER (WHERE trial_end_at <= {now} AND plan_amount_dollars > 0
                            AND (canceled_at IS NULL OR canceled_at > trial_end_at)) AS trials_converted,
           count(*) FILTER (WHERE is_in_trial) AS in_trial
    FROM stg_subscriptions WHERE trial_start_at IS NOT NULL GROUP BY 1, 2)""", ["stg_subscriptions"], p)
    q["trial_conversions"] = with_ctes(f"""
    SELECT subscription_id, customer_id, plan_id, acquisition_channel, trial_start_at, trial_end_at,
           CAST(date_trunc('month', trial_start_at) AS DATE) AS month_start, is_in_trial,
           coalesce(trial_end_at <= {now}, false) AS has_ended,
           CASE WHEN trial_end_at > {now} OR trial_end_at IS NULL THEN 'open'
                WHEN plan_amount_dollars > 0 AND (canceled_at IS NULL OR canceled_at > trial_end_at) THEN 'converted'
                ELSE 'lost' END AS outcome,
           CASE WHEN trial_end_at <= {now} AND plan_amount_dollars > 0
                     AND (canceled_at IS NULL OR canceled_at > trial_end_at) THEN trial_end_at END AS converted_at,
           date_diff('day', trial_start_at, trial_end_at) AS trial_days
    FROM stg_subscriptions WHERE trial_start_at IS NOT NULL""", ["stg_subscriptions"], p)
    q["opportunity_velocity"] = with_ctes(f"""
    SELECT *, {_ratio('total_days', 'closed_count')} AS average_days,
           {_ratio('closed_amount', 'total_days')} AS amount_per_day FROM (
      SELECT CAST(date_trunc('month', createddate) AS DATE) AS month_start, stage_name, count(*) AS closed_count,
             CAST(sum(date_diff('day', createddate, closedate)) AS BIGINT) AS total_days,
             max(date_diff('day', createddate, closedate)) AS longest_days,
             CAST(sum(amount) AS DECIMAL(28,2)) AS closed_amount
      FROM raw_salesforce_opportunity WHERE isdeleted = false AND closedate IS NOT NULL GROUP BY 1, 2)""",
                                          ["raw_salesforce_opportunity"], p)
    q["feature_adoption"] = with_ctes(f"""
    SELECT f.*, a.active_users, {_ratio('f.feature_users', 'a.active_users')} AS adoption_rate FROM (
      SELECT CAST(date_trunc('month', occurred_at) AS DATE) AS month_start,
             json_extract_string(event_properties, '$.feature') AS feature,
             count(DISTINCT user_id) AS feature_users, count(*) AS feature_events
      FROM raw_app_events GROUP BY 1, 2) f
    JOIN (SELECT CAST(date_trunc('month', occurred_at) AS DATE) AS month_start,
                 count(DISTINCT user_id) AS active_users FROM raw_app_events GROUP BY 1) a
      ON f.month_start = a.month_start""", ["raw_app_events"], p)
    end = _d(p.spine_end)
    q["fct_subscriptions"] = with_ctes(f"""
    SELECT s.subscription_id, s.customer_id, s.plan_id, s.subscription_status, s.billing_cycle,
           s.acquisition_channel, s.created_at, s.canceled_at,
           a.first_active_month, a.last_active_month, coalesce(a.tenure, 0) AS tenure_months,
           CAST(CASE WHEN s.billing_cycle = 'annual' THEN s.plan_amount_dollars / 12.0
                     ELSE s.plan_amount_dollars END AS DECIMAL(18,6)) AS mrr,
           CAST(CASE WHEN a.last_active_month = {end} THEN a.mrr ELSE 0 END AS DECIMAL(18,6)) AS current_mrr,
           CAST(coalesce(a.lifetime, 0) AS DECIMAL(28,6)) AS lifetime_mrr,
           coalesce(a.last_active_month = {end}, false) AS is_active
    FROM stg_subscriptions s LEFT JOIN (
        SELECT subscription_id, min(month_start) AS first_active_month, max(month_start) AS last_active_month,
               count(*) AS tenure, sum(mrr) AS lifetime, max(mrr) AS mrr
        FROM subscription_periods GROUP BY 1) a ON s.subscription_id = a.subscription_id""",
                                       ["stg_subscriptions", "subscription_periods"], p)
    q["opportunity_stages"] = with_ctes(f"""
    SELECT *, {_ratio('won', 'won + lost')} AS win_rate FROM (
      SELECT *, sum(CASE WHEN stage_name = 'Closed Won' THEN opportunity_count ELSE 0 END)
                  OVER (PARTITION BY month_start) AS won,
                sum(CASE WHEN stage_name = 'Closed Lost' THEN opportunity_count ELSE 0 END)
                  OVER (PARTITION BY month_start) AS lost
      FROM (SELECT CAST(date_trunc('month', createddate) AS DATE) AS month_start, stage_name,
                   count(*) AS opportunity_count, CAST(sum(amount) AS DECIMAL(28,2)) AS pipeline_amount
            FROM raw_salesforce_opportunity WHERE isdeleted = false GROUP BY 1, 2))""",
                                        ["raw_salesforce_opportunity"], p)
    q["opportunity_stages"] = (
        "SELECT month_start, stage_name, opportunity_count, pipeline_amount, win_rate FROM ("
        + q["opportunity_stages"] + ")")
    q["scd2_snapshot"] = """
    SELECT md5(CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR)) AS scd_id,
           o_custkey AS customer_key, o_orderkey AS order_key, o_orderpriority AS order_priority,
           o_orderdate AS valid_from,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS valid_to,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS version_number,
           lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) IS NULL AS is_current
    FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL"""
    # the incremental snapshot must reproduce the full-history snapshot
    q["scd2_incremental"] = q["scd2_snapshot"]
    q["sessions"] = with_ctes("SELECT * FROM app_sessions", ["app_sessions"], p)
    q["stream_sessions"] = q["sessions"]
    return q
