"""M7 ``fct_mrr``: one row per (subscription, month) with prior MRR, change,
movement class, account attributes and ARR.

Plan shape (the fact is ~months x subscriptions, by far the largest table):

1. the account dimension is joined to the *subscription* rows before the month
   expansion.  The join key (customer) is a subscription attribute, so the result
   is the same as joining the fact, but the join moves one row per subscription.
   AQE broadcasts the dimension when its measured size is small and keeps a
   shuffle join (with skew splitting) otherwise.
2. nothing sorts, groups or shuffles the expanded rows: all work is done on runs of
   months (``mrr_runs``), and the expansion is the last step.
3. ``lag`` is per subscription id, over all its rows before accounts are joined (as
   in the reference).  An id with one source row expands into consecutive months, so
   its prior month follows from the run's first month (no sort).  Ids with several
   source rows (a broken unique key upstream, or a subscription handed to another
   customer) go through ``lag`` windows over their runs (``prior_in_runs``).  Which they are
   is found first, from the ids alone, so other rows are not moved by id; where there are
   none, adaptive execution drops that branch altogether.  If they are many (``FEW_SHARED``),
   all rows go through the windows, which treat an id of one row the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.functions.scalar import MONEY
from monthwise.operators.movement import add_movement, prior_in_runs
from monthwise.operators.range_expand import expand_by_month, expand_months
from monthwise.params import CORRECTED, Params

from monthwise.plans.periods import billable_subscriptions, open_until, with_month_flags
from monthwise.plans.staging import stg_accounts
from monthwise.session import new_work_path
from monthwise.sources.registry import Sources

SUBSCRIPTIONS_PER_TASK = 100_000     # bounds what a task of the windows and of the customer models orders
FEW_SHARED = 100_000                 # so many ids of several rows are sent to all tasks
UNASSIGNED = "Unassigned"   # corrected mode: segment of subscriptions without a CRM account

def fct_mrr_transfers(src: Sources, p: Params) -> DataFrame:
    """The fact over subscriptions of which two share an id, mostly across customers
    (order keys 2k and 2k + 1): every run goes through the ``lag`` windows."""
    subs = src("stripe", "subscriptions")
    shared = subs.withColumn("id", F.expr("concat('sub_', CAST(substring(id, 5) AS BIGINT) div 2)"))
    return fct_mrr(src.replaced("stripe", "subscriptions", shared), p)


def active_subscriptions(src: Sources, p: Params) -> DataFrame:
    """Billable subscriptions with their months within the calendar, ``__from`` to ``__to``."""
    subs = billable_subscriptions(src, p)
    return subs.withColumns({"__from": F.expr(first_month(p)), "__to": F.expr(last_month(p))}).where("__from <= __to")


def first_month(p: Params) -> str:
    return f"greatest(__lo, {S.date(p.spine_start)})"


def last_month(p: Params) -> str:
    return f"least(add_months({open_until(p)}, -1), {S.date(p.spine_end)})"


def fact_months(src: Sources, p: Params) -> int:
    """Rows of the fact (before accounts that share a customer fan out), from one narrow scan."""
    months = "(year(__to) - year(__from)) * 12 + month(__to) - month(__from) + 1"
    return active_subscriptions(src, p).agg(F.expr(f"coalesce(sum(CAST({months} AS BIGINT)), 0L)")).first()[0]


def shared_ids(subs: DataFrame) -> DataFrame | None:
    """The ids of several rows, written, from a shuffle of ids alone; None if they are more than
    ``FEW_SHARED``."""
    ids = subs.where("subscription_id IS NOT NULL").select("subscription_id").repartition("subscription_id")
    several = ids.groupBy("subscription_id").agg(F.expr("count(1)").alias("__n")).where("__n > 1").select("subscription_id")
    path = new_work_path(subs.sparkSession, "shared-ids")
    several.limit(FEW_SHARED + 1).write.parquet(path)           # enough to see that they are more
    shared = subs.sparkSession.read.schema(several.schema).parquet(path)
    return shared if shared.count() <= FEW_SHARED else None


def may_broadcast(df: DataFrame) -> bool:
    """Whether a join may send ``df`` to all tasks by its estimated size, or by that of some of its
    columns; true where the client cannot tell."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return size <= 4 * df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    except AttributeError:       # no JVM on this client
        return True


def mrr_runs(src: Sources, p: Params, dim: DataFrame | None = None) -> DataFrame:
    """The fact before its month expansion: a row per subscription and run of months
    (``__from`` to ``__to``, within the calendar) with its accounts.  ``__prior_first`` is the
    prior MRR in the run's first month, ``__prior_rest`` that in all later ones."""
    subs = active_subscriptions(src, p)
    if dim is None:
        # The fact uses only account columns, and dim_accounts carries the CRM
        # staging rows one-to-one (its app-user rollup matches at most one row
        # per account: the key prefix || org id is injective).  So the same
        # columns come straight from staging, without the rollup's shuffles.
        dim = stg_accounts(src, p)
    d = dim.selectExpr("account_id", "account_name", "account_segment", "industry", "billing_country",
                       "stripe_customer_id AS __dim_key")

    def accounts(rows: DataFrame) -> DataFrame:
        out = rows.join(d, F.expr("customer_id = __dim_key"), "left").drop("__dim_key")
        if p.mode == CORRECTED:
            # unmatched subscriptions get a segment label instead of NULL
            out = out.withColumn("account_segment", F.expr(f"coalesce(account_segment, '{UNASSIGNED}')"))
        return out

    bounds = {"__from": F.expr(first_month(p)), "__to": F.expr(last_month(p))}
    # bounds that follow from other columns are made after the moves
    moved = subs.select("subscription_id", "customer_id", "plan_id", "plan_type", "billing_cycle", "subscription_status", "mrr",
                        "__lo", "__cancel_month", "period_start_at")
    shared = shared_ids(subs)
    if shared is not None and may_broadcast(d):
        moved = moved.repartition("subscription_id")         # the join would leave the rows in the tasks of the scan
    if shared is not None:
        # One run an id: the previous row of month k is month k-1 of the same run.
        single = accounts(moved.drop("period_start_at").join(F.broadcast(shared), "subscription_id", "left_anti")).withColumns(
            bounds | {"__prior_first": F.expr(f"CAST(NULL AS {MONEY})"), "__prior_rest": F.col("mrr")})
        moved = moved.join(F.broadcast(shared), "subscription_id", "left_semi")
    # Several: the lag() windows over the id's runs; accounts join after them.
    if shared is None:
        tasks = -(-subs.count() // SUBSCRIPTIONS_PER_TASK) or 1          # a narrow scan; a fixed number is not coalesced at run time
        moved = moved.repartition(tasks, "subscription_id")
    else:
        moved = moved.repartition("subscription_id")
    runs = moved.withColumns(bounds)
    # rows without an id stay apart
    runs = runs.withColumn("__lone", F.expr("CASE WHEN subscription_id IS NULL THEN monotonically_increasing_id() END"))
    if p.mode == CORRECTED:
        # the churn month is a run of its own, of zero MRR
        runs = runs.selectExpr(*[f"`{c}`" for c in runs.columns if c not in ("mrr", "__from", "__to")],
                               "inline(filter(array(named_struct('mrr', mrr, '__from', __from, '__to', CASE WHEN __cancel_month <= __to "
                               f"THEN add_months(__cancel_month, -1) ELSE __to END), named_struct('mrr', CAST(0 AS {MONEY}), '__from', "
                               "CASE WHEN __cancel_month <= __to THEN __cancel_month END, '__to', __to)), r -> r.__from <= r.__to))")
    runs = prior_in_runs(runs, ["subscription_id", "__lone"], "__from", "__to", ["customer_id", "period_start_at"], "mrr",
                         "__prior_first", "__prior_rest")
    multi = accounts(runs.drop("__lone", "period_start_at"))
    return multi if shared is None else single.unionByName(multi)


def fct_mrr(src: Sources, p: Params, dim: DataFrame | None = None, parts: int | None = None, blocks: int = 1) -> DataFrame:
    """``parts``: the runs are dealt to that many partitions by subscription id, and sorted by it;
    each partition's rows come month after month, in that order, in ``blocks`` tasks of some months each."""
    runs = mrr_runs(src, p, dim)
    if parts:
        runs = runs.repartition(parts, "subscription_id").sortWithinPartitions("subscription_id")
        m = expand_by_month(runs, "__from", "__to", p.spine_start, p.spine_end, blocks)
    else:
        m = expand_months(runs, "__from", "add_months(__to, 1)", p.spine_start, p.spine_end)
    m = with_month_flags(m, p)
    m = m.withColumn("prior_month_mrr", F.expr("CASE WHEN month_start > __from THEN __prior_rest ELSE __prior_first END"))
    m = add_movement(m, "mrr", prior_col="prior_month_mrr", change_col="mrr_change", type_col="mrr_type", mode=p.mode,
                     change_type=MONEY)
    return m.selectExpr(
        f"{S.surrogate_key('subscription_id', 'month_start')} AS mrr_id",
        "month_start", "subscription_id", "customer_id", "plan_id", "plan_type", "billing_cycle",
        "subscription_status", "account_id", "account_name", "account_segment", "industry",
        "billing_country", "mrr", "prior_month_mrr", "mrr_change", "mrr_type", "is_first_month",
        "is_churn_month", f"CAST(mrr * 12 AS {MONEY}) AS arr",
    )
