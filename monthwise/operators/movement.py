"""M9: movement classifier - ``(df, key, period, value)`` -> prior value, change,
movement class.  The reusable core of the MRR fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.params import CORRECTED, EXACT

# Movement classes.
NEW, EXPANSION, CONTRACTION, CHURN, REACTIVATION, RETAINED = (
    "new", "expansion", "contraction", "churn", "reactivation", "retained")
INACTIVE = "inactive"   # corrected mode: 0 -> 0, dropped from the output
MOVEMENTS = [NEW, EXPANSION, CONTRACTION, CHURN, REACTIVATION, RETAINED]


def classify_sql(v: str, prior: str, mode: str = EXACT) -> str:
    """The CASE of the reference, arm order included (``mode='exact'``): its
    first arm takes ``prior = 0``, so ``reactivation`` is unreachable and 0 -> 0
    is ``new``.  ``mode='corrected'`` tests reactivation first and marks 0 -> 0
    as ``inactive``."""
    if mode == CORRECTED:
        arms = [(f"{prior} IS NULL AND {v} > 0", NEW),
                (f"{prior} IS NULL OR ({prior} = 0 AND {v} = 0)", INACTIVE),
                (f"{prior} = 0 AND {v} > 0", REACTIVATION),
                (f"{v} > {prior}", EXPANSION),
                (f"{v} = 0 AND {prior} > 0", CHURN),
                (f"{v} < {prior}", CONTRACTION)]
    else:
        arms = [(f"{prior} IS NULL OR {prior} = 0", NEW),
                (f"{v} > {prior}", EXPANSION),
                (f"{v} < {prior} AND {v} > 0", CONTRACTION),
                (f"{v} = 0 AND {prior} > 0", CHURN),
                (f"{prior} = 0 AND {v} > 0", REACTIVATION)]
    whens = " ".join(f"WHEN {c} THEN '{t}'" for c, t in arms)
    return f"CASE {whens} ELSE '{RETAINED}' END"


def movement_classify(df: DataFrame, key: list[str], period: str | list[str], value: str,
                      prior_col: str = "prior_value", change_col: str = "value_change",
                      type_col: str = "movement", mode: str = EXACT,
                      change_type: str | None = None) -> DataFrame:
    """Adds ``lag(value) over (partition by key order by period)``, the change
    ``value - coalesce(prior, 0)`` and the movement class.

    ``lag`` is the previous *row*, not the previous calendar month (as in the
    reference).  The window needs ``df`` clustered by ``key``; callers that
    pre-partition on ``key`` (or a subset of it) avoid a shuffle here."""
    w = Window.partitionBy(*key).orderBy(*([period] if isinstance(period, str) else period))
    out = df.withColumn(prior_col, F.lag(value).over(w))
    return add_movement(out, value, prior_col, change_col, type_col, mode, change_type)


def prior_in_runs(df: DataFrame, key: list[str], first: str, last: str, order: list[str], value: str,
                  prior_first: str, prior_rest: str) -> DataFrame:
    """The ``lag`` of :func:`movement_classify` for rows that stand for runs of months (``first``
    to ``last``, ``value`` the same in all of them), without a row per month.

    Runs are cut where any run of the key begins or ends, so the runs of one stretch cover the
    same months.  There a row's prior value is that of the row before it in ``order``; the first
    row's is that of the last row, one month earlier, or in the stretch's first month that of
    the stretch before.  A key has no more stretches than the calendar has months, so there
    are never more rows than months would give, and mostly far fewer.  ``prior_first`` is the
    prior value in the first month of a (cut) run, ``prior_rest`` that in its later months."""
    cuts = F.expr(f"array_sort(array_distinct(flatten(array(collect_set({first}) OVER k, collect_set(add_months({last}, 1)) OVER k))))"
                  .replace("OVER k", f"OVER (PARTITION BY {', '.join(key)})"))
    own = f"filter(__cuts, c -> c >= {first} AND c <= add_months({last}, 1))"
    cut = (df.withColumn("__cuts", cuts).withColumn("__cuts", F.expr(own))
           .selectExpr("*", "posexplode(slice(__cuts, 1, size(__cuts) - 1)) AS (__at, __start)")
           .withColumns({first: F.col("__start"), last: F.expr("add_months(__cuts[__at + 1], -1)")}).drop("__cuts", "__at", "__start"))
    rows = Window.partitionBy(*key).orderBy(first, *order)
    stretch = Window.partitionBy(*key, first).orderBy(*order)
    out = cut.withColumns({
        prior_first: F.lag(value).over(rows), "__before": F.lag(first).over(rows),
        "__last_value": F.last(value).over(stretch.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))})
    return out.withColumn(prior_rest, F.expr(f"CASE WHEN __before = {first} THEN {prior_first} ELSE __last_value END")).drop(
        "__before", "__last_value")


def add_movement(out: DataFrame, value: str, prior_col: str, change_col: str = "value_change",
                 type_col: str = "movement", mode: str = EXACT, change_type: str | None = None) -> DataFrame:
    """Change and movement class from a value and its (already known) prior."""
    change = f"{value} - coalesce({prior_col}, 0)"
    if change_type:
        change = f"CAST({change} AS {change_type})"
    out = out.withColumns({change_col: F.expr(change), type_col: F.expr(classify_sql(value, prior_col, mode))})
    if mode == CORRECTED:
        out = out.where(f"{type_col} <> '{INACTIVE}'")
    return out
