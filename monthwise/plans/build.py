"""The layered daily build.

staging (views) -> intermediate (views) -> marts (tables) -> reporting (tables)
-> data-quality gate on marts + reporting.  Each table is written once to a
fresh folder of the shared warehouse/checkpoint location and downstream models
read the written table (lineage is cut there; a lost executor recomputes from
the table, not from the raw sources)."""

from __future__ import annotations

import datetime as dt
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions.spine import months_between
from monthwise.operators.quality import gate, run_checks
from monthwise.params import Params
from monthwise.plans.reports import REPORT_COLUMNS
from monthwise.session import default_parallelism, new_work_path, open_files, shared_dir
from monthwise.sources.incremental import latest_by_key, read_slots, write_slot
from monthwise.sources.registry import Sources


def schema_name(layer: str | None, target: str, default_schema: str) -> str:
    """Prod uses the bare layer name, other targets prefix it with the
    personal schema, no layer means the default schema."""
    if layer is None:
        return default_schema
    return layer.strip() if target == "prod" else f"{default_schema}_{layer.strip()}"


def materialize_view(df: DataFrame, layer: str | None, name: str, target: str, default_schema: str) -> str:
    """A view is a named lazy plan."""
    view = f"{schema_name(layer, target, default_schema)}__{name}"
    df.createOrReplaceTempView(view)
    return view


# Rows of the fact that one task of the build expands into its month files.
ROWS_PER_TASK = 1_000_000
# Month files that a task of a dealt write keeps open; rows of further months are sorted by file.
OPEN_FILES = 16

CURRENT = ("schema_name string, table_name string, run_id string, path string, written_at timestamp, "
           "bucket_column string, buckets int, partition_column string")


def materialize_table(spark: SparkSession, df: DataFrame, root: str, layer: str, name: str, target: str,
                      default_schema: str, run_id: str, bucket_by: str | None = None, buckets: int | None = None, dealt: bool = False,
                      plain: tuple[str, ...] = ()) -> DataFrame:
    """Full rebuild.  The rows go to a fresh folder (readers of the last build are not
    disturbed), partitioned by ``month_start`` where there is one; then one row written to
    the ``_current`` log (two slots a table) makes them the table's current version.

    With ``bucket_by`` the rows are also dealt to ``buckets`` (default: the shuffle partitions)
    by that column, sorted by it in each file, and the version is a catalog table: whoever
    groups, joins or orders by the column reads it without an exchange.  Choose a column
    with few rows per value (a hot value is one bucket).

    ``dealt``: ``df`` is already partitioned by the column, into a multiple of ``buckets``, and each
    partition's rows come month after month, in the column's order (``expand_by_month``).  So each
    task's rows belong to one bucket and are neither shuffled nor sorted again; a task keeps
    its month files open, and writes them one after the other.

    ``plain``: columns whose values hardly repeat in a file, written without a dictionary (which
    would hold each of them in memory)."""
    schema = schema_name(layer, target, default_schema)
    path = f"{root.rstrip('/')}/{schema}/{name}/run-{run_id}"
    monthly = "month_start" if "month_start" in df.columns else None
    if bucket_by:
        buckets = buckets or default_parallelism(spark)
        # by the hash that buckets use; not dealt before: one task per bucket, a file per bucket and month
        w = (df if dealt else df.repartition(buckets, bucket_by)).write.bucketBy(buckets, bucket_by).option("compression", "zstd")
        w = (w if dealt else w.sortBy(bucket_by)).options(**{f"parquet.enable.dictionary#{c}": "false" for c in plain})
        with open_files(spark, OPEN_FILES if dealt else 0):
            (w.partitionBy(monthly) if monthly else w).option("path", path).format("parquet").saveAsTable(version_name(schema, name, run_id))
    else:
        # rebalance: files by month, large months split, small ones not spread over all tasks
        w = (df.hint("rebalance", monthly) if monthly else df).write
        (w.partitionBy(monthly) if monthly else w).parquet(path)
    log = [(schema, name, run_id, path, dt.datetime.now(dt.timezone.utc), bucket_by, buckets if bucket_by else None, monthly)]
    write_slot(spark, spark.createDataFrame(log, CURRENT), f"{root.rstrip('/')}/_current", f"{schema}.{name}", "written_at")
    out = read_current(spark, root, schema, name, df.schema).select(*df.columns)
    out.createOrReplaceTempView(f"{schema}__{name}")
    return out


def version_name(schema: str, name: str, run_id: str) -> str:
    return f"{schema}__{name}__{run_id}"


def read_current(spark: SparkSession, root: str, schema: str, name: str, columns=None) -> DataFrame:
    """The current version of a built table, for any session.  ``columns``: its schema,
    needed only for a partitioned table without rows.  A bucketed version that the
    session's catalog does not know (another metastore, a new session) is entered there
    first, over its files."""
    log = read_slots(spark, f"{root.rstrip('/')}/_current", CURRENT)
    mine = log.where((F.col("schema_name") == schema) & (F.col("table_name") == name))
    last = latest_by_key(mine, ["schema_name", "table_name"], ["written_at", "run_id"]).first()
    if last is None:
        raise KeyError(f"{schema}.{name} has not been built below {root}")
    if last["bucket_column"] is None:
        return (spark.read.schema(columns) if columns else spark.read).parquet(last["path"])
    table = version_name(schema, name, last["run_id"])
    if not spark.catalog.tableExists(table):
        enter_bucketed(spark, table, last, columns)
    return spark.table(table)


def enter_bucketed(spark: SparkSession, table: str, version, columns=None) -> None:
    """A written bucketed version (row of the ``_current`` log) as an external catalog table."""
    fields = (columns or spark.read.parquet(version["path"]).schema).fields
    month, column = version["partition_column"], version["bucket_column"]
    ordered = [f for f in fields if f.name != month] + [f for f in fields if f.name == month]
    definition = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered)
    partitioned = f"PARTITIONED BY (`{month}`)" if month else ""
    spark.sql(f"CREATE TABLE `{table}` ({definition}) USING parquet {partitioned} CLUSTERED BY (`{column}`) "
              f"INTO {version['buckets']} BUCKETS LOCATION '{version['path']}'")
    if month:
        spark.catalog.recoverPartitions(table)


def build_all(spark: SparkSession, src: Sources, p: Params, root: str | None = None, target: str = "dev",
              default_schema: str = "analytics", run_gate: bool = True, growth_marts: bool = True) -> dict[str, DataFrame]:
    """Build every layer in dependency order; optionally gate on the checks."""
    from monthwise.plans import accounts, mrr, periods, reports, staging
    from monthwise.plans.quality_suite import MART_CHECKS

    root = root or f"{shared_dir(spark).rstrip('/')}/warehouse"
    run_id = uuid.uuid4().hex[:12]
    out: dict[str, DataFrame] = {}
    for name, fn in [("stg_stripe__subscriptions", staging.stg_subscriptions),
                     ("stg_stripe__invoices", staging.stg_invoices),
                     ("stg_salesforce__accounts", staging.stg_accounts),
                     ("stg_app__users", staging.stg_users)]:
        out[name] = fn(src, p)
        materialize_view(out[name], "staging", name, target, default_schema)
    out["int_subscription_periods"] = periods.subscription_periods(src, p)
    materialize_view(out["int_subscription_periods"], "intermediate", "int_subscription_periods", target,
                     default_schema)
    dim = materialize_table(spark, accounts.dim_accounts(src, p), root, "marts", "dim_accounts", target,
                            default_schema, run_id)
    # by subscription: the movement (lag) and the key's uniqueness read it without an exchange
    buckets = default_parallelism(spark)
    slices = -(-mrr.fact_months(src, p) // (buckets * ROWS_PER_TASK)) or 1         # tasks a bucket: by month, then by key
    months = len(months_between(p.spine_start, p.spine_end))
    blocks = min(max(slices, -(-months // OPEN_FILES)), months)
    fact = materialize_table(spark, mrr.fct_mrr(src, p, dim, buckets * -(-slices // blocks), blocks), root, "marts", "fct_mrr", target,
                             default_schema, run_id, bucket_by="subscription_id", buckets=buckets, dealt=True,
                             plain=("mrr_id", "subscription_id", "customer_id", "account_id", "account_name"))
    rpt = materialize_table(spark, reports.monthly_revenue_from_fact(fact), root, "reporting",
                            "rpt_monthly_revenue", target, default_schema, run_id)
    out.update({"dim_accounts": dim, "fct_mrr": fact, "rpt_monthly_revenue": rpt})
    # growth marts and reports, from the written fact (computed once per build)
    from monthwise.plans import growth
    for layer, name, df in [] if not growth_marts else [("marts", "fct_subscriptions", growth.fct_subscriptions(src, p)),
                            ("reporting", "rpt_nrr", growth.nrr(src, p, fact)),
                            ("reporting", "rpt_cohort_retention", growth.cohort_retention(src, p, fact)),
                            ("reporting", "rpt_trial_funnel", growth.trial_funnel(src, p)),
                            ("reporting", "rpt_feature_adoption", growth.feature_adoption(src, p))]:
        out[name] = materialize_table(spark, df, root, layer, name, target, default_schema, run_id)
    checks = run_checks({"dim_accounts": dim, "fct_mrr": fact, "rpt_monthly_revenue": rpt}, MART_CHECKS, p.as_of)
    # written once; the gate and every later reader use the table
    summary = materialize_table(spark, checks, root, "quality", "dq_summary", target, default_schema, run_id)
    out["dq_summary"] = summary
    if run_gate:
        gate(summary)
    return out


def build_monthly_revenue(src: Sources, p: Params) -> DataFrame:
    """The report as the layered build leaves it: built, published, read back."""
    root = new_work_path(src.spark, "warehouse")
    build_all(src.spark, src, p, root, target="prod", run_gate=False, growth_marts=False)
    return read_current(src.spark, root, "reporting", "rpt_monthly_revenue").select(*REPORT_COLUMNS)


class SourceStale(RuntimeError):
    pass


def run_daily(spark: SparkSession, src: Sources, p: Params, root: str | None = None, target: str = "prod",
              default_schema: str = "analytics", load=None, fail_on_stale: bool = True) -> dict[str, DataFrame]:
    """The schedule's order: stale-source probe (warns, never blocks) -> optional
    app-table load (``load()``, e.g. :func:`monthwise.sources.incremental.run_loads`)
    -> layered build -> gate on marts + reporting -> source freshness.  Each step's
    outcome is a written table, so the probe shows the state before the load.  A failed
    gate raises, and so does a source in freshness state ``error``."""
    from monthwise.plans.quality_suite import source_freshness, stale_sources
    root = root or f"{shared_dir(spark).rstrip('/')}/warehouse"
    run_id = uuid.uuid4().hex[:12]

    def kept(df: DataFrame, name: str) -> DataFrame:
        return materialize_table(spark, df, root, "quality", name, target, default_schema, run_id)
    out: dict[str, DataFrame] = {"stale_sources": kept(stale_sources(src, p), "stale_sources")}
    stale = [r["table_name"] for r in out["stale_sources"].where("is_stale").collect()]      # one row per source
    if stale:
        warnings.warn(f"stale sources: {', '.join(sorted(stale))}", stacklevel=2)
    if load is not None:
        out["load_summary"] = load()
    out.update(build_all(spark, src, p, root, target, default_schema, run_gate=True))
    out["source_freshness"] = kept(source_freshness(src, p), "source_freshness")
    failed = out["source_freshness"].where("status = 'error'").collect()
    if failed and fail_on_stale:
        raise SourceStale("sources past their error limit: " + ", ".join(
            sorted(f"{r['source_name']}.{r['table_name']}" for r in failed)))
    return out
