"""Bucketed catalog tables: written by the build, read without an exchange, by any session."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from monthwise.fixture import FIXTURE
from monthwise.operators.quality import unique_parts_failures
from monthwise.plans import build
from monthwise.plans.mrr import fct_mrr
from monthwise.sources.registry import Sources


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("warehouse"))
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    return root, build.build_all(spark, src, FIXTURE, root, target="prod", run_gate=False, growth_marts=False), src


def test_the_fact_is_whole_and_bucketed(spark, built):
    root, tables, src = built
    fact, want = tables["fct_mrr"], fct_mrr(src, FIXTURE)
    assert fact.columns == want.columns and fact.exceptAll(want).isEmpty() and want.exceptAll(fact).isEmpty()
    log = spark.read.parquet(f"{root}/_current").where("table_name = 'fct_mrr'").first()
    assert (log.bucket_column, log.buckets, log.partition_column) == ("subscription_id", 8, "month_start")


def test_movement_and_key_check_read_it_without_an_exchange(built):
    """F1 over the stored fact, and Q1 on the parts of its key."""
    fact = built[1]["fct_mrr"]
    lagged = fact.withColumn("again", F.lag("mrr").over(Window.partitionBy("subscription_id").orderBy("month_start", "customer_id")))
    assert "Exchange" not in plan_of(lagged) and "Bucketed: true" in plan_of(lagged)
    assert lagged.where("NOT (again <=> prior_month_mrr)").count() == 0
    repeated = unique_parts_failures(fact, ("subscription_id", "month_start"))
    assert "Exchange" not in plan_of(repeated) and repeated.count() == 0


def test_joins_on_the_bucket_column_are_co_located(built):
    fact = built[1]["fct_mrr"]
    first = fact.groupBy("subscription_id").agg(F.min("month_start").alias("first"))
    joined = fact.hint("merge").join(first, "subscription_id")
    assert "Exchange" not in plan_of(joined) and joined.count() == fact.count()


def test_months_are_still_pruned(built):
    one = built[1]["fct_mrr"].where(F.col("month_start") == dt.date(2000, 1, 1))
    assert "PartitionFilters: [isnotnull(month_start" in plan_of(one) and one.count() > 0


def test_a_session_without_the_catalog_entry(spark, built):
    """Another session or metastore knows only the files and the log."""
    root, tables, _ = built
    n = tables["fct_mrr"].count()
    run = spark.read.parquet(f"{root}/_current").where("table_name = 'fct_mrr'").first().run_id
    spark.sql(f"DROP TABLE `{build.version_name('marts', 'fct_mrr', run)}`")
    again = build.read_current(spark, root, "marts", "fct_mrr")
    assert again.count() == n
    assert "Exchange" not in plan_of(unique_parts_failures(again, ("subscription_id", "month_start")))


def test_an_empty_fact_can_be_read(spark, workdir):
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    none = fct_mrr(src, FIXTURE).where("false")
    out = build.materialize_table(spark, none, workdir, "marts", "fct_mrr", "prod", "x", "r1", bucket_by="subscription_id", buckets=4)
    assert out.count() == 0 and out.columns == none.columns


def test_the_key_repeats_when_its_parts_do(spark):
    """NULL parts are one value, as in the key; the count is that of the key itself."""
    rows = [("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1), (None, None), (None, None), (None, None), ("b", None)]
    df = spark.createDataFrame(rows, "s string, m int").selectExpr("*", "md5(concat(coalesce(s, '_'), '-', coalesce(string(m), '_'))) AS k")
    by_key = df.groupBy("k").count().where("count > 1").count()
    assert unique_parts_failures(df, ("s", "m")).count() == by_key == 3
