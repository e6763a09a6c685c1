"""Skew-split ordered operators against brute force, loaders end to end, the
events stream, the layered build, and plan-shape assertions."""

import datetime as dt
import os
import random
import shutil

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from monthwise.operators.scd2 import scd2_history
from monthwise.operators.sessions import sessionize
from monthwise.fixture import FIXTURE
from monthwise.plans import quality_suite
from monthwise.sources import incremental as inc
from monthwise.sources.registry import Sources


def _events(n_users=5, n=600, hot_share=0.4, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = 0 if rnd.random() < hot_share else rnd.randrange(1, n_users)      # one hot user
        # bursts with gaps around the 30-minute limit, crossing hour boundaries
        t = t0 + dt.timedelta(minutes=rnd.choice([0, 10, 29, 31, 45, 59, 61]) * (i // 3) + rnd.random())
        rows.append((i, user, t))
    return rows


def _brute_sessions(rows, gap_s):
    df = pd.DataFrame(rows, columns=["id", "user", "ts"]).sort_values(["user", "ts"])
    out = []
    for u, g in df.groupby("user"):
        idx, prev = -1, None
        for ts in g.ts:
            if prev is None or (ts - prev).total_seconds() > gap_s:
                idx += 1
                out.append([u, idx, ts, ts, 0])
            out[-1][3] = ts
            out[-1][4] += 1
            prev = ts
    return sorted(tuple(x) for x in out)


@pytest.mark.parametrize("seed", [7, 8, 9])
def test_sessionize_matches_brute_force(spark, seed):
    rows = _events(seed=seed)
    df = spark.createDataFrame(rows, "id long, user long, ts timestamp_ntz")
    got = sorted((r.user, r.session_index, r.started_at, r.ended_at, r.events_count)
                 for r in sessionize(df, "user", "ts", 1800).collect())
    assert got == _brute_sessions(rows, 1800)


def test_sessions_scan_and_shuffle_events_once(spark):
    df = sessionize(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "user_id", "ts", 1800)
    plan = _plan(df)
    assert plan.count("FileScan") == 1 and "Join" not in plan
    # events leave their tasks as partial sums per (user, slice)
    assert "partial_min(ts" in plan


def test_scd2_matches_brute_force_with_hot_key_and_ties(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(400):
        key = 0 if rnd.random() < 0.35 else rnd.randrange(1, 20)
        rows.append((key, dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 60)), k, f"p{k % 3}"))
    df = spark.createDataFrame(rows, "key long, upd timestamp_ntz, ok long, attr string")
    got = {r.ok: (r.valid_to, r.version_number, r.is_current)
           for r in scd2_history(df, "key", "upd", "ok", ["attr"], "day").collect()}
    pdf = pd.DataFrame(rows, columns=["key", "upd", "ok", "attr"]).sort_values(["key", "upd", "ok"])
    for _, g in pdf.groupby("key"):
        recs = list(g.itertuples())
        for i, r in enumerate(recs):
            nxt = recs[i + 1].upd.to_pydatetime() if i + 1 < len(recs) else None
            assert got[r.ok] == (nxt, i + 1, nxt is None)


def test_stored_snapshot_equals_batch_history(spark, workdir):
    from monthwise.operators.scd2 import SnapshotTable
    rnd = random.Random(11)
    rows = []
    for k in range(500):
        key = 0 if rnd.random() < 0.35 else rnd.randrange(1, 25)
        rows.append((key, dt.datetime(2020, 1, 1) + dt.timedelta(days=rnd.randrange(0, 90)), k, f"p{k % 3}"))
    df = spark.createDataFrame(rows, "key long, upd timestamp_ntz, ok long, attr string")
    args = ("key", "upd", "ok", ["attr"], "day")
    full = scd2_history(df, *args)
    first, second = ("TIMESTAMP_NTZ '2020-02-10 00:00:00'", "TIMESTAMP_NTZ '2020-03-01 00:00:00'")
    table = SnapshotTable(spark, os.path.join(workdir, "snap"), *args)
    for part in (f"upd <= {first}", f"upd > {first} AND upd <= {second}", f"upd > {second}",
                 f"upd <= {first}"):                              # old rows again change nothing
        table.merge(df.where(part))
    got = table.read().select(*full.columns)
    assert table.runs() == 4 and got.count() == full.count()
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    # closed versions were appended, not rewritten: each is in the run that closed it
    assert spark.read.parquet(os.path.join(workdir, "snap", "history", "run=4")).count() == 0


def test_incremental_loader_end_to_end(spark, workdir):
    state, target = os.path.join(workdir, "state"), os.path.join(workdir, "raw")
    src = spark.createDataFrame([(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i)) for i in range(10)],
                                "id long, updated_at timestamp_ntz")
    spec = inc.TableSpec("users", "updated_at", 1000)
    n1 = inc.extract_table(spark, src.filter("id < 6"), spec, state, target, dt.datetime(2024, 1, 6, 12))
    assert n1 == {"__rows": 6, "ID": 6, "UPDATED_AT": 6, "_LOADED_AT": 6}
    n2 = inc.extract_table(spark, src, spec, state, target, dt.datetime(2024, 1, 20))
    assert n2["__rows"] == 4                                      # only rows past the stored mark
    loaded = spark.read.parquet(target)
    assert loaded.columns == ["ID", "UPDATED_AT", "_LOADED_AT", "LOAD_DATE"]   # upper-cased, partitioned by load
    assert "PartitionFilters: [isnotnull(LOAD_DATE" in _plan(loaded.where("LOAD_DATE = DATE '2024-01-20'"))
    assert loaded.count() == 10
    st = inc.read_state(spark, state).collect()
    assert len(st) == 1 and st[0].last_extracted == dt.datetime(2024, 1, 20) and st[0].rows_extracted == 4
    summary = inc.run_loads(spark, {"users": src}, state, os.path.join(workdir, "multi"),
                            dt.datetime(2024, 2, 1), [spec, inc.TableSpec("missing", "x", 1)])
    res = {r.table_name: r for r in summary.collect()}
    assert res["users"].status == "empty" and res["missing"].status == "failed"
    # Q10 in the loader: columns without a value, batches without rows
    nulls = src.withColumn("note", F.lit(None).cast("string"))
    again = inc.run_loads(spark, {"users": nulls}, state, os.path.join(workdir, "nulls"), dt.datetime(2024, 2, 1), [spec])
    assert [(r.status, r.rows_loaded) for r in again.collect()] == [("empty", 0)]
    fresh = inc.run_loads(spark, {"users": lambda spec: nulls}, os.path.join(workdir, "state2"),
                          os.path.join(workdir, "nulls"), {"users": dt.datetime(2024, 2, 1)}, [spec]).first()
    assert (fresh.status, fresh.rows_loaded, fresh.all_null_columns) == ("success", 10, "NOTE")


def test_jdbc_reads_are_partitioned():
    spec = inc.TableSpec("users", "updated_at", 1000)
    assert inc.jdbc_options("jdbc:x", "users", spec, "id", 1, 10_000, 32, {"user": "u"}) == {
        "url": "jdbc:x", "dbtable": "users", "fetchsize": "1000", "partitionColumn": "id", "lowerBound": "1",
        "upperBound": "10000", "numPartitions": "32", "user": "u"}


def test_fetch_predicates_are_complete_disjoint_and_even(spark):
    """A hot day, rows without a mark, marks before and after the histogram, a NULL key."""
    day = dt.datetime(2024, 1, 1)
    marks = [day + dt.timedelta(days=i % 40, hours=i % 24) for i in range(4000)]
    marks += [day + dt.timedelta(days=7, seconds=i) for i in range(3000)] + [None] * 2000
    df = spark.createDataFrame([(None if i == 4001 else i, m) for i, m in enumerate(marks)], "id long, at timestamp_ntz")
    histogram = inc.mark_histogram(df, "at")
    assert sum(n for _, n in histogram) == len(marks)
    wider = df.unionByName(spark.createDataFrame([(-5, dt.datetime(1999, 1, 1)), (-6, dt.datetime(2030, 1, 1))], df.schema))
    for key in ("id", None):
        predicates = inc.fetch_predicates("at", histogram, 10, key)
        hits = wider.select(*[F.expr(f"CAST(coalesce({q}, false) AS INT)").alias(f"p{i}") for i, q in enumerate(predicates)])
        assert hits.where(" + ".join(hits.columns) + " <> 1").count() == 0
        sizes = hits.agg(*[F.sum(c).alias(c) for c in hits.columns]).first()
        if key:
            assert max(sizes) <= 2 * len(marks) / 10 and len(predicates) <= 25
    assert inc.fetch_predicates("at", [], 4) == ["at IS NOT NULL", "at IS NULL"]
    assert inc.fetch_ranges([(None, 5)], 4) == []


def test_jdbc_parts_ask_the_database_past_the_mark(spark):
    source = inc.JdbcParts(spark, "jdbc:x", "app.users", 8, "id")
    spec = inc.TableSpec("users", "updated_at", 1000)
    assert source.histogram_query(spec, None) == (
        "SELECT CAST(updated_at AS DATE) AS mark_day, COUNT(*) AS n_rows FROM app.users GROUP BY CAST(updated_at AS DATE)")
    assert "WHERE updated_at > TIMESTAMP '2024-01-02 03:00:00' OR updated_at IS NULL" in source.histogram_query(
        spec, dt.datetime(2024, 1, 2, 3))


def test_latest_by_key_reads_and_moves_rows_once(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = _plan(inc.latest_by_key(df, ["event_id"], "ts"))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("WindowGroupLimit") and "Partial" in plan          # a hot key is one row a task


def test_row_counts_come_from_footers_and_freshness_from_the_newest_load(spark, workdir):
    from monthwise.plans.quality_suite import newest_load, row_counts
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    df = row_counts(Sources.from_test_tables(spark, SF_SMALL, FIXTURE), FIXTURE)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    txt = df._jdf.queryExecution().executedPlan().treeString()
    assert txt.count("PushedAggregation: [COUNT(*)]") == 3
    raw = os.path.join(workdir, "raw")
    for d in (1, 2, 3):
        inc.append_load(spark.range(4).withColumn("_loaded_at", F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz")),
                        raw, inc.LOAD_DATE)
    loaded = spark.read.parquet(raw)
    newest = newest_load(loaded).agg(F.max("_LOADED_AT").alias("at"), F.count("*").alias("n"))
    assert tuple(newest.first()) == (dt.datetime(2024, 1, 3), 4)
    assert "PartitionFilters: [isnotnull(LOAD_DATE" in _plan(newest_load(loaded))
    assert newest_load(loaded.where("LOAD_DATE IS NULL")).count() == 0
    assert newest_load(spark.range(3)).count() == 3


def test_json_text_parses_once_and_malformed_is_null(spark):
    from monthwise.functions import sql as S
    df = spark.createDataFrame([('{"a":"x","b":1}',), ("{bad",), ('{"a":null}',), ("[1]",), (None,), ("",)], "m string")
    got = [tuple(r) for r in df.selectExpr(S.json_text("m", "a"), S.json_text("m", "b")).collect()]
    assert got == [("x", "1")] + [(None, None)] * 5


def test_unreadable_state_is_not_taken_for_missing(spark, workdir):
    with open(os.path.join(workdir, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        inc.get_watermark(spark, workdir, "users")
    assert inc.table_or_none(spark, os.path.join(workdir, "nothing")) is None


def test_latest_by_key_null_order_and_ties(spark):
    df = spark.createDataFrame([(1, None, "only"), (2, None, "a"), (2, 5, "b"), (3, 7, "x"), (3, 7, "y"), (3, 6, "z"),
                                (None, 1, "n"), (4, 1, "same"), (4, 1, "same")], "k long, at long, v string")
    got = {r.k: r.v for r in inc.latest_by_key(df, ["k"], ["at", "v"]).collect()}
    assert got == {1: "only", 2: "b", 3: "y", None: "n", 4: "same"}
    assert inc.latest_by_key(df, ["k"], "at").count() == 5
    assert "SortAggregate" not in _plan(inc.latest_by_key(df, ["k"], "at"))

def test_events_stream_is_idempotent(spark, workdir):
    from monthwise.streaming.events_stream import run_events_load
    srcdir = os.path.join(workdir, "in")
    os.makedirs(srcdir)
    shutil.copy(f"{SF_SMALL}/events.parquet", os.path.join(srcdir, "events.parquet"))
    sink, ckpt, late = (os.path.join(workdir, x) for x in ("sink", "ckpt", "late"))
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    run_events_load(spark, srcdir, sink, ckpt, late)
    assert spark.read.parquet(sink).count() == n
    run_events_load(spark, srcdir, sink, ckpt, late)              # nothing new: no re-load
    assert spark.read.parquet(sink).count() == n
    shutil.copy(f"{SF_SMALL}/events.parquet", os.path.join(srcdir, "events_copy.parquet"))
    run_events_load(spark, srcdir, sink, ckpt, late, file_glob="events*.parquet")   # a duplicate file arrives
    assert spark.read.parquet(sink).count() == n
    assert spark.read.parquet(sink).select("event_id").distinct().count() == n


def test_events_stream_copies_null_ids_and_late_events(spark, workdir):
    from monthwise.streaming.events_stream import events_stream, read_late, run_events_load
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    srcdir, sink, ckpt, late = (os.path.join(workdir, x) for x in ("in", "sink", "ckpt", "late"))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(srcdir)
        return run_events_load(spark, srcdir, sink, ckpt, late, file_glob="*.parquet")

    def at(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)
    big = 2**53
    assert arrive([(big + 1, at(12), 1, "a", 1.0, "{}"), (big + 3, at(12), 1, "a", 1.0, "{}"),
                   (None, at(12), 1, "a", 1.0, "{}"), (None, at(12), 1, "a", 1.0, "{}"), (None, at(12), 2, "a", 1.0, "{}")]
                  + [(7, at(12), 1, "hot", 1.0, "{}")] * 500) == 0
    ids = sorted(str(r.event_id) for r in spark.read.parquet(sink).collect())
    assert ids == sorted([str(big + 1), str(big + 3), "None", "None", "7"])
    assert arrive([(50, at(13, 30), 1, "b", 1.0, "{}")]) == 0                          # moves the watermark to 12:30
    # a late copy, then the same event on time: loaded; a late event of its own: side table
    dropped = arrive([(60, at(9), 1, "c", 1.0, "{}"), (60, at(13), 1, "c", 1.0, "{}"), (61, at(9, 30), 1, "late", 1.0, "{}"),
                      (62, None, 1, "no time", 1.0, "{}"), (7, at(12), 1, "hot", 1.0, "{}")])
    assert dropped >= 2
    loaded = [r.event_id for r in spark.read.parquet(sink).collect()]
    assert loaded.count(60) == 1 and 61 not in loaded and loaded.count(7) == 1
    assert sorted(r.event_id for r in read_late(spark, late).collect()) == [61, 62]
    arrive([(61, at(9, 30), 1, "late", 1.0, "{}")])                                    # again: not twice
    assert sorted(r.event_id for r in read_late(spark, late).collect()) == [61, 62]
    plan = events_stream(spark, srcdir, "*.parquet")._jdf.queryExecution().analyzed().toString()
    assert "InPandas" not in plan and "Python" not in plan


def test_build_all_writes_tables_and_gate_catches_null_segment(spark, workdir):
    from monthwise.operators.quality import GateFailed
    from monthwise.plans.build import build_all, schema_name
    assert schema_name("marts", "prod", "dev_me") == "marts"
    assert schema_name("marts", "dev", "dev_me") == "dev_me_marts"
    assert schema_name(None, "dev", "dev_me") == "dev_me"
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    with pytest.raises(GateFailed, match="account_segment not_null"):
        build_all(spark, src, FIXTURE, root=workdir)
    out = build_all(spark, src, FIXTURE, root=workdir, run_gate=False)
    assert out["fct_mrr"].count() > 0 and out["rpt_monthly_revenue"].count() > 0
    # two builds, one current version: any session reads the last one, months are pruned
    from monthwise.plans.build import read_current
    now = read_current(spark, workdir, "analytics_marts", "fct_mrr")
    assert now.count() == out["fct_mrr"].count() == out["fct_mrr"].select("mrr_id").distinct().count()
    assert "PartitionFilters: [isnotnull(month_start" in _plan(now.where("month_start = DATE '2001-01-01'"))
    assert read_current(spark, workdir, "analytics_quality", "dq_summary").count() == len(quality_suite.MART_CHECKS)


def test_sources_from_paths_reads_contract_tables(spark, workdir):
    from monthwise.plans.reports import monthly_revenue
    test_src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    for system, table in [("stripe", "subscriptions"), ("salesforce", "account"), ("app_db", "users")]:
        test_src(system, table).write.parquet(os.path.join(workdir, system, table))
    prod_src = Sources.from_paths(spark, workdir)
    a = monthly_revenue(prod_src, FIXTURE)
    b = monthly_revenue(test_src, FIXTURE)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_command_line_query_and_list(spark, workdir, capsys):
    from monthwise.__main__ import main
    assert main(["list"]) == 0
    assert "monthly_revenue" in capsys.readouterr().out.split()
    out = os.path.join(workdir, "rpt")
    assert main(["query", "monthly_revenue", "--sf-dir", SF_SMALL, "--out", out]) == 0
    assert spark.read.parquet(out).count() > 0
    # the daily build over contract-shaped raw tables in a folder
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    raw = os.path.join(workdir, "raw")
    from monthwise.sources.schemas import RAW
    for system, table in RAW:
        src(system, table).write.parquet(os.path.join(raw, system, table))
    wh = os.path.join(workdir, "wh")
    assert main(["build", "--raw-root", raw, "--out", wh, "--as-of", "2002-01-01T00:00:00",
                 "--spine-start", "1995-01-01", "--clock", "app_db.events=2024-02-01T00:00:00", "--no-gate"]) == 0
    assert "fct_mrr.mrr_id unique: 0 (pass)" in capsys.readouterr().out
    from monthwise.plans.build import read_current
    assert read_current(spark, wh, "analytics_marts", "fct_mrr").count() > 0
    with pytest.raises(SystemExit):                      # dates have no default
        main(["build", "--raw-root", raw, "--out", wh])


def test_seed_csv_load_with_explicit_schema(spark, workdir):
    from monthwise.sources.seeds_csv import load_seed_csv
    path = os.path.join(workdir, "nation_csv")
    spark.read.parquet(f"{SF_SMALL}/nation.parquet").write.option("header", True).csv(path)
    df = load_seed_csv(spark, path, "n_nationkey int, n_name string, n_regionkey int")
    assert df.count() == 25 and dict(df.dtypes)["n_nationkey"] == "int"


def test_run_daily_probes_then_builds_then_gates(spark, workdir):
    from monthwise.operators.quality import GateFailed
    from monthwise.plans.build import run_daily
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    calls = []

    def load():
        calls.append("load")
        return spark.createDataFrame([("users", "success", 1, None)],
                                     "table_name string, status string, rows_loaded bigint, error string")
    with pytest.raises(GateFailed), pytest.warns(UserWarning, match="stale sources: app_db.events, app_db.users"):
        run_daily(spark, src, FIXTURE, root=workdir, load=load)   # NULL segments fail the report's not_null test
    assert calls == ["load"]


def test_daily_probe_is_taken_before_the_load_and_errors_count(spark, workdir, monkeypatch):
    from monthwise.plans import build
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    monkeypatch.setattr(build, "build_all", lambda *a, **k: {})

    def load():
        src.register("app_db", "users", lambda: src("app_db", "events").selectExpr("_loaded_at"))   # as if loaded now
    with pytest.raises(build.SourceStale, match="salesforce.account|stripe|app_db"), pytest.warns(UserWarning):
        build.run_daily(spark, src, FIXTURE, root=workdir, load=load)
    probe = build.read_current(spark, workdir, "quality", "stale_sources")
    assert probe.where("table_name = 'app_db.users'").first().is_stale
    with pytest.warns(UserWarning):
        out = build.run_daily(spark, src, FIXTURE, root=workdir, fail_on_stale=False)
    assert out["source_freshness"].where("status = 'error'").count() > 0


def test_series_keeps_every_order(spark):
    """Customers that start after as_of, and orders after it, are in the series."""
    from monthwise.plans.series import zero_filled_monthly_totals
    orders = spark.createDataFrame([(1, dt.datetime(2003, 5, 2), 10.0), (1, dt.datetime(2001, 11, 2), 5.0),
                                    (2, dt.datetime(2004, 1, 9), 7.0), (3, dt.datetime(2001, 12, 1), 1.0)],
                                   "o_custkey long, o_orderdate timestamp_ntz, o_totalprice double")
    got = zero_filled_monthly_totals(orders, FIXTURE).groupBy("customer_key").agg(
        F.count("*").alias("months"), F.sum("order_cents").alias("cents")).collect()
    assert {r.customer_key: (r.months, r.cents) for r in got} == {1: (19, 1500), 2: (1, 700), 3: (2, 100)}


def test_clocks_and_a_late_as_of(spark):
    from monthwise.plans.quality_suite import stale_sources
    p = FIXTURE.with_(as_of=dt.datetime(2026, 1, 10), clocks=())
    src = Sources.from_test_tables(spark, SF_SMALL, p)
    rows = {r.table_name: r for r in stale_sources(src, p).collect()}
    assert rows["app_db.events"].hours_old > 24 * 365 and rows["app_db.events"].is_stale
    assert p.clock("app_db", "events") == p.as_of and FIXTURE.clock("app_db", "events").year == 2024


def test_seed_fractions_of_large_ids(spark):
    from monthwise.sources import seedgen
    ids = spark.range(4_000_000_000, 4_000_000_050).withColumnRenamed("id", "i")
    rows = seedgen.seed_users(ids, FIXTURE.as_of).collect()
    assert len(rows) == 50 and len({r.created_at for r in rows}) > 40
    assert all(FIXTURE.as_of - dt.timedelta(days=730) <= r.created_at <= FIXTURE.as_of for r in rows)
    users = {r.user_id for r in seedgen.seed_events(ids, FIXTURE.as_of, F.lit(1000)).collect()}
    assert len(users) == 50


def test_shared_dir_never_falls_back_to_local_folder_on_a_cluster():
    from monthwise.session import shared_dir

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class NoContext:
        def __init__(self, values):
            self.conf = Conf(values)

        @property
        def sparkContext(self):
            raise RuntimeError("no context on this client")

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(NoContext({"spark.master": "yarn"}))
    assert shared_dir(NoContext({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///ckpt"})) == "hdfs:///ckpt"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_has_no_nested_loop_or_python(spark):
    from monthwise.plans.mrr import fct_mrr
    df = fct_mrr(Sources.from_test_tables(spark, SF_SMALL, FIXTURE), FIXTURE)
    plan = _plan(df)
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
    # unique ids: at run time no window and one expansion are left, which is not shuffled
    df.collect()
    ran = df._jdf.queryExecution().executedPlan().toString()
    final = ran.split("Initial Plan")[0]
    assert "Window" not in final and final.count("Generate") == 1


def test_gate_has_no_expand(spark):
    from monthwise.operators.quality import run_checks
    from monthwise.plans import quality_suite as qs
    src = Sources.from_test_tables(spark, SF_SMALL, FIXTURE)
    tables = qs._tables(src, FIXTURE, qs.MART_CHECKS)
    plan = _plan(run_checks(tables, qs.MART_CHECKS, FIXTURE.as_of))
    assert "Expand" not in plan and "Generate" not in plan.replace("Generate stack", "")


def test_filters_and_columns_reach_the_scan(spark):
    from monthwise.plans.staging import stg_subscriptions
    df = stg_subscriptions(Sources.from_test_tables(spark, SF_SMALL, FIXTURE), FIXTURE).select("subscription_id")
    txt = df._jdf.queryExecution().executedPlan().treeString()
    assert "o_totalprice" not in txt                              # pruned
    inc_df = inc.incremental_batch(spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumnRenamed("ts", "t"),
                                   "t", dt.datetime(2024, 1, 15), dt.datetime(2024, 2, 1))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in inc_df._jdf.queryExecution().executedPlan().toString()
