"""Ordered work without one task per key, and the stored snapshot's buckets."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from monthwise.operators.ordered import PART, ranged, with_neighbours
from monthwise.operators.scd2 import SnapshotTable, scd2_history

DAY = dt.datetime(2020, 1, 1)


def test_neighbours_against_a_sort(spark):
    rnd = random.Random(5)
    rows = [(None if rnd.random() < 0.03 else "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(40)}", rnd.randrange(300), i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, i long")
    got = {r.i: (r.nt, r.ni, r.place) for r in with_neighbours(df, ["k"], ["t", "i"], {"t": "nt", "i": "ni"}, "place").collect()}
    order, want, seen = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])), {}, {}
    for a, b in zip(order, [*order[1:], ("end", 0, 0)]):
        want[a[2]] = (b[1] if a[0] == b[0] else None, b[2] if a[0] == b[0] else None, seen.get(a[0], 0))
        seen[a[0]] = seen.get(a[0], 0) + 1
    assert got == want
    whole = {r.i: r.ni for r in with_neighbours(df, [], ["k", "t", "i"], {"i": "ni"}).collect()}
    assert whole == {a[2]: b[2] for a, b in zip(order, [*order[1:], (None, None, None)])}
    assert with_neighbours(df.where("false"), ["k"], ["t"], {"t": "nt"}, "place").count() == 0


def test_one_key_of_a_million_rows_is_many_tasks(spark):
    """No range holds more than a small part of the hot key, and its versions are one run of numbers."""
    n = 1_000_000
    df = spark.range(n).selectExpr("CAST(1 AS BIGINT) AS k", "TIMESTAMP_NTZ '2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 1000) AS t",
                                   "id AS tie", "'x' AS v")
    sizes = [r["count"] for r in ranged(df, ["k", "t", "tie"]).groupBy(PART).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < n / 3                      # all of it within one day (small ranges are merged)
    out = scd2_history(df, "k", "t", "tie", ["v"])
    r = out.agg(F.count("*"), F.min("version_number"), F.max("version_number"), F.countDistinct("version_number"),
                F.count_if("is_current"), F.count_if(F.col("valid_to") < F.col("valid_from"))).first()
    assert tuple(r) == (n, 1, n, n, 1, 0)


ARGS = ("key", "upd", "ok", ["attr"])
SCHEMA = "key long, upd timestamp_ntz, ok long, attr string"


def change(key, day, ok):
    return (key, DAY + dt.timedelta(days=day), ok, f"v{ok}")


def files(root, kind="current"):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(os.path.join(root, kind)) for f in names if f.endswith(".parquet")}


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


def test_untouched_buckets_keep_their_files(spark, workdir):
    root = os.path.join(workdir, "snap")
    rows = [change(k, 0, k) for k in range(300)]
    table = SnapshotTable(spark, root, *ARGS, state_buckets=16)
    table.merge(spark.createDataFrame(rows, SCHEMA))
    before = files(root)
    assert len(before) == 16
    later = [change(7, 3, 1000), change(7, 2, 1001), change(9999, 3, 1002)]
    table.merge(spark.createDataFrame(later, SCHEMA))
    after = files(root)
    assert {f: after[f] for f in before} == before                     # nothing rewritten in place
    assert 1 <= len(after) - len(before) <= 2                          # two keys, two buckets at most
    assert same(table.read(), scd2_history(spark.createDataFrame(rows + later, SCHEMA), *ARGS))


def test_only_touched_buckets_are_read(spark, workdir):
    root = os.path.join(workdir, "snap")
    table = SnapshotTable(spark, root, *ARGS, state_buckets=16)
    table.merge(spark.createDataFrame([change(k, 0, k) for k in range(300)], SCHEMA))
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7).cast("long")), F.lit(16))).first()[0]
    for f in files(root):
        if f"__bucket={bucket}/" not in f:
            open(f, "wb").close()                                      # unreadable if touched
    table.merge(spark.createDataFrame([change(7, 3, 1000)], SCHEMA))
    assert table.runs() == 2


@pytest.mark.parametrize("step", ["history", "current", "manifest"])
def test_a_lost_run_is_run_again(spark, workdir, monkeypatch, step):
    root = os.path.join(workdir, "snap")
    rows, later = [change(k, 0, k) for k in range(50)], [change(k, 2, 100 + k) for k in range(0, 50, 3)]
    table = SnapshotTable(spark, root, *ARGS, state_buckets=4)
    table.merge(spark.createDataFrame(rows, SCHEMA))
    changes = spark.createDataFrame(later, SCHEMA)
    writer = type(changes.write)
    real = writer.parquet

    def lost(self, path, *a, **kw):
        if f"/{step}/" in path:
            raise RuntimeError("driver lost")
        return real(self, path, *a, **kw)
    with monkeypatch.context() as m:
        m.setattr(writer, "parquet", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            table.merge(changes)
    assert table.runs() == 1 and same(table.read(), scd2_history(spark.createDataFrame(rows, SCHEMA), *ARGS))
    table.merge(changes)
    assert table.runs() == 2 and same(table.read(), scd2_history(spark.createDataFrame(rows + later, SCHEMA), *ARGS))


def test_the_manifest_does_not_grow(spark, workdir):
    root = os.path.join(workdir, "snap")
    table = SnapshotTable(spark, root, *ARGS, state_buckets=4)
    for run in range(5):
        table.merge(spark.createDataFrame([change(run % 2, run, run)], SCHEMA))
        assert table.runs() == run + 1 and len(files(root, "manifest")) <= 2
    table.merge(spark.createDataFrame([], SCHEMA))                     # a run without changes
    assert table.runs() == 6 and table.read().count() == 5
