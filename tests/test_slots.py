"""Control tables that do not grow: two slots a name, the older one overwritten."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from monthwise.plans import build
from monthwise.sources import incremental as inc


def at(day):
    return dt.datetime(2024, 1, day)


def parquet_files(root):
    return [os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")]


def test_marks_of_many_runs_stay_two_files_a_table(spark, workdir):
    path = os.path.join(workdir, "state")
    inc.ensure_state_table(spark, path)
    for day in range(1, 8):
        for table in ("users", "events/new=x"):
            inc.set_watermark(spark, path, table, at(day), day, at(day))
            assert inc.get_watermark(spark, path, table) == at(day)
    assert len(parquet_files(path)) <= 2 * 2 + 1
    state = {r.table_name: r.rows_extracted for r in inc.read_state(spark, path).collect()}
    assert state == {"users": 7, "events/new=x": 7}


def test_a_lost_writer_leaves_the_row_before(spark, workdir, monkeypatch):
    path = os.path.join(workdir, "state")
    inc.ensure_state_table(spark, path)
    for day in (1, 2):
        inc.set_watermark(spark, path, "users", at(day), day, at(day))
    writer = type(spark.range(1).write)

    def lost(self, target, *a, **kw):
        for f in parquet_files(target):                   # the slot was emptied, its new file never came
            os.remove(f)
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(writer, "parquet", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            inc.set_watermark(spark, path, "users", at(3), 3, at(3))
    assert inc.get_watermark(spark, path, "users") == at(2)
    inc.set_watermark(spark, path, "users", at(3), 3, at(3))
    assert inc.get_watermark(spark, path, "users") == at(3)


def test_a_log_of_appended_files_is_still_read(spark, workdir):
    """State that an earlier version appended in the folder itself."""
    path = os.path.join(workdir, "state")
    for day in (1, 2):
        inc.state_update(spark, "users", at(day), day, at(day)).write.mode("append").parquet(path)
    assert inc.get_watermark(spark, path, "users") == at(2)
    inc.set_watermark(spark, path, "users", at(5), 5, at(5))
    assert inc.get_watermark(spark, path, "users") == at(5)


def test_current_versions_of_many_builds(spark, workdir):
    df = spark.range(5).withColumn("v", F.lit("a"))
    for run in range(4):
        for name in ("one", "two"):
            out = build.materialize_table(spark, df.withColumn("run", F.lit(run)), workdir, "marts", name, "prod", "x", f"r{run}")
            assert {r.run for r in out.collect()} == {run}
    assert len(parquet_files(os.path.join(workdir, "_current"))) == 4
    for name in ("one", "two"):
        assert {r.run for r in build.read_current(spark, workdir, "marts", name).collect()} == {3}
    with pytest.raises(KeyError):
        build.read_current(spark, workdir, "marts", "three")
