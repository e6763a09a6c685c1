"""Streams that survive a lost driver: late events and sessions."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from monthwise.streaming import events_stream as es

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def at(hour, minute=0, second=0, micro=0):
    return dt.datetime(2024, 1, 1, hour, minute, second, micro)


class Feed:
    """A folder of event files and the tables a load of it fills."""

    def __init__(self, spark, workdir):
        self.spark = spark
        self.source, self.sink, self.ckpt, self.late = (os.path.join(workdir, x) for x in ("in", "sink", "ckpt", "late"))

    def arrive(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def load(self, **kw):
        return es.run_events_load(self.spark, self.source, self.sink, self.ckpt, self.late, file_glob="*.parquet", **kw)

    def loaded(self):
        return sorted(r.event_id for r in self.spark.read.parquet(self.sink).collect())

    def late_ids(self):
        late = es.read_late(self.spark, self.late)
        return [] if late is None else sorted(r.event_id for r in late.collect())


def event(i, t):
    return (i, t, 1, "view", 1.0, "{}")


@pytest.fixture()
def feed(spark, workdir):
    f = Feed(spark, workdir)
    f.arrive([event(1, at(12)), event(2, at(12, 5))])
    f.load()
    f.arrive([event(3, at(15))])
    f.load()
    return f


@pytest.mark.parametrize("step", ["write_late", "mark"])
def test_driver_lost_within_a_batch(feed, monkeypatch, step):
    """Lost after the sink's write, before the side table's (or the mark's): the rerun brings both."""
    feed.arrive([event(4, at(9)), event(5, None), event(1, at(12)), event(6, at(15, 10)), event(4, at(9))])

    def lost(*a, **kw):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        if step == "write_late":
            m.setattr(es.EventTables, "write_late", lost)
        else:
            real = es.EventTables.write_late
            m.setattr(es.EventTables, "write_late", lambda self, *a: (real(self, *a), lost()))
        with pytest.raises(Exception, match="driver lost"):
            feed.load()
    assert 6 in feed.loaded()                                    # the sink had been written
    feed.load()                                                  # nothing new arrived: the batch is replayed
    assert feed.loaded() == [1, 2, 3, 6] and feed.late_ids() == [4, 5]
    feed.load()
    assert feed.loaded() == [1, 2, 3, 6] and feed.late_ids() == [4, 5]


def test_late_events_once_over_many_batches(feed):
    for _ in range(2):
        feed.arrive([event(4, at(9)), event(7, at(10)), event(2, at(12, 5))])
        feed.load()
    feed.arrive([event(8, None)])
    feed.load()
    feed.arrive([event(8, None), event(9, at(8))])
    feed.load()
    assert feed.loaded() == [1, 2, 3] and feed.late_ids() == [4, 7, 8, 9]


def test_an_event_is_in_one_table_only(spark, workdir):
    """Whatever the order of arrival, in time and late together are all events, each once."""
    feed, seen = Feed(spark, workdir), set()
    for k, hours in enumerate([(10, 3, 11), (14, 10, 2), (13, 14, 9, 1), (5, 18, 12)]):
        feed.arrive([event(100 * k + i, at(h)) for i, h in enumerate(hours)] + [event(7, at(hours[0])), event(8, None)])
        seen |= {100 * k + i for i in range(len(hours))} | {7, 8}
        feed.load()
        assert sorted(feed.loaded() + feed.late_ids()) == sorted(seen)


def test_a_run_reads_only_its_own_files(feed, spark):
    """Neither late rows nor rows without a time make a run read earlier files again."""
    old = [os.path.join(feed.source, f) for f in os.listdir(feed.source) if f.endswith(".parquet")]
    for f in old:
        open(f, "wb").close()                                    # unreadable if touched
    feed.arrive([event(4, at(9)), event(5, None)])
    assert feed.load() == 1
    assert feed.late_ids() == [4, 5]


# ------------------------------------------------------------------- sessions
GAP = 1800


class Sessions:
    def __init__(self, spark, workdir):
        self.spark = spark
        self.source, self.clocks, self.sink, self.ckpt = (os.path.join(workdir, x) for x in ("in", "clocks", "sink", "ckpt"))
        self.rows = []

    def arrive(self, *rows):
        made = [(i, t, user, "view", 1.0, "{}") for i, (user, t) in enumerate(rows)]
        self.rows += made
        self.spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(self.source)

    def load(self, now):
        from monthwise.streaming.sessions_stream import run_sessions_load
        run_sessions_load(self.spark, self.source, self.clocks, self.sink, self.ckpt, now, GAP, file_glob="*.parquet")

    def closed(self):
        from monthwise.streaming.sessions_stream import read_sessions
        return sorted(map(tuple, read_sessions(self.spark, self.sink).collect()))

    def batch(self):
        from monthwise.operators.sessions import sessionize
        df = self.spark.createDataFrame(self.rows, SCHEMA)
        out = sessionize(df, "user_id", "ts", GAP).select("user_id", "session_index", "started_at", "ended_at", "events_count")
        return sorted(map(tuple, out.collect()))


def test_sessions_grow_over_runs(spark, workdir):
    s = Sessions(spark, workdir)
    s.arrive((1, at(10)), (1, at(10, 20)), (2, at(10)), (None, at(10)), (3, None))
    s.load(at(10, 25))
    assert s.closed() == []                                       # all open
    s.arrive((1, at(10, 50)), (1, at(11, 20, 0, 1)))              # exactly the gap: the same session; a microsecond more: another
    s.load(at(11, 25))
    assert s.closed() == []                                       # the clock less an hour is 10:25, a gap after 10:00 is 10:30
    s.load(at(12, 30))                                            # the clock alone closes what ended before 11:00
    assert s.closed() == [(1, 0, at(10), at(10, 50), 3), (2, 0, at(10), at(10), 1)]
    s.arrive((2, at(12, 10)), (2, at(12, 20)))
    s.load(at(20))
    assert s.closed() == s.batch() and len(s.closed()) == 4
    s.load(at(20))                                                # nothing new
    assert s.closed() == s.batch()


def test_sessions_of_a_hot_user_equal_the_batch(spark, workdir):
    s = Sessions(spark, workdir)
    for hour in (8, 9, 10):
        s.arrive(*[(7, at(hour, m, x)) for m in range(0, 60, 7) for x in range(0, 50, 5)], *[(u, at(hour, u % 60)) for u in range(20, 80)])
        s.load(at(hour + 1))
    s.load(at(23))
    assert s.closed() == s.batch()


def test_sessions_merge_before_the_shuffle(spark, workdir):
    """Part sessions are merged in each task."""
    from monthwise.streaming import sessions_stream as ss
    s = Sessions(spark, workdir)
    s.arrive((1, at(10)))
    s.load(at(11))
    spark.conf.set(ss.LOCAL_MERGE, "true")
    try:
        q = (ss.sessions_stream(spark, s.source, s.clocks, GAP, "*.parquet").writeStream.format("noop")
             .option("checkpointLocation", os.path.join(workdir, "other")).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
        plan = q._jsq.explainInternal(True)
    finally:
        spark.conf.unset(ss.LOCAL_MERGE)
    lines = plan[plan.index("== Physical Plan =="):].splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    merges = [i for i, line in enumerate(lines) if "MergingSessions" in line]
    assert any(i < exchange for i in merges) and any(i > exchange for i in merges)


def test_stream_sessions_query(spark):
    from conftest import SF_SMALL

    import __spark_entry__ as entry
    q = entry.queries()
    assert sorted(map(tuple, q["stream_sessions"](spark, SF_SMALL).collect())) == sorted(
        map(tuple, q["sessions"](spark, SF_SMALL).select("user_id", "session_index", "started_at", "ended_at", "events_count").collect()))
