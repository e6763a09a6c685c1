"""SCD type-2 history (timestamp strategy) from a change log.

Every source row is a version of its key, ordered by (updated_at, tie-break);
``valid_to`` is the next version's ``updated_at`` (NULL for the current one).

The ordered work is split so a hot key never lands in one task: versions are cut into
ranges of (key, time), however many a key needs, and a range learns from one summary row
of its neighbours which version follows its last and how many of its first key came
before (:mod:`monthwise.operators.ordered`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions import sql as S
from monthwise.operators.ordered import with_neighbours
from monthwise.sources.incremental import table_or_none


def scd2_history(df: DataFrame, key: str, updated_at: str, tiebreak: str, attrs: list[str],
                 bucket: str = "day") -> DataFrame:
    """All versions of every key.  Rows without a key or a time are left out.  ``bucket`` has no
    effect any more (ranges took the place of day buckets)."""
    rows = df.where(f"{key} IS NOT NULL AND {updated_at} IS NOT NULL").select(key, updated_at, tiebreak, *attrs)
    rows = with_neighbours(rows, [key], [updated_at, tiebreak], {updated_at: "__valid_to"}, index="__at")
    return rows.selectExpr(
        f"{S.surrogate_key(key, tiebreak)} AS scd_id",
        key, tiebreak, *attrs,
        f"{updated_at} AS valid_from",
        "__valid_to AS valid_to",
        "CAST(__at + 1 AS BIGINT) AS version_number",
        "__valid_to IS NULL AS is_current",
    )


def scd2_apply(current: DataFrame, changes: DataFrame, key: str, updated_at: str, tiebreak: str,
               attrs: list[str], bucket: str = "day") -> tuple[DataFrame, DataFrame]:
    """What a batch of source rows does to the current versions (one row per key, columns
    of :func:`scd2_history`): (closed, opened).

    A change counts when it is newer, in (updated_at, tie-break) order, than its key's
    current version (the timestamp strategy; older rows are ignored).  ``opened`` are the
    versions it makes, numbered on from the current one; ``closed`` are the current
    versions they end.  The join is on the key with one current row per key, so a hot
    key in the changes only lengthens the (skew-split) probe side."""
    cur = current.selectExpr(f"{key} AS __k", "valid_from AS __cur_from", f"{tiebreak} AS __cur_tb",
                             "version_number AS __off")
    new = changes.select(key, updated_at, tiebreak, *attrs).join(cur, F.expr(f"{key} = __k"), "left").where(
        f"__cur_from IS NULL OR {updated_at} > __cur_from "
        f"OR ({updated_at} = __cur_from AND {tiebreak} > __cur_tb)")
    opened = scd2_history(new, key, updated_at, tiebreak, [*attrs, "__off"], bucket).withColumn(
        "version_number", F.expr("version_number + coalesce(__off, 0)")).drop("__off")
    first = new.groupBy(key).agg(F.expr(f"min({updated_at})").alias("__first"))
    closed = current.join(first, key).withColumns({"valid_to": F.col("__first"), "is_current": F.lit(False)}).select(
        *current.columns)
    return closed, opened.select(*current.columns)


STATE_BUCKETS = 64
MANIFEST = "run int, state_bucket int, state_run int"


class SnapshotTable:
    """A stored SCD2 snapshot: closed versions are appended and never rewritten; the current
    versions, one row per key, are dealt to ``state_buckets`` by the key's hash, and a run reads
    and rewrites only the buckets that its changes touch.

    Below ``root``: ``history/run=N`` (versions closed by run N), ``current/run=N/__bucket=B`` (the
    state of bucket B as run N left it) and the manifest, which says for every bucket
    whose run's state counts.  The manifest is one small table, rewritten by each run into
    the older of two slots once all else is written: the other slot still holds the run
    before, so a run that was lost half-way is simply run again, and the log never grows."""

    def __init__(self, spark: SparkSession, root: str, key: str, updated_at: str, tiebreak: str, attrs: list[str],
                 bucket: str = "day", state_buckets: int = STATE_BUCKETS):
        self.spark, self.root, self.state_buckets = spark, root.rstrip("/"), state_buckets
        self.args = (key, updated_at, tiebreak, attrs, bucket)

    def _part(self, kind: str, run: int) -> str:
        return f"{self.root}/{kind}/run={run}"

    def _manifest(self) -> tuple[int, dict[int, int]]:
        """(last finished run, bucket -> run that wrote its state); at most ``state_buckets`` rows a slot."""
        found = (0, {})
        for slot in (0, 1):
            rows = table_or_none(self.spark, f"{self.root}/manifest/slot={slot}", MANIFEST)
            rows = rows.collect() if rows is not None else []
            if rows and rows[0]["run"] > found[0]:
                found = (rows[0]["run"], {r["state_bucket"]: r["state_run"] for r in rows if r["state_bucket"] >= 0})
        return found

    def runs(self) -> int:
        """Number of finished runs."""
        return self._manifest()[0]

    def _state(self, of: dict[int, int]) -> DataFrame | None:
        paths = [f"{self._part('current', run)}/__bucket={b}" for b, run in sorted(of.items())]
        return self.spark.read.parquet(*paths) if paths else None

    def merge(self, changes: DataFrame) -> None:
        """The first run takes the history of ``changes``; later runs apply them."""
        key, updated_at = self.args[0], self.args[1]
        n, state = self._manifest()
        run = n + 1
        bucket = F.pmod(F.xxhash64(key), F.lit(self.state_buckets)).cast("int")
        touched = {r[0] for r in changes.where(f"{key} IS NOT NULL AND {updated_at} IS NOT NULL").select(bucket).distinct().collect()}
        kept = self._state({b: r for b, r in state.items() if b in touched})
        if kept is None:
            closed, versions = None, scd2_history(changes, *self.args)
        else:
            closed, versions = scd2_apply(kept, changes, *self.args)
        # the new versions are written once, by state, and both parts read them there
        made = f"{self.root}/versions/run={run}"
        versions.write.mode("overwrite").partitionBy("is_current").parquet(made)
        # the schema is given: a run may make no version at all
        made_rows = self.spark.read.schema(versions.schema).parquet(made).select(*versions.columns)
        history = made_rows.where("NOT is_current")
        if closed is not None:
            history = history.unionByName(closed)
        history.write.mode("overwrite").parquet(self._part("history", run))
        opened = made_rows.where("is_current")
        if kept is not None:
            opened = opened.unionByName(kept.join(opened.select(key), key, "left_anti").select(*opened.columns))
        # a bucket is hashed by key, so no key is hot here: one row each
        (opened.withColumn("__bucket", bucket).repartition("__bucket").write.mode("overwrite")
         .partitionBy("__bucket").parquet(self._part("current", run)))
        state = {**state, **{b: run for b in touched}}
        rows = [(run, -1, 0), *[(run, b, r) for b, r in sorted(state.items())]]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/slot={run % 2}")

    def read(self) -> DataFrame:
        n, state = self._manifest()
        if n == 0:
            raise FileNotFoundError(f"no snapshot below {self.root}")
        closed = self.spark.read.parquet(*[self._part("history", i + 1) for i in range(n)])
        current = self._state(state)
        return closed if current is None else current.unionByName(closed.select(*current.columns))
