"""Neighbours in a sorted order, without one task per key.

``lead`` and ``row_number`` windows gather all rows of a key in one task.  Here rows are
range-partitioned by (key, order): a hot key is cut into as many ranges as its rows need,
each range is sorted on its own, and what a range must know of its neighbours - the first
row of the next one, the rows of its first key that lie before it - is one summary row
per range.  Ranges are as many as shuffle partitions, so the only unpartitioned
window runs over that many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthwise.session import new_work_path

PART, LAST = "__part", "__last_row"


def ranged(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` cut into ranges of ``order`` and written, with the range's number: the bounds
    come from a sample, so every later use must read the same cut."""
    path = new_work_path(df.sparkSession, "ranged")
    out = df.repartitionByRange(*[F.col(c) for c in order]).withColumn(PART, F.spark_partition_id())
    out.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def with_neighbours(df: DataFrame, key: list[str], order: list[str], following: dict[str, str],
                    index: str | None = None) -> DataFrame:
    """``df`` with, per row, the values of the next row of the same key in the order of
    ``order`` (``following``: source column -> new column; NULL in a key's last row), and
    optionally the row's place within its key, from 0.

    ``key`` may be empty (one total order).  ``order`` should make the order total: rows
    equal in all of it come in any order.  Ascending, NULLs first."""
    every = [*key, *[c for c in order if c not in key]]
    rows = ranged(df, every)
    local = Window.partitionBy(PART).orderBy(*every)
    first = F.struct(*[F.col(c) for c in every], *[F.col(c) for c in following if c not in every])
    mine = F.struct(*[F.col(c) for c in key]) if key else F.struct(F.lit(0).alias("all"))
    # A row per range: its first row, its first and last key; and, for the index, how many
    # rows of its last key it holds.
    parts = rows.groupBy(PART).agg(F.min(first).alias("first"), F.min(mine).alias("low"), F.max(mine).alias("high"))
    by_part = Window.orderBy(PART)
    edges = parts.select(PART, F.lead("first").over(by_part).alias("__next"))
    if index:
        highs = parts.select(F.col(PART).alias("__p"), F.col("high").alias("__high"))
        held = (rows.join(F.broadcast(highs), (F.col(PART) == F.col("__p")) & mine.eqNullSafe(F.col("__high")))
                .groupBy(PART).agg(F.count(F.lit(1)).alias("n_high")))
        parts = parts.join(held, PART).withColumn(
            "held", F.sum("n_high").over(Window.partitionBy("high").orderBy(PART)))    # rows of ``high`` up to here
        before = F.when(F.lag("high").over(by_part).eqNullSafe(F.col("low")), F.lag("held").over(by_part)).otherwise(0)
        edges = parts.select(PART, F.lead("first").over(by_part).alias("__next"), F.col("low").alias("__low"),
                             before.cast("long").alias("__before"))
    out = rows.withColumns({
        "__lead": F.lead(first).over(local),
        **({"__at": F.row_number().over(Window.partitionBy(PART, *key).orderBy(*every)) - 1} if index else {})})
    # ``edges`` has one row per range: no more rows than shuffle partitions.
    out = out.join(F.broadcast(edges), PART)
    coming = F.coalesce("__lead", "__next")
    same = F.lit(True)
    for c in key:
        same = same & coming[c].eqNullSafe(F.col(c))
    made = {new: F.when(same, coming[old]) for old, new in following.items()}
    if index:
        made[index] = (F.col("__at") + F.when(F.col("__low").eqNullSafe(mine), F.col("__before")).otherwise(0)).cast("long")
    return out.withColumns(made).select(*df.columns, *made)
