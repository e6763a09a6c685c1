"""Exact top-k by inner product: a Voronoi kNN join.

Largest inner product becomes nearest neighbour by one more coordinate: with M the
greatest vector length, a vector x gets sqrt(M^2 - |x|^2) and a query gets 0, and then
|q - x|^2 = |q|^2 + M^2 - 2 q.x.  In that space

1. pivots (a bounded sample by id hash) cut queries and data into Voronoi cells;
2. a summary per data cell - its k + 1 smallest distances to the pivot - and the
   radius of each query cell give, by the triangle inequality, an upper bound on the
   k-th neighbour's distance that holds for every query of the cell;
3. a vector is sent to a group of query cells only if its distance to its own pivot
   lies in the interval in which it could still beat that bound;
4. groups are solved locally, in blocks of ``query_block`` queries by ``data_block``
   vectors, and the blocks' best are merged with a rank window.

The bounds only decide what is copied; scores are exact integers.  Blocks split hot
cells on either side.

Components become floor(scale * x); vectors that are NULL or hold NULL or non-finite
components take no part, nor do rows without an id.  Rows are numbered once, in a written
table: every row counts, rows that share a vec_id too, and a query leaves out its own row
only.  Vectors of another length than a query's are not compared with it.  Columns besides
the id and the vector are not read, so none can clash.  Ties go to the smaller vec_id; queries with fewer than k partners return
what there is; empty tables give empty results.  Scores must stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthwise.llm.common import written

PIVOTS = 64
QUERY_BLOCK = 1024
DATA_BLOCK = 8192
SLACK = 1e-6        # of a distance, for rounding in the bounds


def quantized(vectors: DataFrame, scale: float, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec array<double> of whole numbers)."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~F.coalesce(bad, F.lit(True)))
        .select(F.col(id_col).cast("long").alias("vec_id"),
                F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("double")).alias("vec"))
        .where(F.size("vec") > 0)
    )


def matrix(arrays: list, dim: int) -> np.ndarray:
    return np.array(arrays, dtype=np.float64).reshape(-1, dim)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (points**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def lifted(x: np.ndarray, longest: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(longest**2 - (x**2).sum(1), 0))[:, None]])


def top_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest, ties to the smaller place, in that order."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        equal = np.flatnonzero(scores == least)[: k - len(above)]
        some = np.sort(np.concatenate([above, equal]))
    else:
        some = np.arange(len(scores))
    return some[np.argsort(-scores[some], kind="stable")]


def reach(query_radius: np.ndarray, pivot_gap: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query cell and data cell the least and greatest distance to the pivot at
    which a vector may be among the k nearest of some query of the cell.  ``near``: the
    k + 1 smallest distances to the pivot per data cell, padded with infinity."""
    low, high = np.empty_like(pivot_gap), np.empty_like(pivot_gap)
    for i, radius in enumerate(query_radius):
        sure = np.sort((radius + pivot_gap[i][:, None] + near).ravel())
        bound = sure[k] if len(sure) > k else np.inf       # k + 1: one of them may be the query itself
        low[i] = pivot_gap[i] - radius - bound
        high[i] = pivot_gap[i] + radius + bound
    pad = SLACK * (1 + np.abs(pivot_gap))
    return low - pad, high + pad


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_col: str = "vec_id",
          vec_col: str = "embedding", n_pivots: int = PIVOTS, query_block: int = QUERY_BLOCK,
          data_block: int = DATA_BLOCK) -> DataFrame:
    """The k greatest inner products of every query row (``is_query``, over ``vec_id``)
    against all other rows: (query_id, rank, vec_id, score)."""
    spark = vectors.sparkSession
    data = written(quantized(vectors, scale, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    out = None
    for (dim,) in data.select(F.size("vec")).distinct().collect():      # the lengths in use: one, as a rule
        part = ranked(data.where(F.size("vec") == dim), dim, is_query, k, n_pivots, query_block, data_block)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return out


def ranked(data: DataFrame, dim: int, is_query: Column, k: int, n_pivots: int, query_block: int,
           data_block: int) -> DataFrame:
    spark = data.sparkSession
    n, longest2 = data.agg(F.count("*"), F.max(F.aggregate("vec", F.lit(0.0), lambda a, c: a + c * c))).first()
    longest = float(np.sqrt(longest2))
    sample = data.orderBy(F.xxhash64("vec_id", "row")).limit(n_pivots).select("vec").collect()
    pivots = lifted(matrix([r[0] for r in sample], dim), longest)
    shared = spark.sparkContext.broadcast(pivots)

    def cells(flat: bool):
        """Nearest pivot and the distance to it; queries lie at height 0."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column(1).to_pylist(), dim)
                points = np.hstack([x, np.zeros((len(x), 1))]) if flat else lifted(x, longest)
                d = distances(points, shared.value)
                cell = d.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(cell.astype(np.int32)),
                     pa.array(d[np.arange(len(d)), cell])], names=["vec_id", "vec", "row", "cell", "far"])
        return run

    schema = "vec_id bigint, vec array<double>, row bigint, cell int, far double"
    placed = written(data.mapInArrow(cells(False), schema), "data-cells")
    queries = written(data.where(is_query).mapInArrow(cells(True), schema), "query-cells")

    # Summaries, one row per cell: queries' count and radius, data's k + 1 smallest distances.
    asked = {r[0]: (r[1], r[2]) for r in queries.groupBy("cell").agg(F.count("*"), F.max("far")).collect()}
    if not asked:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    closest = Window.partitionBy("cell").orderBy("far")
    near = np.full((len(pivots), k + 1), np.inf)
    for cell, far, at in (placed.select("cell", "far", F.row_number().over(closest).alias("at"))
                          .where(F.col("at") <= k + 1).collect()):
        near[cell, at - 1] = far
    query_cells = sorted(asked)
    gap = distances(pivots[query_cells], pivots)
    low, high = reach(np.array([asked[c][1] for c in query_cells]), gap, near, k)

    # Query cells in the order of their pivots along the widest coordinate, packed to groups.
    axis = int(pivots.std(0).argmax())
    groups: list[list[int]] = []
    room = 0
    for i in sorted(range(len(query_cells)), key=lambda i: (pivots[query_cells[i], axis], i)):
        size = asked[query_cells[i]][0]
        if not groups or room < size:
            groups.append([])
            room = query_block
        groups[-1].append(i)
        room -= size
    group_of = {query_cells[i]: g for g, own in enumerate(groups) for i in own}
    splits = [-(-sum(asked[query_cells[i]][0] for i in own) // query_block) for own in groups]
    bounds = spark.sparkContext.broadcast((
        np.array([low[own].min(0) for own in groups]), np.array([high[own].max(0) for own in groups])))
    n_blocks = -(-n // data_block)

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once for every group that may need it."""
        lows, highs = bounds.value
        for batch in batches:
            cell = batch.column(3).to_numpy()
            far = batch.column(4).to_numpy()
            for g in range(len(lows)):
                need = pa.array((far >= lows[g][cell]) & (far <= highs[g][cell]))
                some = batch.filter(need)
                if some.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(some.num_rows, g, np.int32)), some.column(0), some.column(1), some.column(2)],
                        names=["grp", "vec_id", "vec", "row"])

    chunk = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")
    sent = placed.mapInArrow(copies, "grp int, vec_id bigint, vec array<double>, row bigint").withColumn("chunk", chunk)
    split_of = spark.createDataFrame([(c, g, splits[g]) for c, g in group_of.items()], "cell int, grp int, splits int")
    asking = queries.join(F.broadcast(split_of), "cell").select(                  # a row per pivot at most
        "grp", F.pmod(F.xxhash64("row"), F.col("splits")).cast("int").alias("split"), "vec_id", "vec", "row")
    asking = asking.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    many = F.broadcast(spark.createDataFrame(
        [(g, s) for g, count in enumerate(splits) for s in range(count)], "grp int, split int"))
    sent = sent.join(many, "grp")

    def solve(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "query_row", "vec_id", "score"]
        if not len(q) or not len(d):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        d = d.sort_values("vec_id")
        ids, own_rows = d["vec_id"].to_numpy(), d["row"].to_numpy()
        x = matrix(d["vec"].tolist(), dim)
        parts = []
        for at in range(0, len(q), 128):
            some = q.iloc[at:at + 128]
            scores = matrix(some["vec"].tolist(), dim) @ x.T          # whole numbers below 2^53: exact
            for own, number, row in zip(some["vec_id"].to_numpy(), some["row"].to_numpy(), scores):
                row[own_rows == number] = -np.inf
                best = top_of(row, k)
                best = best[np.isfinite(row[best])]
                parts.append(pd.DataFrame({"query_id": own, "query_row": number, "vec_id": ids[best], "score": row[best].astype(np.int64)}))
        return pd.concat(parts, ignore_index=True)[names]

    keys = ["grp", "split", "chunk"]
    found = asking.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInPandas(
        solve, "query_id bigint, query_row bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
