"""Vector code compression: product codebooks whose assignments are pruned by pivots (LAESA).

A vector's components become floor(scale * x) and are cut into ``parts`` equal consecutive
parts.  Each part position has a codebook of ``entries`` entries, fitted by Lloyd rounds in
whole numbers.  Assigning a part to its nearest entry would compare it with every entry;
instead

1. a few parts are fixed as pivots, and the distances of every part to its position's pivots
   are computed once and written with the parts;
2. each round the distances pivot - entry give, by the triangle inequality, a lower bound
   |d(part, pivot) - d(pivot, entry)| on every distance part - entry (greatest over pivots);
3. entries are tried in the order of that bound, and an exact integer distance is evaluated
   only while the bound is not above the best one found; ties go to the lower index, so
   equal bounds are still evaluated.

The pivots only decide what is evaluated: codes, errors and codebooks are exact integers.  A
round is one pass over the written parts; tasks return sums and counts per (part, entry),
combined by Spark, and parts x entries rows (128) reach the driver as the next codebooks.

Vectors that are NULL or hold NULL or non-finite components take no part, nor do empty ones,
nor vectors of another length than the kept vector with the smallest id.  Its length must
be a multiple of ``parts``, and scaled components must stay below 2^26 in size, so that
squared distances fit a long; both raise otherwise.  NULL ids come last in the order of ids;
rows of one id are ordered by their components; equal rows each give a result row (and
equal starting entries, of which the lower index is used).  Fewer rows than ``entries`` give
shorter codebooks; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import written

PARTS, ENTRIES, ROUNDS = 8, 16, 6
PIVOTS = 4
LIMIT = 1 << 26
FEW = 1 << 16          # label sums up to so many rows are broadcast; beyond, they are joined by shuffle


def kept_vectors(vectors: DataFrame, scale: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vec array<bigint>)."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c).cast("long"))
    return (vectors.where(F.col(vec_col).isNotNull() & ~F.coalesce(bad, F.lit(True)) & (F.size(vec_col) > 0))
            .select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), whole.alias("vec")))


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to one point, or row by row."""
    gap = points - entry
    return np.einsum("ij,ij->i", gap, gap)


def nearest(part: np.ndarray, far: np.ndarray, book: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each row of ``part`` and the squared distance, with the number of exact
    evaluations.  ``far``: distances to the pivots (rows x pivots); ``gaps``: distances
    pivot - entry (pivots x entries)."""
    n, k = len(part), len(book)
    bound = np.zeros((n, k))
    for p in range(gaps.shape[0]):
        np.maximum(bound, np.abs(far[:, p, None] - gaps[p][None, :]), out=bound)
    # Room for the rounding of square roots: the bound may only be too low.
    bound = np.maximum(bound * (1 - 1e-9) - 1e-6, 0)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(n, np.iinfo(np.int64).max)
    at = np.full(n, k, dtype=np.int64)
    rows, evaluated = np.arange(n), 0
    for step in range(k):
        entry = order[rows, step]
        if step:
            open_ = bound[rows, entry] ** 2 <= best[rows]
            rows, entry = rows[open_], entry[open_]        # bounds ascend: a closed row stays closed
        if not len(rows):
            break
        d = squared(part[rows], book[entry])
        evaluated += len(rows)
        better = (d < best[rows]) | ((d == best[rows]) & (entry < at[rows]))
        best[rows[better]] = d[better]
        at[rows[better]] = entry[better]
    return at, best, evaluated


def matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


@dataclass(frozen=True)
class Fitted:
    """``data``: the written parts with their pivot distances; ``books``: parts x entries x width;
    ``pivots``: parts x pivots x width; ``shares``: per round, exact evaluations as a share of all
    pairs part - entry."""

    data: DataFrame
    books: np.ndarray
    pivots: np.ndarray
    shares: list[float]


def fit(vectors: DataFrame, scale: float = 4096.0, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
        n_pivots: int = PIVOTS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
        ) -> Fitted | None:
    """Codebooks over all kept vectors; None if there are none."""
    kept = kept_vectors(vectors, scale, id_col, vec_col, label_col)
    first = (kept.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect())
    if not first:
        return None
    dim = len(first[0][0])
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    width = dim // parts
    kept = kept.where(F.size("vec") == dim)
    if any(len(r[0]) != dim for r in first):
        first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vec").limit(entries).select("vec").collect()
    too_large = F.exists("vec", lambda c: F.abs(c) >= LIMIT)
    kept = kept.withColumn("vec", F.when(too_large, F.raise_error(F.lit(
        f"a scaled component is {LIMIT} or more in size"))).otherwise(F.col("vec")))
    books = np.array([r[0] for r in first], dtype=np.int64).reshape(-1, parts, width).transpose(1, 0, 2).copy()
    pivots = spread(books, n_pivots)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distances to the pivots, once."""
        for batch in batches:
            x = matrix(batch.column(2), dim, np.int64).reshape(-1, parts, width)
            far = np.empty((len(x), parts, pivots.shape[1]))
            for m in range(parts):
                for p in range(pivots.shape[1]):
                    far[:, m, p] = np.sqrt(squared(x[:, m], pivots[m, p]))
            flat = pa.array(far.reshape(-1))
            each = parts * pivots.shape[1]
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * each)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, flat)],
                                             names=["vec_id", "label", "vec", "far"])

    label_type = kept.schema["label"].dataType.simpleString()
    data = written(kept.mapInArrow(measure, f"vec_id bigint, label {label_type}, vec array<bigint>, far array<double>"),
                   "vector-parts")
    shares = []
    for _ in range(rounds):
        sums = summed(data, books, pivots).collect()        # parts x entries rows
        used = sum(r["evaluated"] for r in sums)
        total = sum(r["n"] for r in sums) * books.shape[1]
        shares.append(used / total if total else 0.0)
        for r in sums:
            if r["n"]:
                books[r["part"], r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
    return Fitted(data, books, pivots, shares)


def spread(books: np.ndarray, n_pivots: int) -> np.ndarray:
    """Per part position, of the starting entries those that lie farthest apart: the first, then
    each time the one farthest from all chosen (fixed for all rounds)."""
    chosen = []
    for book in books:
        picks = [0]
        gap = squared(book, book[0])
        while len(picks) < min(n_pivots, len(book)):
            picks.append(int(gap.argmax()))
            gap = np.minimum(gap, squared(book, book[picks[-1]]))
        chosen.append(book[picks])
    return np.array(chosen)


def pivot_gaps(pivots: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Distances pivot - entry (parts x pivots x entries)."""
    gap = pivots[:, :, None, :] - books[:, None, :, :]
    return np.sqrt((gap * gap).sum(-1))


def summed(data: DataFrame, books: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(part, entry, n, sums, evaluated): component sums of the parts nearest to each entry."""
    parts, k, width = books.shape
    gaps, per = pivot_gaps(pivots, books), pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, k), dtype=np.int64)
        evaluated = np.zeros((parts, k), dtype=np.int64)
        sums = np.zeros((parts, k, width), dtype=object)        # Python integers: no overflow in a task
        for batch in batches:
            x = matrix(batch.column(0), parts * width, np.int64).reshape(-1, parts, width)
            far = matrix(batch.column(1), parts * per, np.float64).reshape(-1, parts, per)
            for m in range(parts):
                at, _, tried = nearest(x[:, m], far[:, m], books[m], gaps[m])
                evaluated[m, 0] += tried
                part_sums = np.zeros((k, width), dtype=np.int64)
                np.add.at(part_sums, at, x[:, m])
                sums[m] = sums[m] + part_sums
                n[m] += np.bincount(at, minlength=k)
        grid = [(m, e) for m in range(parts) for e in range(k)]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([m for m, _ in grid], pa.int32()), "entry": pa.array([e for _, e in grid], pa.int32()),
            "n": pa.array(n.reshape(-1)), "evaluated": pa.array(evaluated.reshape(-1)),
            **{f"s{i}": pa.array([str(sums[m, e, i]) for m, e in grid]) for i in range(width)}})

    columns = ", ".join(f"s{i} string" for i in range(width))
    found = data.select("vec", "far").mapInArrow(run, f"part int, entry int, n bigint, evaluated bigint, {columns}")
    return found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.sum("evaluated").alias("evaluated"),
        F.array(*[F.sum(F.col(f"s{i}").cast("decimal(38,0)")) for i in range(width)]).alias("sums"))


def codebook_digest(books: np.ndarray) -> Column:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return F.sha2(F.lit(",".join(str(int(x)) for x in books.reshape(-1))).cast("binary"), 256)


def encode(vectors: DataFrame, scale: float = 4096.0, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           n_pivots: int = PIVOTS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label"
           ) -> tuple[DataFrame, Fitted | None]:
    """Codes of all kept vectors - (vec_id, label, code array<int>, error, label_error) - and the
    fitted codebooks.  ``label_error`` is the error summed over equal labels, NULL labels
    together."""
    label_type = vectors.schema[label_col].dataType.simpleString()
    schema = f"vec_id bigint, label {label_type}, code array<int>, error bigint"
    fitted = fit(vectors, scale, parts, entries, rounds, n_pivots, id_col, vec_col, label_col)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema + ", label_error bigint"), None
    books, width = fitted.books, fitted.books.shape[2]
    gaps, per = pivot_gaps(fitted.pivots, books), fitted.pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(2), parts * width, np.int64).reshape(-1, parts, width)
            far = matrix(batch.column(3), parts * per, np.float64).reshape(-1, parts, per)
            code = np.empty((len(x), parts), dtype=np.int32)
            error = np.zeros(len(x), dtype=np.int64)
            for m in range(parts):
                at, d, _ = nearest(x[:, m], far[:, m], books[m], gaps[m])
                code[:, m] = at
                error += d
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(code.reshape(-1))), pa.array(error)],
                names=["vec_id", "label", "code", "error"])

    coded = written(fitted.data.mapInArrow(run, schema), "vector-codes")
    sums = written(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    few = sums.count() <= FEW
    out = coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of_label"))).drop("of_label")
    return out, fitted
