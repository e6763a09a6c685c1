"""SimHash near-duplicates through pivot distance tables.

Fingerprints: the words of a text (split at ASCII white space, lower-cased in ASCII)
make shingles; a bit of the 64 is set if it is set in over half of the shingles'
XXH64 values (seed 42).  Texts with equal fingerprints are one point from then on, so
groups of copies of any size cost one row.

Pivot distance table: Hamming distances of a point to 33 reference fingerprints - zero,
and for each block of two bits the fingerprint with just this block set.  A differing bit
moves the distance to a reference by one, so points within r bits differ by at most
r in every coordinate.  The coordinates also split by segments of the fingerprint: from
the distances to the references of a segment follow its blocks' bit counts, and bits
that differ can spoil only ``max_bits`` of the ``max_bits + 2`` segments.  So every
linked pair agrees on the coordinates of some two segments; points are grouped
by these (a join key per pair of segments), pairs within a group are discarded by
their greatest coordinate difference, and survivors are verified bit by bit.

Groups of more than ``tile`` points are dealt to tiles, and tile pairs are compared apart.
A comparison returns the edges of a spanning forest of its links, never all pairs;
connected components (written tables, no driver state) join them.  No link is lost.

NULL and wordless texts have fingerprint zero and link like any other.  NULL ids take
part, but are never a component id unless a component has no other (then NULL).
Repeated rows are points like any copies.  Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import components, fresh, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
TILE = 4096
BLOCKS = 32                  # of two bits
PAIRS_AT_ONCE = 1 << 18


def references() -> np.ndarray:
    return np.array([0] + [3 << (2 * b) for b in range(BLOCKS)], np.uint64)


def distance_table(points: np.ndarray) -> np.ndarray:
    """Hamming distances [points x references]."""
    return np.bitwise_count(points[:, None] ^ references()[None, :])


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash

    words = (text or "").encode("utf-8", "replace").lower().split()      # bytes.lower: ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[:-shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())),
                         np.uint64, len(starts))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` and ``fp``, the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in batch.column(len(keep)).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(run, f"{kinds}, fp bigint")


def segment_keys(points: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """A 64-bit key per choice of two segments, from the distance table alone: points
    with equal coordinates there have equal keys."""
    table = distance_table(points).astype(np.int64)
    counts = (table[:, :1] + 2 - table[:, 1:]) // 2            # d(x,0) + 2 - d(x,R) = 2 x bits set in R's block
    cuts = [BLOCKS * i // (max_bits + 2) for i in range(max_bits + 3)]
    parts = [counts[:, a:b] @ (3 ** np.arange(b - a)) for a, b in zip(cuts, cuts[1:])]
    return [parts[i] * 3**16 + parts[j] for i, j in combinations(range(len(parts)), 2)]


def forest(points: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Edges (2 x n) from each linked point to the least point of its part of the graph."""
    label = np.arange(len(points))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(points)))
    return np.stack([points[away], points[label[away]]])


def linked(points: np.ndarray, tiles: np.ndarray, max_bits: int) -> np.ndarray:
    """Edges of a spanning forest over the links in one group.  With two tiles, only
    pairs across them are compared."""
    table = distance_table(points).astype(np.int8)
    n = len(points)
    two = tiles[0] != tiles[-1]                               # sorted by tile
    edge = int(np.searchsorted(tiles, tiles[-1])) if two else 0
    lefts, rights = [], []
    at, stop = 0, edge if two else n - 1
    while at < stop:
        width = n - (edge if two else at + 1)
        rows = np.arange(at, min(stop, at + max(1, PAIRS_AT_ONCE // max(1, width))))
        at = rows[-1] + 1
        if two:
            i, j = np.repeat(rows, n - edge), np.tile(np.arange(edge, n), len(rows))
        else:
            i = np.repeat(rows, n - 1 - rows)
            j = np.concatenate([np.arange(r + 1, n) for r in rows])
        for c in range(0, table.shape[1], 11):                # the greatest coordinate difference, a few at a time
            near = np.abs(table[i, c:c + 11] - table[j, c:c + 11]).max(1) <= max_bits
            i, j = i[near], j[near]
        same = np.bitwise_count(points[i] ^ points[j]) <= max_bits
        lefts.append(i[same])
        rights.append(j[same])
    if not lefts:
        return np.zeros((2, 0), np.uint64)
    return forest(points, np.concatenate(lefts), np.concatenate(rights))


def links(points: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``points`` (fp) wherever a
    chain of links within ``max_bits`` does."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            fps = batch.column(0).to_numpy().view(np.uint64)
            for band, key in enumerate(segment_keys(fps, max_bits)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fps), band, np.int32)), pa.array(key), batch.column(0)],
                    names=["band", "key", "fp"])

    keyed = points.select("fp").mapInArrow(keys, "band int, key bigint, fp bigint")
    sizes = keyed.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = (
        keyed.join(sizes, ["band", "key"]).withColumn("tiles", tiles).withColumn("tile", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .groupBy("band", "key", F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"))
        .agg(F.sort_array(F.collect_list(F.struct("tile", "fp"))).alias("points"))      # about 2 tiles at most
        .select("t1", "t2", "points.tile", "points.fp")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((2, 0), np.uint64)]
            for t1, t2, tile_list, fp_list in zip(*(batch.column(i) for i in range(4))):
                tile_of, fps = tile_list.values.to_numpy(), fp_list.values.to_numpy().view(np.uint64)
                if t1.as_py() == t2.as_py() or tile_of[0] != tile_of[-1]:
                    found.append(linked(fps, tile_of, max_bits))
            a, b = np.concatenate(found, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, keep: list[str] | None = None, shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """One row per document: the columns ``keep`` (default doc_id), ``fp`` and ``component``,
    the least fingerprint of its component."""
    keep = keep or ["doc_id"]
    marked = written(fingerprints(docs, keep, shingle), "fingerprints")
    points = marked.select("fp").distinct()
    parts = components(links(points, max_bits, tile))
    joined = marked.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    return joined.select(*keep, "fp", F.coalesce("component", "fp").alias("component"))


def component_ids(docs: DataFrame, id_col: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                  tile: int = TILE) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id: the smallest id reachable)."""
    marked = written(fingerprints(docs, [id_col], shingle), "fingerprints")
    points = marked.groupBy("fp").agg(F.min(id_col).alias("least"))
    parts = components(links(points, max_bits, tile)).withColumnRenamed("node", "fp")
    placed = written(points.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "points")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = placed.join(least, "component").select("fp", "component_id")
    return marked.join(by_fp, "fp").select(
        id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id
    (NULL ids last; of equal ids the first read)."""
    row = fresh(docs, "row")
    # Numbered once: a later scan of the same files may be split otherwise and number them anew.
    base = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    near = near_duplicates(base.select(row, F.col("doc_id").cast("long").alias("doc"), "text"), [row, "doc"],
                           shingle, max_bits, tile)
    first = (near.groupBy("component").agg(F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", row)).alias("first"))
             .select(F.col(f"first.{row}").alias(row)))
    dropped = written(near.join(first, row, "left_anti").select(row), "dropped")
    return base.join(dropped, row, "left_anti").drop(row)
