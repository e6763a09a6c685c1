"""Helpers shared by the operators: internal columns, scratch tables, folds,
plain-text tokenisation on bytes, connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.session import new_work_path

# ASCII letters to lower case, other ASCII characters but digits to a space;
# bytes from 0x80 up (all of UTF-8's multi-byte characters) stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, as UTF-8: maximal runs of digits, letters lower-cased in
    ASCII, and non-ASCII characters.  NULL has no words."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, whatever extra columns it brings."""
    taken = {c.lower() for c in df.columns}
    name = f"__{stem}"
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder below ``spark.checkpoint.dir`` and read back:
    cuts the lineage with a copy that survives lost executors."""
    path = new_work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; NULL ids get NULL (never trained on)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(3)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` has long columns (a, b).  Returns (node, component) for every node
    of an edge, ``component`` the smallest node.  Minima are partial aggregates and
    joined back, so a node with very many neighbours is split by the join; every
    round is a written table.  Raises if it has not converged after ``max_rounds``."""
    def stars(pairs: DataFrame, name: str) -> DataFrame:
        """pairs (u, v): each u's smallest neighbour, itself included, beside each v."""
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "components")
    mark = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (stars(both, "large").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small = stars(large, "small")
        now = written(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            "components")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark is not None and tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError(f"components did not converge in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
