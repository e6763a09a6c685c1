"""Training-corpus pipeline: classify, strip boilerplate, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; ``run``
writes a stage's rows as Parquet below ``spark.checkpoint.dir`` and rereads them as the
next one's docs.  All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import decontaminate, line_dedup, mixing, quality, simhash
from monthwise.llm.common import fold_of, fresh, table
from monthwise.session import new_work_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more (operator 10)."""
    weights = quality.train(docs, table(spark, sf_dir, "labels"), fold_of() != 1)
    return quality.keep_good(docs, weights)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines cut (operator 1); ``n_chars`` follows the text.  Documents of
    which nothing is left but white space are dropped, those that were blank before stay."""
    # The operator replaces columns of these names; the input's own step aside.
    aside = {c: fresh(docs, f"own_{c}") for c in docs.columns if c.lower() in ("n_lines", "n_removed")}
    named = docs.withColumnsRenamed(aside)
    gone = fresh(named, "gone")
    out = line_dedup.remove_boilerplate(named).withColumnRenamed("n_removed", gone)
    return (out.where((F.col(gone) == 0) | (F.btrim("text", F.lit(" \t\r\n")) != ""))
            .withColumn("n_chars", F.when(F.col(gone) == 0, F.col("n_chars")).otherwise(
                F.length("text").cast(docs.schema["n_chars"].dataType)))
            .select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns]))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group (operator 8)."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item (operator 4)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document and epoch of the target mix (operator 9)."""
    return mixing.mixed(docs, mixing.Mix())


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", simhash_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# Hashes, a trained classifier and edit distances: no SQL; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_work_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
