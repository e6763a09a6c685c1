"""Reference-data seeds from CSV files, read with an explicit schema (no
inference pass over the data) and the header row skipped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_seed_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                  null_value: str = "") -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("nullValue", null_value)
            .option("mode", "FAILFAST").csv(path))
