"""Table metadata files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.operators.metadata import any_tables


def read_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: ``path``, ``tables``, and ``error`` where nothing was found."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))
    found = files.withColumn("tables", any_tables("text", F.col("path")))
    unread = F.when(F.col("tables").isNull(), "neither JSON metadata nor CREATE TABLE statements")
    return found.withColumn("error", unread).drop("text")
