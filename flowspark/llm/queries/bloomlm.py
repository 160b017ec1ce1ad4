from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.bloomlm import score

NAME = "op9_bloom_lm"
SQL = None  # a hashed model; tests hold the plain score against a count in plain Python


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, keep=["doc_id"])
