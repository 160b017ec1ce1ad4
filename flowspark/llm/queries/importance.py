from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.importance import resample

NAME = "op2_importance_resampling"
SQL = None  # hashed models and a seeded draw


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality = 1 AND toxic = 0 AS good")
    return resample(docs, labels, keep=["doc_id"])
