from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.sharding import shard

NAME = "op4_balanced_shards"
SQL = None  # an iterative rule


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs, keep=["doc_id"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
