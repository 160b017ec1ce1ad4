import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.simple8b import token_digests

NAME = "op5_simple8b_tokens"
SQL = None  # a tokenizer's ids


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_digests(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
