import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.packing import pack_documents

NAME = "op6_swap_packing"
SQL = None  # a tokenizer's ids and a local search


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=0)
