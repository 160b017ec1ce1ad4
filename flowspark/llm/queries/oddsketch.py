from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.oddsketch import near_duplicates

NAME = "op7_odd_sketch_dedup"
SQL = None  # too slow in SQL on whole tables; tests compare all pairs of a small table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs.select("doc_id", "text"), width=2, percent=80)
