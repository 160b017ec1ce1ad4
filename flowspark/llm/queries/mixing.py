from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.mixing import mix, word_count
from flowspark.session import cut_lineage

NAME = "op1_mix_sources"
# the seeded sample is drawn by a hash that SQL engines don't share; tests hold it against a walk
# through the documents in plain Python
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # counted once; the passes of the mix then read numbers only
    sizes = cut_lineage(docs.select("doc_id", "source", F.xxhash64("text").alias("text"), word_count("text").alias("size")))
    return mix(sizes, F.col("size")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
