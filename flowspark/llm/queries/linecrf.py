from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.linecrf import judge, train

NAME = "op8_crf_lines"
SQL = None  # a fitted model


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality = 1 AS good")
    return judge(docs, train(docs, labels)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_words"
    )
