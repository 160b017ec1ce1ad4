"""From documents to packed training sequences.

Five stages, each over all that the one before kept: quality rules, quality classifier,
near-duplicates, mixing of sources, packing. All but the last return the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm import importance, linecrf
from flowspark.llm.mixing import mixed, word_count
from flowspark.llm.oddsketch import deduplicated
from flowspark.llm.packing import pack_documents
from flowspark.session import cut_lineage


def _kept_rows(docs: DataFrame, results: list[str], judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their own columns even where a result has such a name."""
    own = {c: f"__own_{c}" for c in docs.columns if c.lower() in results}
    judged = judge(docs.withColumnsRenamed(own)).filter("kept")
    return judged.select(*[F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and consist of content lines."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality = 1 AS good")
    model = linecrf.train(docs, labels)
    return _kept_rows(docs, linecrf.OUTPUT, lambda d: linecrf.judge(d, model, keep=d.columns))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by importance, as many as the labels call good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality = 1 AND toxic = 0 AS good")
    return _kept_rows(docs, importance.OUTPUT, lambda d: importance.resample(d, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word shingles."""
    return deduplicated(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixed(docs, word_count("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# the stages fit models and encode with a tokenizer, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut_lineage(docs)
    return docs
