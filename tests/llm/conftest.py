import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def document_rows():
    """Nulls, empty and very long texts, ties, repeated rows."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from all of the others in the wood"
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(30_000))
    return [
        (1, prose, "b"), (2, prose, "b"), (2, prose, "b"), (3, prose.upper(), "a"), (4, None, "a"), (5, "", None), (6, long, None),
        (7, "one", "b"), (8, " \n\t ", "c"), (None, prose, "a"), (9, None, None), (10, "Ünï cödé\u00a0x\u2003y", "b"), (11, "one", "b"),
        (11, "another text of the same id", "b"), (12, "z" * 100_000, "a"), (13, prose + " now", "c"), (-3, "one", "d"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The rows above with extra columns that bear the names of results."""
    rows = [(*r, "mine", -1, True, 7.5) for r in document_rows()]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, target string, size long, kept boolean, score double"
    ).repartition(3, "source")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")
