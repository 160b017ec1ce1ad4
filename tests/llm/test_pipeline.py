import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from flowspark.llm import importance, linecrf, oddsketch
from flowspark.llm.mixing import mix, word_count
from flowspark.session import cut_lineage

NUMBERS = range(1, 14)


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(NUMBERS)
    assert "pipeline" in entry.queries() and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "quality_classifier", "near_duplicates", "mix_sources", "pack_sequences"
    ]


@pytest.fixture(scope="module")
def stages(spark, sf, docs):
    """Input and result of each stage."""
    out, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        result = cut_lineage(stage(spark, now, sf))
        out[name] = (now, result)
        now = result
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(stages, docs):
    for name, (_, result) in stages.items():
        if name != "pack_sequences":
            assert result.columns == docs.columns
            assert result.select("doc_id", "text").exceptAll(result.join(docs, ["doc_id", "text"], "left_semi").select("doc_id", "text")).count() == 0


def test_stages_decide_by_their_operators(stages, spark, labels):
    before, after = stages["quality_rules"]
    model = linecrf.train(before, labels.selectExpr("doc_id", "quality = 1 AS good"))
    assert ids(after) == ids(linecrf.judge(before, model).filter("kept"))
    before, after = stages["quality_classifier"]
    good = labels.selectExpr("doc_id", "quality = 1 AND toxic = 0 AS good")
    assert ids(after) == ids(importance.resample(before, good, keep=["doc_id"]).filter("kept"))
    before, after = stages["near_duplicates"]
    assert ids(after) == ids(oddsketch.near_duplicates(before, 5, 80).filter("kept"))
    before, after = stages["mix_sources"]
    copies = {r["doc_id"]: r["copies"] for r in mix(before, word_count()).collect() if r["copies"]}
    assert {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == copies


def test_packed_pieces_are_the_documents(stages):
    before, after = stages["pack_sequences"]
    whole = after.groupBy("doc_id").agg(F.sum(F.when(F.col("piece") == 0, 1)).alias("n"))
    assert {r["doc_id"]: r["n"] for r in whole.collect()} == {
        r["doc_id"]: r["n"] for r in before.groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    }
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0


def test_odd_rows_and_empty_tables(spark, sf, odd_docs, no_docs):
    for table in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, table, sf)
            assert name == "pack_sequences" or result.columns == table.columns
            result.write.format("noop").mode("overwrite").save()
