"""Tables that grow with the input are never sent through the driver."""

import re
import time

import pytest
from pyspark.sql import functions as F

from flowspark.catalog import derived as D
from flowspark.catalog.corpus import stored_steps
from flowspark.operators import graph as G
from flowspark.operators import lint as L


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def lines(spark, folder):
    rows = "(1L, 1), (1L, 1), (1L, 2), (1L, 4), (2L, NULL), (2L, 1), (3L, NULL), (NULL, 1), (4L, -1), (4L, -3), (4L, 0), (14L, 7), (14L, 3), (70L, 5), (70L, 2)"
    spark.sql(f"SELECT * FROM VALUES {rows} t(l_orderkey, l_linenumber)").write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_step_tables_are_built_without_joins(spark, lines):
    for name in ("flow_steps", "responses"):
        plan = _plan(D.derived(spark, lines, name))
        assert "Join" not in plan and "Broadcast" not in plan


def test_step_places_are_those_of_the_sql(spark, lines):
    spark.read.parquet(f"{lines}/lineitem.parquet").createOrReplaceTempView("lineitem")
    was = spark.sql(D.FLOW_STEPS.format(**(D.SPARK | {"places": D.DUCK["places"]})))
    now = D.derived(spark, lines, "flow_steps")
    assert now.schema.simpleString() == was.schema.simpleString()
    assert sorted(map(str, now.collect())) == sorted(map(str, was.collect())) and now.count() > 8


@pytest.mark.parametrize("work", [lambda s: L.lint(s), lambda s: L.view_reads(s), lambda s: G.edges(s), lambda s: G.order_diff(s, G.step_levels(s))])
def test_joins_of_steps_do_not_broadcast(spark, lines, work):
    plan = _plan(work(stored_steps(spark, lines)))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_null_filters_of_long_words_are_found_in_one_pass(spark):
    texts = ["a IS NOT NULLb IS NOT NULL", "é1 is  not\nnull AND t.x IS NOT NULL", "x IS NOT NULL IS NOT NULL", "IS NOT NULL", "w" * 400_000 + " IS NULL"]
    steps = spark.createDataFrame([(k, f"S{k}", t) for k, t in enumerate(texts)], "flow long, name string, sql_text string")
    started = time.time()
    found = {(r.flow, r.fact) for r in L._facts(steps, L.NOT_NULL).collect()}
    assert time.time() - started < 20  # trying every place of a word takes the square of its length
    plain = re.compile(r"(\w+)\s+IS\s+NOT\s+NULL", re.I | re.A)
    assert found == {(k, word.lower()) for k, t in enumerate(texts[:-1]) for word in plain.findall(t)} and (0, "b") in found


def test_facts_of_steps_are_searched_once(spark, lines):
    shared = L.Shared(stored_steps(spark, lines).withColumn("sql_text", F.lit("SELECT a FROM ${T} WHERE a IS NOT NULL")), ["filter", "source"])
    for facts in (shared.filtered, shared.named_sources):
        assert "regexp_extract_all" not in _plan(facts) and facts.count()
