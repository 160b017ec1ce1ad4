"""Judge answers and the choice between iterations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog.derived import derived, with_tables
from flowspark.operators import corpus as C
from flowspark.operators import evaluation as E


def gated(spark: SparkSession, sf: str) -> DataFrame:
    return E.evaluation_gate(derived(spark, sf, "evaluations"))


def evaluation_gate(spark: SparkSession, sf: str) -> DataFrame:
    return gated(spark, sf).select(
        "flow", "iteration", "status", "score", "feedback", "passed", F.array_join("issues", ",").alias("issues"),
        F.col("dimensions")["correctness"].alias("correctness"),
    )


def best_iteration(spark: SparkSession, sf: str) -> DataFrame:
    return E.best_iteration(gated(spark, sf))


def tune_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    failed = gated(spark, sf).filter("NOT passed")
    text = F.concat(F.lit("flow "), F.col("flow").cast("string"))
    return failed.select("flow", "iteration", C.tuned_description(text, F.col("feedback"), E.THRESHOLD).alias("description"))


QUERIES = {f.__name__: f for f in (evaluation_gate, best_iteration, tune_descriptions)}

GATED = r"""SELECT *, CASE WHEN status = 'ok' THEN score >= 8.5 AND coalesce(issues, '') = '' AND correctness >= 8 AND efficiency >= 8 AND dependency >= 8 END AS passed
  FROM (SELECT *, CASE WHEN json IS NULL THEN 'no_json' WHEN j IS NULL THEN 'bad_json' WHEN score IS NULL THEN 'missing_score' WHEN feedback IS NULL THEN 'missing_feedback'
               WHEN correctness IS NULL OR efficiency IS NULL OR dependency IS NULL THEN 'missing_dimension' ELSE 'ok' END AS status
  FROM (SELECT *, CAST(json_extract(j, '$.score') AS DOUBLE) AS score, json_extract_string(j, '$.feedback') AS feedback,
               CAST(json_extract(j, '$.dimensions.correctness') AS DOUBLE) AS correctness,
               CAST(json_extract(j, '$.dimensions.spark_execution_efficiency') AS DOUBLE) AS efficiency,
               CAST(json_extract(j, '$.dimensions.dependency_correctness') AS DOUBLE) AS dependency,
               json_extract_string(j, '$.critical_issues[0]') AS issues
  FROM (SELECT *, CASE WHEN json_valid(json) THEN CAST(json AS JSON) END AS j
  FROM (SELECT *, nullif(regexp_extract(response, '\{[\s\S]*\}'), '') AS json FROM evaluations))))"""

_HEAD = f"{with_tables('evaluations')}, g AS MATERIALIZED ({GATED})"

ORACLE = {
    "evaluation_gate": f"""{_HEAD} SELECT flow, iteration, status, CASE WHEN status = 'ok' THEN score END AS score,
        CASE WHEN status = 'ok' THEN feedback END AS feedback, passed, CASE WHEN status = 'ok' THEN coalesce(issues, '') END AS issues,
        CASE WHEN status = 'ok' THEN correctness END AS correctness FROM g""",
    "best_iteration": f"""{_HEAD}, ranked AS (SELECT *, row_number() OVER (PARTITION BY flow ORDER BY
          CASE WHEN passed THEN 0 WHEN status = 'ok' THEN 1 ELSE 2 END,
          CASE WHEN passed THEN iteration WHEN status = 'ok' THEN -score ELSE -iteration END, iteration) AS rn,
          count(*) FILTER (status = 'ok') OVER (PARTITION BY flow) AS n_scored FROM g)
        SELECT flow, iteration, CASE WHEN status = 'ok' THEN score END AS score, coalesce(passed, false) AS passed, n_scored FROM ranked WHERE rn = 1""",
    "tune_descriptions": f"""{_HEAD} SELECT flow, iteration, concat('flow ', flow, chr(10), chr(10), '---', chr(10),
        'Feedback from previous evaluation (score < 8.5/10):', chr(10), feedback, chr(10), chr(10),
        'Please address the feedback above and regenerate an improved Spark SQL flow.') AS description FROM g WHERE NOT passed""",
}
