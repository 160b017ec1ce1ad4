"""Judge answers as a table: score gate and choice of the best iteration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.functions.text import json_object
from flowspark.operators.corpus import strict_json
from flowspark.schemas import EVALUATION_LOOSE

# Gate values (fixed values).
THRESHOLD = 8.5
MINIMUMS = {"correctness": 8.0, "spark_execution_efficiency": 8.0, "dependency_correctness": 8.0}


def evaluation_gate(answers: DataFrame, text: str = "response", threshold: float = THRESHOLD) -> DataFrame:
    """Add ``status``, ``score``, ``feedback``, ``dimensions``, ``issues`` and ``passed``.

    ``status`` is ok, no_json, bad_json, missing_score, missing_feedback or
    missing_dimension; ``passed`` is NULL unless ok.
    """
    dims = F.col("v.dimensions")
    lacking = F.lit(False)
    enough: Column = F.col("score") >= threshold
    for name, least in MINIMUMS.items():
        lacking = lacking | F.coalesce(dims[name].isNull(), F.lit(True))
        enough = enough & (F.col("dimensions")[name] >= least)
    status = (
        F.when(F.col("json").isNull(), "no_json")
        .when(F.col("v").isNull(), "bad_json")
        .when(F.expr("try_variant_get(v.score, '$', 'double')").isNull(), "missing_score")
        .when(F.expr("try_variant_get(v.feedback, '$', 'string')").isNull(), "missing_feedback")
        .when(lacking, "missing_dimension")
        .otherwise("ok")
    )
    ok = F.col("status") == "ok"
    return (
        answers.withColumn("json", json_object(text))
        .select("*", F.explode(F.array(strict_json(F.col("json"), EVALUATION_LOOSE))).alias("v"))
        .withColumn("status", status)
        .withColumn("score", F.when(ok, F.expr("try_variant_get(v.score, '$', 'double')")))
        .withColumn("feedback", F.when(ok, F.expr("try_variant_get(v.feedback, '$', 'string')")))
        .withColumn("dimensions", F.when(ok, dims))
        .withColumn("issues", F.when(ok, F.coalesce("v.critical_issues", F.array().cast("array<string>"))))
        .withColumn("passed", F.when(ok, enough & (F.size("issues") == 0)))
        .drop("json", "v")
    )


def best_iteration(gated: DataFrame, max_iterations: int | None = None) -> DataFrame:
    """Per flow the first passing iteration, else the best score (earliest on a
    tie), else, with nothing scored, the last one. One aggregate, no sort.
    ``max_iterations`` leaves later ones out; by default none are."""
    scored = F.col("status") == "ok"
    return (
        (gated if max_iterations is None else gated.filter(F.col("iteration") <= max_iterations))
        .groupBy("flow")
        .agg(
            F.min(F.when(F.col("passed"), F.struct("iteration", "score"))).alias("first_pass"),
            F.max(F.when(scored, F.struct("score", (-F.col("iteration")).alias("back")))).alias("best"),
            F.max("iteration").alias("last"),
            F.count_if(scored).alias("n_scored"),
        )
        .select(
            "flow",
            F.coalesce("first_pass.iteration", -F.col("best.back"), "last").alias("iteration"),
            F.coalesce("first_pass.score", "best.score").alias("score"),
            F.col("first_pass").isNotNull().alias("passed"),
            "n_scored",
        )
    )
