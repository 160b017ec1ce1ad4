"""The same rules on streams; files are the source, all of them are taken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog import derived as D
from flowspark.catalog import requests as B
from flowspark.catalog.flows import step
from flowspark.operators import requests as R
from flowspark.plans.runner import run_flow
from flowspark.session import scratch_path
from flowspark.sources import audit as A
from flowspark.streaming import log as S


def streamed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The table as a file stream; the pattern takes one file or a folder of files."""
    schema = D.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(1 << 30)).parquet(f"{sf}/{name}.parquet*")


def stream_log(spark: SparkSession, events: DataFrame, derived: str = "request_log") -> DataFrame:
    events.createOrReplaceTempView("events")
    return spark.sql(D.render(derived, D.SPARK))


def stream_throttle(spark: SparkSession, sf: str) -> DataFrame:
    calls = stream_log(spark, streamed(spark, sf, "events"))
    out = S.stream_throttle(calls, "provider", "t_us", "event_id", R.rpm_limit("provider", B.OVERRIDES))
    return S.run_available(out, "throttle").withColumn("retry_after", F.round("retry_after", 6))


def stream_ttl_dedup(spark: SparkSession, sf: str) -> DataFrame:
    calls = stream_log(spark, streamed(spark, sf, "events"))
    out = S.stream_ttl_dedup(calls, "request_key", "t_us", "event_id", F.col("status") == "success", B.TTL_SECONDS)
    return S.run_available(out, "ttl")


def _per_minute(spark: SparkSession, calls: DataFrame, label: str, by: list[str], sums: dict[str, Column]) -> DataFrame:
    folder = scratch_path(spark, label)
    S.write_per_minute(calls, folder, label, "t_us", by, sums).awaitTermination()
    return S.read_per_minute(spark, folder, "t_us", by, sums)


def stream_rpm(spark: SparkSession, sf: str) -> DataFrame:
    """Requests per minute, late ones from the output of their own."""
    return _per_minute(spark, stream_log(spark, streamed(spark, sf, "events")), "rpm", ["provider"], {})


def stream_usage(spark: SparkSession, sf: str) -> DataFrame:
    """Calls, tokens and exact cost per minute, provider, model and status."""
    calls = stream_log(spark, streamed(spark, sf, "events")).withColumn("cost", R.exact(R.cost("model", "prompt_tokens", "completion_tokens")))
    sums = {c: F.col(c) for c in ("prompt_tokens", "completion_tokens", "cost")}
    found = _per_minute(spark, calls, "usage", ["provider", "model", "status"], sums)
    return found.withColumnRenamed("requests", "calls").withColumn("cost", F.col("cost").cast("double"))


def stream_route(spark: SparkSession, sf: str) -> DataFrame:
    asked = B._with_model(streamed(spark, sf, "conversations").filter("role = 'user'")).withColumnRenamed("text", "prompt")
    out = R.route(asked, B.PROVIDERS, B.RULES).select("conv_id", "turn", "provider", "routed_model")
    return S.run_available(out, "route")


def stream_access(spark: SparkSession, sf: str) -> DataFrame:
    """Stream of requests joined with the stored grants, with the cost of each."""
    grants = B._grants(spark, sf)
    calls = stream_log(spark, streamed(spark, sf, "events"))
    calls = calls.withColumn("cost", F.round(R.cost("model", "prompt_tokens", "completion_tokens"), 9))
    return S.run_available(R.access_check(calls, grants).select("event_id", "http_status", "cost"), "access")


def stream_audit(spark: SparkSession, sf: str) -> DataFrame:
    lines = stream_log(spark, streamed(spark, sf, "events"), "audit_lines")
    return S.run_available(A.parse_audit(lines).select("event_id", "malformed", "provider", "status", "cost"), "audit")


ALERTS = {
    "name": "EVENT_ALERTS",
    "steps": [
        step("LOAD_EVENTS", [], 1, "SELECT event_id, user_id, event_type, value FROM ${EVENTS} WHERE value IS NOT NULL"),
        step("FILTER_ALERTS", ["LOAD_EVENTS"], 2, "SELECT * FROM LOAD_EVENTS WHERE event_type = 'error' AND value > $[LIMIT]", table="ALERTS"),
    ],
}


def stream_flow(spark: SparkSession, sf: str) -> DataFrame:
    run = run_flow(spark, ALERTS, {"EVENTS": streamed(spark, sf, "events")}, {"LIMIT": 5.0})
    folder = scratch_path(spark, "alerts")
    alerts = run["FILTER_ALERTS"]
    S.write_stream_step(alerts, "ALERTS", folder, "alerts").awaitTermination()
    return spark.read.parquet(f"{folder}/ALERTS").select(*alerts.columns)


QUERIES = {
    f.__name__: f
    for f in (stream_throttle, stream_ttl_dedup, stream_rpm, stream_usage, stream_route, stream_access, stream_audit, stream_flow)
}

ORACLE = {
    "stream_throttle": B.ORACLE["throttle"],
    "stream_ttl_dedup": B.ORACLE["ttl_dedup"],
    "stream_rpm": B.ORACLE["rpm_report"],
    "stream_usage": f"""{B.COSTED} SELECT CAST(floor(t_us / 60000000) AS BIGINT) * 60000000 AS minute_us, provider, model, status, {B._USAGE}
        FROM costed GROUP BY ALL""",
    "stream_route": rf"""WITH p AS (SELECT conv_id, turn, {B._MODEL} AS model, text AS prompt FROM conversations WHERE role = 'user')
        SELECT conv_id, turn, CASE WHEN model IN ('openai', 'opencode') THEN model WHEN regexp_matches(prompt, '(?i)eau|ç') THEN 'openai'
            WHEN regexp_matches(prompt, '(?i)\bthe\b') THEN 'opencode' ELSE 'openai' END AS provider,
          CASE WHEN model = 'openai' THEN 'openai' WHEN model = 'opencode' THEN 'deepseek-chat' WHEN regexp_matches(prompt, '(?i)eau|ç') THEN 'gpt-4o'
            WHEN regexp_matches(prompt, '(?i)\bthe\b') THEN 'deepseek-chat' ELSE model END AS routed_model FROM p""",
    "stream_access": f"""{B.COSTED} SELECT event_id, CASE WHEN api_key IS NULL THEN 401 WHEN api_key IN ({B._GRANTED}) THEN 200 ELSE 403 END AS http_status,
        CAST(CAST(cost AS DECIMAL(28,9)) AS DOUBLE) AS cost FROM costed""",
    "stream_audit": f"SELECT event_id, malformed, provider, status, cost FROM ({B.ORACLE['read_audit']})",
    "stream_flow": "SELECT event_id, user_id, event_type, value FROM events WHERE event_type = 'error' AND value > 5",
}
