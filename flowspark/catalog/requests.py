"""Request-log queries, batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog.derived import derived, table, with_tables
from flowspark.operators import corpus as C
from flowspark.operators import ordered as O
from flowspark.operators import requests as R
from flowspark.session import scratch_path
from flowspark.sources import audit as A
from flowspark.sources import flows as S

PROVIDERS = {"openai": None, "opencode": "deepseek-chat"}
RULES = [("eau|ç", "openai", "gpt-4o"), (r"\bthe\b", "opencode", "deepseek-chat")]
MODELS = ["openai", "opencode", "gpt-4o", "claude-haiku-4"]
OVERRIDES = {"click": 30, "error": 120, "signup": 0}
CHAINS = {"click": ["view", "error"], "error": ["view"]}
PROVIDER_MODELS = {"view": "gpt-4o-mini"}
TTL_SECONDS = 60


def _with_model(df: DataFrame) -> DataFrame:
    return df.withColumn("model", F.element_at(F.array(*map(F.lit, MODELS)), (F.col("conv_id") % 4 + 1).cast("int")))


def log(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "request_log")


def costed(spark: SparkSession, sf: str) -> DataFrame:
    return log(spark, sf).withColumn("cost", R.cost("model", "prompt_tokens", "completion_tokens"))


def route_requests(spark: SparkSession, sf: str) -> DataFrame:
    prompts = _with_model(R.first_user_text(table(spark, sf, "conversations"), "conv_id", "turn"))
    return R.route(prompts, PROVIDERS, RULES).select("conv_id", "provider", "routed_model")


def request_key(spark: SparkSession, sf: str) -> DataFrame:
    return R.message_key(_with_model(table(spark, sf, "conversations")), "conv_id", "model", "turn").select("conv_id", "request_key")


def request_key_of_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """The key from whole requests, messages as an array."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    whole = _with_model(table(spark, sf, "conversations")).groupBy("conv_id", "model").agg(turns.alias("messages"))
    return whole.select("conv_id", R.request_key("model", "messages").alias("request_key"))


def throttle(spark: SparkSession, sf: str) -> DataFrame:
    calls = log(spark, sf).select("event_id", "provider", "t_us")
    limited = O.throttle(calls, "provider", "t_us", "event_id", R.rpm_limit("provider", OVERRIDES))
    return limited.select("event_id", "provider", "allowed", F.round("retry_after", 6).alias("retry_after"))


def ttl_dedup(spark: SparkSession, sf: str) -> DataFrame:
    calls = log(spark, sf).select("event_id", "request_key", "t_us", "status")
    return O.ttl_dedup(calls, "request_key", "t_us", "event_id", F.col("status") == "success", TTL_SECONDS).select(
        "event_id", "request_key", "hit"
    )


def _own_ttl() -> Column:
    """A time to live for some requests; none and 0 mean the default."""
    return F.element_at(F.array(*[F.lit(x).cast("int") for x in (None, 0, 30, 600)]), (F.col("event_id") % 4 + 1).cast("int"))


def ttl_per_request(spark: SparkSession, sf: str) -> DataFrame:
    calls = log(spark, sf).select("event_id", "request_key", "t_us", "status")
    fills = F.col("status") == "success"
    return O.ttl_dedup(calls, "request_key", "t_us", "event_id", fills, _own_ttl(), default_seconds=TTL_SECONDS).select(
        "event_id", "request_key", "hit"
    )


def request_cost(spark: SparkSession, sf: str) -> DataFrame:
    return costed(spark, sf).select("event_id", "model", F.round("cost", 9).alias("cost"))


def cost_by_model(spark: SparkSession, sf: str) -> DataFrame:
    return R.usage(costed(spark, sf), "model")


def usage_report(spark: SparkSession, sf: str) -> DataFrame:
    return R.usage(costed(spark, sf), "provider", "model", "status")


def rpm_report(spark: SparkSession, sf: str) -> DataFrame:
    calls = log(spark, sf).withColumn("time", F.timestamp_micros("t_us"))
    return R.per_minute(calls, "time", "provider")


def resolve_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return R.resolve_fallback(derived(spark, sf, "attempts"), "request_id", "chain_pos", "ok", "provider", "model")


def fallback_attempts(spark: SparkSession, sf: str) -> DataFrame:
    calls = log(spark, sf).select("event_id", "provider", "model")
    return R.fallback_attempts(calls, CHAINS, PROVIDER_MODELS).select("event_id", "chain_pos", "try_provider", "try_model")


def _grants(spark: SparkSession, sf: str) -> DataFrame:
    """Keys and what they may use, taken from the log: half of the keys have grants."""
    seen = log(spark, sf).filter("api_key IS NOT NULL AND k % 20 < 10 AND k % 20 <> 7 AND k < 60").groupBy("api_key")
    return seen.agg(F.collect_set("provider").alias("providers"))


def access_check(spark: SparkSession, sf: str) -> DataFrame:
    return R.access_check(log(spark, sf), _grants(spark, sf)).select("event_id", "http_status")


def access_check_strict(spark: SparkSession, sf: str) -> DataFrame:
    grants = _grants(spark, sf).withColumn("providers", F.filter("providers", lambda p: p != "click"))
    return R.access_check(log(spark, sf), grants, provider="provider").select("event_id", "http_status")


def read_audit(spark: SparkSession, sf: str) -> DataFrame:
    parsed = A.parse_audit(derived(spark, sf, "audit_lines"))
    return parsed.select("event_id", "malformed", F.unix_micros("time").alias("time_us"), "client", "provider", "model", "status", "cost")


def write_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written in two appends, then read back."""
    calls = log(spark, sf).withColumn("cost", F.col("prompt_tokens") / 1000)
    line = A.audit_line(F.col("event_id").cast("string"), F.lit(None).cast("string"), F.col("provider"), F.col("model"), F.col("status"), F.col("cost"))
    path = scratch_path(spark, "audit")
    for part in ("success", "failed"):
        A.write_audit(calls.filter(F.col("status") == part).select(line.alias("value")), path)
    return spark.read.text(path)


def model_catalog(spark: SparkSession, sf: str) -> DataFrame:
    rules = log(spark, sf).select(F.col("event_id").alias("rule_no"), "provider", "model")
    none = rules.limit(0).select("provider", "model", F.col("rule_no").alias("place"))
    return R.model_catalog(rules, none)


def model_catalog_no_rules(spark: SparkSession, sf: str) -> DataFrame:
    providers = log(spark, sf).select(
        "provider", F.when(F.col("k") % 3 > 0, F.col("model")).alias("model"), F.col("event_id").alias("place")
    )
    return R.model_catalog(providers.limit(0).withColumnRenamed("place", "rule_no"), providers)


def purge_responses(spark: SparkSession, sf: str) -> DataFrame:
    stored = log(spark, sf).filter("status = 'success'")
    left, removed = R.purge(stored, "gpt-4o")
    return left.groupBy("model").agg(F.count("*").alias("n")).unionByName(
        removed.select(F.lit("(removed)").alias("model"), F.col("removed").alias("n"))
    )


def _items(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptions of all files with the outcome of some of them."""
    files = table(spark, sf, "documents").select("doc_id", "text")
    found = S.description_lines(files, "text", "doc_id")
    k = F.col("doc_id") + F.col("line_no")
    outcomes = found.filter(k % 4 < 3).select(
        "doc_id", "line_no", F.when(k % 4 == 0, "failed").otherwise("success").alias("status"),
        F.when(k % 4 == 0, F.concat(F.lit("provider error while generating flow "), F.col("doc_id").cast("string"))).alias("error"),
    )
    return C.batch_items(found, outcomes, ["doc_id", "line_no"])


def read_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    lines = derived(spark, sf, "description_lines").withColumnRenamed("line", "value")
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("file_line"), "value").select(
        "doc_id", "file_line", F.expr("trim(value)").alias("raw")
    ).transform(lambda d: S.description_lines(d, "raw", "doc_id", "file_line")).select("doc_id", "file_line", "description")


def read_description_files(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written to files and read by the reader; the file's own line number is left out."""
    lines = derived(spark, sf, "description_lines").select("doc_id", "line_no", F.expr("trim(line)").alias("line"))
    marked = F.when((F.col("line") == "") | F.col("line").startswith("#"), F.col("line")).otherwise(
        F.format_string("  %d:%d %s ", F.col("doc_id"), F.col("line_no").cast("bigint"), F.col("line"))
    )
    folder = scratch_path(spark, "descriptions")
    lines.select(marked.alias("value")).write.text(folder)
    return S.read_descriptions(spark, folder).select("description")


def first_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred descriptions of each file; a file holds one nation's customers."""
    folder = scratch_path(spark, "batches")
    people = table(spark, sf, "customer").select("c_nationkey", "c_custkey", F.concat_ws(" ", "c_name", "c_mktsegment").alias("value"))
    people.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey").drop("c_custkey").write.partitionBy("c_nationkey").text(folder)
    found = S.read_descriptions(spark, f"{folder}/c_nationkey=*", limit=100)
    return found.select(F.regexp_extract("path", "c_nationkey=([0-9]+)", 1).cast("bigint").alias("c_nationkey"), F.col("line_no").cast("bigint").alias("line_no"), "description")


def batch_items(spark: SparkSession, sf: str) -> DataFrame:
    return _items(spark, sf)


def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return C.status_summary(_items(spark, sf).withColumn("batch", F.col("doc_id") % 50), ["batch"])


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    calls = log(spark, sf).select(
        F.concat(F.lit("s"), F.floor(F.col("t_us") / 10_000_000).cast("string")).alias("started_at"),
        F.col("event_id").cast("string").alias("id"), F.concat_ws(" ", "request_key", F.repeat("model", F.lit(8))).alias("description"),
        "provider", "status", F.lit(None).cast("string").alias("path"), F.col("t_us").alias("timestamp"),
    )
    return S.session_history(calls).drop("path")


def session_history(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf)


def recent_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """History files written, then the latest five read."""
    folder = scratch_path(spark, "history")
    sessions = _sessions(spark, sf)
    S.write_sessions(sessions, folder)
    return S.recent_sessions(spark.read.schema(sessions.schema).json(folder)).select(*sessions.columns)


QUERIES = {
    f.__name__: f
    for f in (
        route_requests, request_key, request_key_of_arrays, throttle, ttl_dedup, ttl_per_request, request_cost, cost_by_model, usage_report, rpm_report,
        resolve_fallback, fallback_attempts, access_check, access_check_strict, read_audit, write_audit, model_catalog,
        model_catalog_no_rules, purge_responses, read_descriptions, read_description_files, first_descriptions, batch_items, batch_summary, session_history, recent_sessions,
    )
}

LOG = with_tables("request_log")
COST = """CASE model WHEN 'gpt-4o' THEN prompt_tokens * 0.0025 + completion_tokens * 0.01 WHEN 'gpt-4o-mini' THEN prompt_tokens * 0.00015 + completion_tokens * 0.0006
  WHEN 'claude-sonnet-4' THEN prompt_tokens * 0.003 + completion_tokens * 0.015 WHEN 'claude-haiku-4' THEN prompt_tokens * 0.00025 + completion_tokens * 0.00125
  WHEN 'deepseek-chat' THEN prompt_tokens * 0.00027 + completion_tokens * 0.0011 ELSE prompt_tokens * 0.001 + completion_tokens * 0.002 END"""
COSTED = f"{LOG}, costed AS (SELECT *, CAST({COST} AS DECIMAL(28,9)) / 1000 AS cost FROM request_log)"
_USAGE = """count(*) AS calls, CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, CAST(sum(completion_tokens) AS BIGINT) AS completion_tokens,
  CAST(sum(CAST(cost AS DECIMAL(28,9))) AS DOUBLE) AS cost"""

# One bucket per provider, replayed request by request with whole numbers:
# 60,000,000 units per token, rpm units per microsecond.
THROTTLE = f"""{LOG}, numbered AS (SELECT event_id, provider, t_us, row_number() OVER (PARTITION BY provider ORDER BY t_us, event_id) AS rn,
    CAST(CASE provider WHEN 'click' THEN 30 WHEN 'error' THEN 120 WHEN 'signup' THEN 0 ELSE 60 END AS HUGEINT) AS rpm FROM request_log),
replay(provider, rn, t_us, rpm, event_id, had, tokens) AS (
  SELECT provider, rn, t_us, rpm, event_id, rpm * 60000000, CASE WHEN rpm > 0 THEN (rpm - 1) * 60000000 ELSE 0 END FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.provider, n.rn, n.t_us, n.rpm, n.event_id, least(n.rpm * 60000000, r.tokens + (n.t_us - r.t_us) * n.rpm),
    CASE WHEN least(n.rpm * 60000000, r.tokens + (n.t_us - r.t_us) * n.rpm) >= 60000000
         THEN least(n.rpm * 60000000, r.tokens + (n.t_us - r.t_us) * n.rpm) - 60000000
         ELSE least(n.rpm * 60000000, r.tokens + (n.t_us - r.t_us) * n.rpm) END
  FROM replay r JOIN numbered n ON n.provider = r.provider AND n.rn = r.rn + 1)
SELECT event_id, provider, had >= 60000000 AND rpm > 0 AS allowed,
  CASE WHEN rpm = 0 THEN NULL WHEN had >= 60000000 THEN 0.0 ELSE round(CAST(60000000 - had AS DOUBLE) / CAST(rpm AS DOUBLE) / 1000000, 6) END AS retry_after FROM replay"""

TTL = f"""{LOG}, numbered AS (SELECT event_id, request_key, t_us, status, row_number() OVER (PARTITION BY request_key ORDER BY t_us, event_id) AS rn FROM request_log),
replay(request_key, rn, event_id, hit, made) AS (
  SELECT request_key, rn, event_id, false, CASE WHEN status = 'success' THEN t_us END FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.request_key, n.rn, n.event_id, coalesce(n.t_us <= r.made + {TTL_SECONDS * 1_000_000}, false),
    CASE WHEN coalesce(n.t_us <= r.made + {TTL_SECONDS * 1_000_000}, false) OR n.status <> 'success' THEN r.made ELSE n.t_us END
  FROM replay r JOIN numbered n ON n.request_key = r.request_key AND n.rn = r.rn + 1)
SELECT event_id, request_key, hit FROM replay"""

OWN_TTL = f"""{LOG}, numbered AS (SELECT event_id, request_key, t_us, status, row_number() OVER (PARTITION BY request_key ORDER BY t_us, event_id) AS rn,
    CASE event_id % 4 WHEN 2 THEN 30 WHEN 3 THEN 600 ELSE {TTL_SECONDS} END * 1000000 AS ttl FROM request_log),
replay(request_key, rn, event_id, hit, expires) AS (
  SELECT request_key, rn, event_id, false, CASE WHEN status = 'success' THEN t_us + ttl END FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.request_key, n.rn, n.event_id, coalesce(n.t_us <= r.expires, false),
    CASE WHEN coalesce(n.t_us <= r.expires, false) OR n.status <> 'success' THEN r.expires ELSE n.t_us + n.ttl END
  FROM replay r JOIN numbered n ON n.request_key = r.request_key AND n.rn = r.rn + 1)
SELECT event_id, request_key, hit FROM replay"""

_MODEL = "CASE conv_id % 4 WHEN 0 THEN 'openai' WHEN 1 THEN 'opencode' WHEN 2 THEN 'gpt-4o' ELSE 'claude-haiku-4' END"
_GRANTED = "SELECT DISTINCT api_key FROM request_log WHERE api_key IS NOT NULL AND k % 20 < 10 AND k % 20 <> 7 AND k < 60"
_ITEMS = """items AS (SELECT doc_id, line_no, line AS description, (doc_id + line_no) % 4 AS k FROM (
    SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(13)) AS line FROM (SELECT doc_id, i - 1 AS line_no, parts[i] AS line FROM (
      SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))))
    WHERE line <> '' AND line NOT LIKE '#%')"""
_SESSION = f"""{LOG}, s AS (SELECT *, concat('s', CAST(floor(t_us / 10000000) AS BIGINT)) AS started_at FROM request_log),
    c AS (SELECT started_at, count(*) AS flow_count, count(*) FILTER (status = 'success') AS success_count FROM s GROUP BY 1)
    SELECT started_at, flow_count, success_count, t_us AS timestamp, CAST(event_id AS VARCHAR) AS id, concat(request_key, ' ', repeat(model, 8)) AS description,
    substr(concat(request_key, ' ', repeat(model, 8)), 1, 80) AS description_short, provider, status FROM s JOIN c USING (started_at)"""

ORACLE = {
    "route_requests": rf"""WITH p AS (SELECT conv_id, {_MODEL} AS model, coalesce(min_by(text, turn) FILTER (role = 'user'), '') AS prompt FROM conversations GROUP BY conv_id)
        SELECT conv_id, CASE WHEN model IN ('openai', 'opencode') THEN model WHEN regexp_matches(prompt, '(?i)eau|ç') THEN 'openai'
            WHEN regexp_matches(prompt, '(?i)\bthe\b') THEN 'opencode' ELSE 'openai' END AS provider,
          CASE WHEN model = 'openai' THEN 'openai' WHEN model = 'opencode' THEN 'deepseek-chat' WHEN regexp_matches(prompt, '(?i)eau|ç') THEN 'gpt-4o'
            WHEN regexp_matches(prompt, '(?i)\bthe\b') THEN 'deepseek-chat' ELSE model END AS routed_model FROM p""",
    "request_key": f"""WITH n AS (SELECT conv_id, {_MODEL} AS model, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS n FROM conversations),
        d AS (SELECT conv_id, model, sha256(concat_ws('|', n, coalesce(length(role), -1), coalesce(length(text), -1), coalesce(role, ''), coalesce(text, ''))) AS h FROM n)
        SELECT conv_id, sha256(concat_ws('|', length(model), model, count(*), """
    + ", ".join(f"CAST(sum(CAST(concat('0x', substr(h, {1 + 15 * i}, 15)) AS HUGEINT)) AS VARCHAR)" for i in range(4))
    + ")) AS request_key FROM d GROUP BY conv_id, model",
    "throttle": THROTTLE,
    "ttl_dedup": TTL,
    "ttl_per_request": OWN_TTL,
    "request_cost": f"{COSTED} SELECT event_id, model, CAST(CAST(cost AS DECIMAL(28,9)) AS DOUBLE) AS cost FROM costed",
    "cost_by_model": f"{COSTED} SELECT model, {_USAGE} FROM costed GROUP BY model",
    "usage_report": f"{COSTED} SELECT provider, model, status, {_USAGE} FROM costed GROUP BY ALL",
    "rpm_report": f"{LOG} SELECT provider, CAST(floor(t_us / 60000000) AS BIGINT) * 60000000 AS minute_us, count(*) AS requests FROM request_log GROUP BY ALL",
    "resolve_fallback": f"""{with_tables('attempts')} SELECT request_id, CASE WHEN bool_or(ok) THEN 'success' ELSE 'failed' END AS status,
        min(chain_pos) FILTER (ok) AS chain_pos, min_by(provider, chain_pos) FILTER (ok) AS provider, min_by(model, chain_pos) FILTER (ok) AS model, count(*) AS tries
        FROM attempts GROUP BY request_id""",
    "fallback_attempts": f"""{LOG} SELECT event_id, CAST(0 AS INT) AS chain_pos, provider AS try_provider, model AS try_model FROM request_log
        UNION ALL SELECT event_id, 1, 'view', 'gpt-4o-mini' FROM request_log WHERE provider IN ('click', 'error')
        UNION ALL SELECT event_id, 2, 'error', model FROM request_log WHERE provider = 'click'""",
    "access_check": f"""{LOG} SELECT event_id, CASE WHEN api_key IS NULL THEN 401 WHEN api_key IN ({_GRANTED}) THEN 200 ELSE 403 END AS http_status FROM request_log""",
    "access_check_strict": f"""{LOG}, g AS (SELECT DISTINCT api_key, provider FROM request_log WHERE api_key IS NOT NULL AND k % 20 < 10 AND k % 20 <> 7 AND k < 60 AND provider <> 'click')
        SELECT event_id, CASE WHEN r.api_key IS NULL THEN 401 WHEN EXISTS (SELECT 1 FROM g WHERE g.api_key = r.api_key AND g.provider = r.provider) THEN 200 ELSE 403 END AS http_status
        FROM request_log r""",
    "read_audit": """SELECT event_id, event_id % 23 = 0 AS malformed, CASE WHEN event_id % 23 > 0 THEN epoch_us(ts) END AS time_us,
        CASE WHEN event_id % 23 > 0 THEN concat('10.0.0.', user_id % 250) END AS client, CASE WHEN event_id % 23 > 0 THEN event_type END AS provider,
        CASE WHEN event_id % 23 > 0 THEN concat('model-', k % 7) END AS model, CASE WHEN event_id % 23 > 0 THEN CASE WHEN k % 9 = 0 THEN 'failed' ELSE 'success' END END AS status,
        CASE WHEN event_id % 23 > 0 THEN CAST(CAST((event_id * 7919) % 3000000 AS DECIMAL(18,6)) / 1000000 AS DOUBLE) END AS cost
        FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
    "write_audit": f"""{LOG} SELECT concat(event_id, ' | - | ', provider, '/', model, ' | ', status, ' | cost=$', printf('%.6f', prompt_tokens / 1000)) AS value FROM request_log""",
    "model_catalog": f"{LOG} SELECT provider, model, min(event_id) AS place, concat(provider, '/', model) AS id FROM request_log GROUP BY provider, model",
    "model_catalog_no_rules": f"""{LOG}, p AS (SELECT provider, CASE WHEN k % 3 > 0 THEN model ELSE 'gpt-4o' END AS model, event_id FROM request_log)
        SELECT provider, model, min(event_id) AS place, concat(provider, '/', model) AS id FROM p GROUP BY provider, model""",
    "purge_responses": f"""{LOG} SELECT CASE WHEN model = 'gpt-4o' THEN '(removed)' ELSE model END AS model, count(*) AS n FROM request_log WHERE status = 'success' GROUP BY 1""",
    "read_descriptions": f"""{with_tables('description_lines')} SELECT doc_id, CAST(line_no AS BIGINT) AS file_line, trim(line, ' ' || chr(9) || chr(13)) AS description
        FROM description_lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> '' AND trim(line, ' ' || chr(9) || chr(13)) NOT LIKE '#%'""",
    "batch_items": f"""WITH {_ITEMS} SELECT doc_id, CAST(line_no AS INT) AS line_no, description, CASE WHEN length(description) > 50 THEN concat(substr(description, 1, 50), '...') ELSE description END AS description_short,
        CASE WHEN k = 0 THEN concat('provider error while generating flow ', doc_id) END AS error,
        CASE WHEN k IN (1, 2) THEN 'success' ELSE 'failed' END AS status, CASE WHEN k IN (1, 2) THEN 'success' WHEN k = 0 THEN 'failed: provider error while generatin' ELSE 'failed' END AS status_text FROM items""",
    "batch_summary": f"WITH {_ITEMS} SELECT doc_id % 50 AS batch, count(*) AS total, count(*) FILTER (k IN (1, 2)) AS successful FROM items GROUP BY 1",
    "session_history": _SESSION,
    "recent_sessions": f"SELECT * FROM ({_SESSION}) QUALIFY dense_rank() OVER (ORDER BY started_at DESC) <= 5",
}

ORACLE["request_key_of_arrays"] = ORACLE["request_key"]

ORACLE["read_description_files"] = f"""{with_tables('description_lines')} SELECT concat(doc_id, ':', line_no, ' ', line) AS description
    FROM (SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(13)) AS line FROM description_lines) WHERE line <> '' AND line NOT LIKE '#%'"""
ORACLE["first_descriptions"] = """SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS line_no,
    concat(c_name, ' ', c_mktsegment) AS description FROM customer QUALIFY line_no < 100"""
