"""Flow documents, step graphs and prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog.derived import derived, table, with_tables
from flowspark.catalog.evaluation import GATED, gated
from flowspark.functions import text as X
from flowspark.operators import corpus as C
from flowspark.operators import evaluation as E
from flowspark.operators import graph as G
from flowspark.operators import lint as L
from flowspark.session import scratch_path
from flowspark.sources import flows as S


def steps(spark: SparkSession, sf: str) -> DataFrame:
    df = derived(spark, sf, "flow_steps")
    empty = F.array().cast("array<string>")
    return df.withColumn("parents", F.when(F.col("parents") == "", empty).otherwise(F.split("parents", ",")))


def stored_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The step table written once, for operators that read it several times."""
    return G.stored(steps(spark, sf))


def extract_json(spark: SparkSession, sf: str) -> DataFrame:
    return derived(spark, sf, "responses").select("flow", X.json_object("response").alias("json"))


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return C.parse_flows(derived(spark, sf, "responses"))


def parse_flows(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).select(
        "flow", "status", "truncated", "reason", F.col("document.name").alias("name"),
        F.size("document.steps").cast("bigint").alias("n_steps"),
        F.array_join(F.transform("document.steps", lambda s: F.concat_ws("/", s["name"], s["order"].cast("string"), s["output"]["tempView"])), ",").alias("steps"),
    )


def parse_status(spark: SparkSession, sf: str) -> DataFrame:
    return _parsed(spark, sf).groupBy("status", "truncated").agg(F.count("*").alias("n"))


def flow_edges(spark: SparkSession, sf: str) -> DataFrame:
    return G.edges(stored_steps(spark, sf))


def step_levels(spark: SparkSession, sf: str) -> DataFrame:
    return G.step_levels(stored_steps(spark, sf)).drop("pos")


def order_diff(spark: SparkSession, sf: str) -> DataFrame:
    s = stored_steps(spark, sf)
    return G.order_diff(s, G.step_levels(s)).drop("pos")


def optimize_flows(spark: SparkSession, sf: str) -> DataFrame:
    parsed = C.parse_flows(derived(spark, sf, "flow_docs"), "doc").filter("status = 'ok'")
    docs = G.stored(parsed.select("flow", "document"))
    out = G.optimize_flows(docs, C.flow_steps(docs))
    label = lambda s: F.concat_ws(":", s["name"], s["order"].cast("string"))
    return out.select("flow", "changed", F.array_join(F.transform("document.steps", label), ",").alias("steps"))


def fan_out(spark: SparkSession, sf: str) -> DataFrame:
    return G.fan_out(stored_steps(spark, sf))


def flow_step_listing(spark: SparkSession, sf: str) -> DataFrame:
    return C.step_listing(steps(spark, sf))


def flow_variables(spark: SparkSession, sf: str) -> DataFrame:
    return C.flow_variables(steps(spark, sf))


def step_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return L.step_sources(stored_steps(spark, sf))


def target_lineage(spark: SparkSession, sf: str) -> DataFrame:
    return L.target_lineage(stored_steps(spark, sf))


def step_reads(spark: SparkSession, sf: str) -> DataFrame:
    return L.view_reads(stored_steps(spark, sf))


def build_eval_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The typed flow of every valid answer, written as JSON again."""
    docs = _parsed(spark, sf).filter("status = 'ok'")
    note = F.when(F.col("flow") % 2 == 0, F.concat(F.lit("orders of "), F.col("flow").cast("string")))
    return docs.select("flow", C.evaluation_prompt(C.flow_json("document"), note).alias("prompt"))


def tune_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """Feedback for judged flows, retry text for answers that did not parse."""
    asked = F.col("flow").cast("string")
    parsed = _parsed(spark, sf).filter("status <> 'ok'")
    again = parsed.select("flow", C.retry_prompt(C.generation_prompt(asked), F.col("reason")).alias("prompt"))
    tuned = C.tuning_rounds(gated(spark, sf), asked, E.THRESHOLD)
    return again.unionByName(tuned.select("flow", C.generation_prompt("description").alias("prompt")))


def safe_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", X.safe_name(F.concat_ws("/", "p_name", "p_type")).alias("safe"))


def stored_flows(spark: SparkSession, sf: str) -> DataFrame:
    """Valid documents written as JSON and read again."""
    folder = scratch_path(spark, "flows")
    docs = _parsed(spark, sf).filter("status = 'ok'").withColumn("asked", F.concat(F.lit("orders of "), F.col("flow").cast("string")))
    S.write_flows(docs, folder, description="asked")
    return S.read_written(spark, folder).select(
        "name", F.col("business_description").alias("asked"), "safe_name", F.size("steps").cast("bigint").alias("n_steps"), F.get("steps", F.lit(0))["sql"].isNotNull().alias("has_sql")
    )


def classify_errors(spark: SparkSession, sf: str) -> DataFrame:
    texts = [
        "the API key is blank", "refused with 401", "host does not connect", "TIMEOUT after 30 s",
        "connection to the Gateway lost", "out of memory",
    ]
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    error = F.element_at(F.array(*map(F.lit, texts)), k % len(texts) + 1)
    provider = F.when(k % 4 == 0, "gateway").otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", F.coalesce(X.error_class(error, provider), F.lit("none")).alias("error_class"))


QUERIES = {
    f.__name__: f
    for f in (
        extract_json, parse_flows, parse_status, flow_edges, step_levels, order_diff, optimize_flows, fan_out,
        flow_step_listing, flow_variables, step_lineage, target_lineage, step_reads, safe_names, stored_flows, build_eval_prompts, tune_prompts,
        classify_errors,
    )
}

STEPS = with_tables("flow_steps")

EDGES = """, pairs AS (SELECT DISTINCT flow, unnest(string_split(parents, ',')) AS parent, name AS child FROM flow_steps WHERE parents <> ''),
edges AS (SELECT p.flow, p.parent, p.child, s.name IS NOT NULL AS known FROM pairs p
          LEFT JOIN flow_steps s ON p.flow = s.flow AND p.parent = s.name)"""

LEVELS = EDGES + """, bad(flow, name) AS (
  SELECT flow, child FROM edges WHERE NOT known
  UNION SELECT c.flow, c.name FROM closure c WHERE c.name = c.up
  UNION SELECT e.flow, e.child FROM bad b JOIN edges e ON b.flow = e.flow AND b.name = e.parent),
closure(flow, name, up) AS (
  SELECT flow, child, parent FROM edges WHERE known
  UNION SELECT c.flow, e.child, c.up FROM closure c JOIN edges e ON c.flow = e.flow AND c.name = e.parent)"""
# the closure has to come before what reads it
_head, _tail = LEVELS.split(", bad(flow, name) AS (")
_bad, _closure = _tail.split("closure(flow, name, up) AS (")
CLOSURE = _head + ", closure(flow, name, up) AS (" + _closure
LEVELS = CLOSURE + ", bad(flow, name) AS (" + _bad.rstrip().rstrip(",") + """, paths(flow, name, level) AS (
  SELECT flow, name, 0 FROM flow_steps WHERE parents = ''
  UNION SELECT p.flow, e.child, p.level + 1 FROM paths p JOIN edges e ON p.flow = e.flow AND p.name = e.parent
        WHERE NOT EXISTS (SELECT 1 FROM bad b WHERE b.flow = e.flow AND b.name = e.child)),
good AS (SELECT flow, name, max(level) AS level FROM paths GROUP BY flow, name),
levels AS (
  SELECT flow, name, CAST(level AS BIGINT) AS level, true AS placed FROM good
  UNION ALL
  SELECT s.flow, s.name, CAST(coalesce((SELECT max(level) FROM good g WHERE g.flow = s.flow), 0)
         + row_number() OVER (PARTITION BY s.flow ORDER BY s.pos) AS BIGINT), false
  FROM flow_steps s WHERE NOT EXISTS (SELECT 1 FROM good g WHERE g.flow = s.flow AND g.name = s.name))"""

READS = r""", words AS (SELECT flow, name AS step, unnest(list_distinct(regexp_extract_all(lower(sql_text), '[a-z_][a-z0-9_]*'))) AS w FROM flow_steps),
reads AS (SELECT DISTINCT w.flow, w.step, w.w AS view, s.name AS owner FROM words w
          JOIN flow_steps s ON w.flow = s.flow AND w.w = lower(s.temp_view) WHERE s.name <> w.step)"""

STRIPPED = r"""SELECT flow, response, trim(response, ' ' || chr(10) || chr(9) || chr(13)) AS t FROM responses"""
EXTRACTED = rf"""SELECT flow, response, t, nullif(regexp_extract(CASE WHEN t LIKE '%```%```%' THEN regexp_extract(t, '```(?:json)?\s*\n?([\s\S]*?)\n?```', 1) ELSE t END,
   '\{{[\s\S]*\}}'), '') AS json FROM ({STRIPPED})"""
PARSED = rf"""SELECT flow, response, json, CASE WHEN json IS NULL THEN 'no_json' WHEN j IS NULL THEN 'bad_json'
   WHEN json_type(j, '$.name') = 'VARCHAR' AND json_type(j, '$.steps') = 'ARRAY' AND len(list_filter(CAST(json_extract(j, '$.steps[*]') AS JSON[]), lambda s:
        json_type(s, '$.name') = 'VARCHAR' AND json_type(s, '$.sql') = 'VARCHAR' AND json_type(s, '$.output.tempView') = 'VARCHAR'
        AND regexp_full_match(coalesce(json_extract_string(s, '$.order'), ''), '[0-9]+')
        AND json_type(s, '$.diagram.x') IN ('UBIGINT', 'BIGINT') AND json_type(s, '$.createdDate') = 'OBJECT')) = json_array_length(j, '$.steps') THEN 'ok'
   ELSE 'invalid_flow' END AS status, j FROM (SELECT *, CASE WHEN json_valid(json) THEN CAST(json AS JSON) END AS j FROM ({EXTRACTED}))"""

_FAILING = """coalesce(CASE WHEN coalesce(json_type(j, '$.name'), '') <> 'VARCHAR' THEN 'name: text expected' WHEN coalesce(json_type(j, '$.steps'), '') <> 'ARRAY' THEN 'steps: a list of steps expected' END,
   list_filter(list_transform(CAST(json_extract(j, '$.steps[*]') AS JSON[]), lambda s, i: concat('steps[', i - 1, '].',
     CASE WHEN coalesce(json_type(s, '$.name'), '') <> 'VARCHAR' THEN 'name: text'
          WHEN NOT regexp_full_match(coalesce(json_extract_string(s, '$.order'), ''), '[0-9]+') THEN 'order: a whole number'
          WHEN coalesce(json_type(s, '$.sql'), '') <> 'VARCHAR' THEN 'sql: text' WHEN coalesce(json_type(s, '$.output.tempView'), '') <> 'VARCHAR' THEN 'output.tempView: text'
          WHEN coalesce(json_type(s, '$.diagram.x'), '') NOT IN ('UBIGINT', 'BIGINT') THEN 'diagram.x: a whole number'
          WHEN coalesce(json_type(s, '$.createdDate'), '') <> 'OBJECT' THEN 'createdDate: a time under $date' ELSE '-' END, ' expected')), lambda r: r NOT LIKE '%.- expected')[1])"""
REASON = f"""CASE status WHEN 'no_json' THEN concat('no JSON object found', CASE WHEN response LIKE '%{{%' THEN '; the answer seems to be cut off' ELSE '' END)
   WHEN 'bad_json' THEN 'not one valid JSON object' WHEN 'invalid_flow' THEN {_FAILING} END"""

ORACLE = {
    "extract_json": f"{with_tables('responses')} SELECT flow, json FROM ({EXTRACTED})",
    "parse_flows": f"""{with_tables('responses')}, p AS MATERIALIZED ({PARSED})
        SELECT flow, status, status = 'no_json' AND response LIKE '%{{%' AS truncated, {REASON} AS reason,
          CASE WHEN status = 'ok' THEN json_extract_string(j, '$.name') END AS name,
          CASE WHEN status = 'ok' THEN CAST(json_array_length(j, '$.steps') AS BIGINT) END AS n_steps,
          CASE WHEN status = 'ok' THEN array_to_string(list_transform(CAST(json_extract(j, '$.steps[*]') AS JSON[]), lambda s:
             concat(json_extract_string(s, '$.name'), '/', json_extract_string(s, '$.order'), '/', json_extract_string(s, '$.output.tempView'))), ',') END AS steps
        FROM p""",
    "parse_status": f"""{with_tables('responses')}, p AS MATERIALIZED ({PARSED})
        SELECT status, status = 'no_json' AND response LIKE '%{{%' AS truncated, count(*) AS n FROM p GROUP BY ALL""",
    "flow_edges": f"{STEPS}{EDGES} SELECT flow, parent, child, known FROM edges",
    "step_levels": f"{STEPS}{LEVELS} SELECT flow, name, level, placed FROM levels",
    "order_diff": f"""{STEPS}{LEVELS} SELECT s.flow, s.name, s.ord AS old_order, l.level AS new_order, s.ord <> l.level AS changed
        FROM flow_steps s JOIN levels l ON s.flow = l.flow AND s.name = l.name""",
    "optimize_flows": f"""{STEPS}{LEVELS} SELECT s.flow, bool_or(s.ord <> l.level) AS changed,
        CASE WHEN bool_or(s.ord <> l.level) THEN string_agg(concat(s.name, ':', l.level), ',' ORDER BY l.level, s.pos)
             ELSE string_agg(concat(s.name, ':', s.ord), ',' ORDER BY s.pos) END AS steps
        FROM flow_steps s JOIN levels l ON s.flow = l.flow AND s.name = l.name GROUP BY s.flow""",
    "fan_out": f"""{STEPS}{EDGES} SELECT flow, parent AS step, count(*) AS children,
        concat('Step ''', parent, ''' feeds ', count(*), ' downstream steps. Consider splitting into intermediate temp views to enable more parallel execution of dependent branches.') AS detail
        FROM edges WHERE known GROUP BY flow, parent HAVING count(*) > 3""",
    "flow_step_listing": f"""{STEPS} SELECT flow, ord, name, concat(CASE WHEN parents <> '' THEN '  ' ELSE '' END, '[', ord, '] ', name, ' ',
        CASE WHEN parents <> '' THEN concat('(depends on: ', replace(parents, ',', ', '), ')') ELSE '' END) AS line,
        sql_text, CASE WHEN length(sql_text) > 120 THEN concat(substr(sql_text, 1, 120), '...') ELSE sql_text END AS sql_preview FROM flow_steps""",
    "flow_variables": f"""{STEPS} SELECT DISTINCT flow, name AS step, 'table' AS kind, unnest(regexp_extract_all(sql_text, '\\$\\{{(\\w+)\\}}', 1)) AS variable FROM flow_steps
        UNION ALL SELECT DISTINCT flow, name, 'parameter', unnest(regexp_extract_all(sql_text, '\\$\\[(\\w+)\\]', 1)) FROM flow_steps""",
    "step_lineage": f"""{STEPS}{CLOSURE}, own AS (SELECT DISTINCT flow, name, unnest(regexp_extract_all(sql_text, '\\$\\{{(\\w+)\\}}', 1)) AS source FROM flow_steps),
        both_ AS (SELECT flow, name, source, true AS direct FROM own
                  UNION ALL SELECT c.flow, c.name, o.source, false FROM closure c JOIN own o ON c.flow = o.flow AND c.up = o.name)
        SELECT flow, name AS step, source, bool_or(direct) AS direct FROM both_ GROUP BY ALL""",
    "target_lineage": f"""{STEPS}{CLOSURE}, w AS (SELECT flow, name, concat(target_table, '.', name) AS target FROM flow_steps WHERE target_table <> '')
        SELECT flow, target, name AS step FROM w UNION SELECT c.flow, w.target, c.up FROM closure c JOIN w ON c.flow = w.flow AND c.name = w.name""",
    "step_reads": f"{STEPS}{READS} SELECT flow, step, view, owner FROM reads",
    "build_eval_prompts": f"""{with_tables('flow_docs', 'responses')}, p AS MATERIALIZED ({PARSED}) SELECT flow, concat('Evaluate the following Spark SQL ETL flow:', chr(10), chr(10), '```json', chr(10), doc, chr(10), '```',
        CASE WHEN flow % 2 = 0 THEN concat(chr(10), chr(10), 'Original business description (use to verify correctness and completeness):', chr(10), chr(10), 'orders of ', flow) ELSE '' END) AS prompt
        FROM flow_docs SEMI JOIN (SELECT flow FROM p WHERE status = 'ok') USING (flow)""",
    "tune_prompts": f"""{with_tables('responses', 'evaluations')}, p AS MATERIALIZED ({PARSED}), g AS MATERIALIZED ({GATED})
        SELECT flow, concat('Generate a Spark SQL ETL flow for the following business requirement:', chr(10), chr(10), flow, chr(10), chr(10),
          'Respond with ONLY the JSON flow definition. No extra text.', chr(10), chr(10), '---', chr(10), 'The previous response was NOT valid JSON. Error: ', {REASON}, chr(10),
          'Fix the JSON syntax and respond with ONLY the JSON object — no explanations, no markdown, no code fences.', chr(10)) AS prompt
        FROM p WHERE status <> 'ok'
        UNION ALL SELECT flow, concat('Generate a Spark SQL ETL flow for the following business requirement:', chr(10), chr(10), flow,
          string_agg(told, '') OVER (PARTITION BY flow ORDER BY iteration, feedback ROWS UNBOUNDED PRECEDING), chr(10), chr(10),
          'Respond with ONLY the JSON flow definition. No extra text.')
        FROM (SELECT DISTINCT flow, iteration, feedback, concat(chr(10), chr(10), '---', chr(10), 'Feedback from previous evaluation (score < 8.5/10):', chr(10), feedback,
          chr(10), chr(10), 'Please address the feedback above and regenerate an improved Spark SQL flow.') AS told FROM g WHERE NOT passed AND flow IS NOT NULL)""",
    "classify_errors": """SELECT event_id, CASE k % 6 WHEN 0 THEN 'api_key' WHEN 1 THEN 'authentication' WHEN 4 THEN 'gateway' WHEN 5 THEN 'none'
          ELSE CASE WHEN k % 4 = 0 THEN 'gateway' ELSE 'connection' END END AS error_class
        FROM (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events)""",
}

ORACLE["safe_names"] = "SELECT p_partkey, translate(concat(p_name, '/', p_type), ' /' || chr(92), '___') AS safe FROM part"
ORACLE["stored_flows"] = f"""SELECT name, concat('orders of ', flow) AS asked, concat(translate(name, ' /' || chr(92), '___'), '_flow') AS safe_name, n_steps, n_steps > 0 AS has_sql
    FROM ({ORACLE['parse_flows']}) WHERE status = 'ok'"""
