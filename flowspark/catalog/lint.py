"""One query per lint rule, and the count of findings per rule."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog.corpus import CLOSURE, EDGES, LEVELS, READS, STEPS, steps, stored_steps
from flowspark.operators import lint as L

RULES = [
    "duplicate_step", "unknown_parent", "cycle", "orphan_step", "view_not_upstream", "unread_parent",
    "order_not_after_parent", "trunc_function", "left_join_is_null", "select_star", "hint", "hardcoded_table",
    "step_prefix", "flow_name_case", "view_name_mismatch", "early_target", "single_step", "lowercase_keyword",
    "repeated_null_filter", "inactive_parent", "repeated_source", "unsafe_aggregate", "no_description",
    "columns_on_one_line",
]


def _renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Step table with some names doubled and some outside the naming rule, which
    the plain one has none of."""
    s = steps(spark, sf)
    name = F.when(F.col("flow") % 9 == 1, F.regexp_replace("name", "[0-9]+", "X")).when(
        F.col("flow") % 9 == 2, F.concat(F.lit("PROCESS_"), F.col("name"))
    )
    return s.withColumn("name", F.coalesce(name, F.col("name")))


def _rule(rule: str, spark: SparkSession, sf: str) -> DataFrame:
    source = _renamed if rule in ("duplicate_step", "step_prefix") else stored_steps if rule in L.GRAPH_RULES else steps
    return L.lint(source(spark, sf), [rule])


def lint_summary(spark: SparkSession, sf: str) -> DataFrame:
    return L.lint(stored_steps(spark, sf)).groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("flow").alias("n_flows"))


QUERIES = {f"lint_{rule}": partial(_rule, rule) for rule in RULES}
QUERIES["lint_summary"] = lint_summary

RENAMED = """, renamed AS (SELECT * REPLACE (CASE WHEN flow % 9 = 1 THEN regexp_replace(name, '[0-9]+', 'X')
  WHEN flow % 9 = 2 THEN concat('PROCESS_', name) ELSE name END AS name) FROM flow_steps)"""

NOT_NULL = r"""SELECT DISTINCT flow, name, lower(unnest(regexp_extract_all(sql_text, '(?i)(\w+)\s+IS\s+NOT\s+NULL', 1))) AS fact FROM flow_steps"""
SOURCES = r"""SELECT DISTINCT flow, name, unnest(regexp_extract_all(sql_text, '\$\{(\w+)\}', 1)) AS fact FROM flow_steps"""
SUMMED = r"""SELECT DISTINCT flow, name, lower(unnest(regexp_extract_all(sql_text, '(?i)\b(?:SUM|AVG)\(\s*(?:\w+\.)?(\w+)\s*\)', 1))) AS fact FROM flow_steps"""

# Rule → (further tables, SELECT of flow, step, detail)
BODIES = {
    "duplicate_step": (RENAMED, "SELECT flow, name AS step, CAST(count(*) AS VARCHAR) AS detail FROM renamed GROUP BY flow, name HAVING count(*) > 1"),
    "unknown_parent": (EDGES, "SELECT flow, child AS step, parent AS detail FROM edges WHERE NOT known"),
    "cycle": (CLOSURE, """SELECT DISTINCT s.flow, s.name AS step, 'on or behind a cycle' AS detail FROM flow_steps s JOIN closure c ON s.flow = c.flow AND s.name = c.name
        WHERE EXISTS (SELECT 1 FROM closure k WHERE k.flow = c.flow AND k.name = k.up AND (k.name = c.up OR k.name = c.name))"""),
    "orphan_step": (EDGES, """SELECT s.flow, s.name AS step, 'no parents and no children' AS detail FROM flow_steps s WHERE parents = ''
        AND NOT EXISTS (SELECT 1 FROM edges e WHERE e.flow = s.flow AND e.parent = s.name)
        AND (SELECT count(*) FROM flow_steps o WHERE o.flow = s.flow) > 1"""),
    "view_not_upstream": (CLOSURE + READS, """SELECT r.flow, r.step, r.view AS detail FROM reads r
        WHERE NOT EXISTS (SELECT 1 FROM closure c WHERE c.flow = r.flow AND c.name = r.step AND c.up = r.owner)"""),
    "unread_parent": (EDGES + READS, """SELECT e.flow, e.child AS step, e.parent AS detail FROM edges e WHERE known
        AND NOT EXISTS (SELECT 1 FROM reads r WHERE r.flow = e.flow AND r.step = e.child AND r.owner = e.parent)"""),
    "order_not_after_parent": (EDGES, """SELECT e.flow, e.child AS step, e.parent AS detail FROM edges e
        JOIN flow_steps p ON e.flow = p.flow AND e.parent = p.name JOIN flow_steps c ON e.flow = c.flow AND e.child = c.name WHERE c.ord <= p.ord"""),
    "trunc_function": ("", r"SELECT flow, name AS step, 'use DATE_TRUNC or DATE_FORMAT' AS detail FROM flow_steps WHERE regexp_matches(sql_text, '(?i)\bTRUNC\s*\(')"),
    "left_join_is_null": ("", r"SELECT flow, name AS step, 'use LEFT ANTI JOIN' AS detail FROM flow_steps WHERE regexp_matches(sql_text, '(?is)LEFT\s+(OUTER\s+)?JOIN\b.*\bIS\s+NULL\b')"),
    "select_star": ("", "SELECT flow, name AS step, 'list the columns' AS detail FROM flow_steps WHERE upper(sql_text) LIKE '%SELECT *%' AND name NOT LIKE 'SAVE\\_%' ESCAPE '\\'"),
    "hint": ("", "SELECT flow, name AS step, 'BROADCAST' AS detail FROM flow_steps WHERE sql_text LIKE '%/*+%'"),
    "hardcoded_table": ("", r"""SELECT t.flow, t.step, t.target AS detail FROM (
        SELECT DISTINCT flow, name AS step, unnest(regexp_extract_all(sql_text, '(?i)\b(?:FROM|JOIN)\s+([A-Za-z_][A-Za-z0-9_.]*)', 1)) AS target FROM flow_steps) t
        WHERE NOT EXISTS (SELECT 1 FROM flow_steps s WHERE s.flow = t.flow AND lower(s.temp_view) = lower(t.target))"""),
    "step_prefix": (RENAMED, "SELECT flow, name AS step, name AS detail FROM renamed WHERE name LIKE 'PROCESS%'"),
    "flow_name_case": ("", "SELECT DISTINCT flow, '' AS step, flow_name AS detail FROM flow_steps WHERE flow_name LIKE 'flow %'"),
    "view_name_mismatch": ("", "SELECT flow, name AS step, temp_view AS detail FROM flow_steps WHERE temp_view <> name"),
    "early_target": (EDGES, """SELECT s.flow, s.name AS step, target_table AS detail FROM flow_steps s WHERE target_table <> ''
        AND (left(name, 5) <> 'SAVE_' OR EXISTS (SELECT 1 FROM edges e WHERE e.flow = s.flow AND e.parent = s.name))"""),
    "single_step": ("", "SELECT flow, '' AS step, '' AS detail FROM flow_steps GROUP BY flow HAVING count(*) = 1"),
    "lowercase_keyword": ("", r"SELECT flow, name AS step, 'write keywords in upper case' AS detail FROM flow_steps WHERE regexp_matches(sql_text, '\b(select|from|where|join)\b')"),
    "repeated_null_filter": (CLOSURE + f", own AS ({NOT_NULL})", """SELECT DISTINCT o.flow, o.name AS step, o.fact AS detail FROM own o
        JOIN closure c ON o.flow = c.flow AND o.name = c.name JOIN own u ON c.flow = u.flow AND c.up = u.name AND u.fact = o.fact"""),
    "inactive_parent": (EDGES, """SELECT e.flow, e.child AS step, e.parent AS detail FROM edges e
        JOIN flow_steps p ON e.flow = p.flow AND e.parent = p.name JOIN flow_steps c ON e.flow = c.flow AND e.child = c.name WHERE NOT p.active AND c.active"""),
    "repeated_source": (CLOSURE + f", own AS ({SOURCES})", """SELECT DISTINCT o.flow, o.name AS step, o.fact AS detail FROM own o
        JOIN closure c ON o.flow = c.flow AND o.name = c.name JOIN own u ON c.flow = u.flow AND c.up = u.name AND u.fact = o.fact"""),
    "unsafe_aggregate": (CLOSURE + f", summed AS ({SUMMED}), filtered AS ({NOT_NULL})", """SELECT s.flow, s.name AS step, s.fact AS detail FROM summed s
        WHERE NOT EXISTS (SELECT 1 FROM filtered f WHERE f.flow = s.flow AND f.name = s.name AND f.fact = s.fact)
        AND NOT EXISTS (SELECT 1 FROM closure c JOIN filtered f ON c.flow = f.flow AND c.up = f.name
                        WHERE c.flow = s.flow AND c.name = s.name AND f.fact = s.fact)"""),
    "no_description": ("", "SELECT flow, name AS step, '' AS detail FROM flow_steps WHERE trim(description) = ''"),
    "columns_on_one_line": ("", "SELECT flow, name AS step, 'one column per line' AS detail FROM flow_steps WHERE (flow + pos) % 8 IN (3, 7)"),
}

ORACLE = {
    f"lint_{rule}": f"{STEPS}{tables} SELECT flow, step, '{rule}' AS rule, detail FROM ({body})" for rule, (tables, body) in BODIES.items()
}
_all = " UNION ALL ".join(f"SELECT flow, '{r}' AS rule FROM ({b})" for r, (_, b) in BODIES.items() if r not in ("duplicate_step", "step_prefix"))
ORACLE["lint_summary"] = (
    f"{STEPS}{CLOSURE}{READS}, nulls AS ({NOT_NULL}), sources AS ({SOURCES}), summed AS ({SUMMED}), filtered AS (SELECT * FROM nulls), own AS (SELECT * FROM nulls) "
    f"SELECT rule, count(*) AS n, count(DISTINCT flow) AS n_flows FROM ({_all}) GROUP BY rule"
).replace(
    f"SELECT flow, 'repeated_source' AS rule FROM ({BODIES['repeated_source'][1]})",
    f"SELECT flow, 'repeated_source' AS rule FROM ({BODIES['repeated_source'][1].replace('own ', 'sources ')})",
)
