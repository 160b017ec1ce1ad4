"""Table metadata documents and checks of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.catalog.derived import derived, table, with_tables
from flowspark.operators import corpus as C
from flowspark.operators import metadata as M

ORDERS_META = [
    {"name": "o_orderkey", "type": "bigint", "nullable": False, "is_key": True},
    {"name": "o_custkey", "type": "bigint", "nullable": False},
    {"name": "o_totalprice", "type": "decimal(18,2)", "nullable": False},
    {"name": "o_comment", "type": "string"},
]
LINES_META = [
    {"name": "l_orderkey", "type": "bigint", "nullable": False, "is_key": True},
    {"name": "l_linenumber", "type": "int", "nullable": False, "is_key": True},
    {"name": "l_discounted", "type": "double", "nullable": False},
]


def ddl_columns(spark: SparkSession, sf: str) -> DataFrame:
    return M.column_rows(derived(spark, sf, "ddl_docs"), M.ddl_tables("text"), ["doc_id"])


def json_columns(spark: SparkSession, sf: str) -> DataFrame:
    return M.column_rows(derived(spark, sf, "meta_docs"), M.json_tables("text"), ["doc_id"])


def metadata_summary(spark: SparkSession, sf: str) -> DataFrame:
    docs = derived(spark, sf, "meta_docs").select("doc_id", M.json_tables("text").alias("tables"))
    return docs.filter("tables IS NOT NULL").select("doc_id", M.summary_text(F.col("tables")).alias("summary"))


def metadata_ddl(spark: SparkSession, sf: str) -> DataFrame:
    docs = derived(spark, sf, "ddl_docs").select("doc_id", M.ddl_tables("text").alias("tables"))
    return docs.filter("size(tables) > 0").select("doc_id", M.ddl_text(F.col("tables")).alias("ddl"))


def build_prompts(spark: SparkSession, sf: str) -> DataFrame:
    docs = derived(spark, sf, "meta_docs").select("doc_id", M.json_tables("text").alias("tables"))
    text = F.concat(F.lit("report on part "), F.col("doc_id").cast("string"))
    return docs.select("doc_id", C.generation_prompt(text, M.summary_text(F.col("tables"))).alias("prompt"))


def metadata_by_ending(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of both kinds under endings that name the right kind, the wrong one, or none."""
    ddl, meta = derived(spark, sf, "ddl_docs").select("doc_id", "text"), derived(spark, sf, "meta_docs").select("doc_id", "text")
    ending = lambda *e: F.element_at(F.array(*map(F.lit, e)), (F.col("doc_id") % len(e) + 1).cast("int"))
    files = ddl.select("doc_id", "text", F.lit("ddl").alias("kind"), F.concat(F.lit("/m/a.b/t"), ending(".sql", ".DDL", ".json", ".txt")).alias("path"))
    files = files.unionByName(
        meta.select("doc_id", "text", F.lit("json").alias("kind"), F.concat(F.lit("/m/t"), ending(".json", ".sql", "")).alias("path"))
    )
    return M.column_rows(files, M.any_tables("text", F.col("path")), ["kind", "doc_id"])


def build_prompts_ddl(spark: SparkSession, sf: str) -> DataFrame:
    """The prompt with the whole CREATE TABLE texts in place of the summary."""
    docs = derived(spark, sf, "ddl_docs").select("doc_id", M.ddl_tables("text").alias("tables")).filter("size(tables) > 0")
    text = F.concat(F.lit("report on part "), F.col("doc_id").cast("string"))
    return docs.select("doc_id", C.generation_prompt(text, M.ddl_text(F.col("tables"))).alias("prompt"))


def check_table(spark: SparkSession, sf: str) -> DataFrame:
    orders = M.check_table(table(spark, sf, "orders"), ORDERS_META).withColumn("table_name", F.lit("orders"))
    lines = table(spark, sf, "lineitem").withColumn("l_discounted", F.nullif("l_discount", F.lit(0.05)))
    return orders.unionByName(M.check_table(lines, LINES_META).withColumn("table_name", F.lit("lineitem")))


QUERIES = {f.__name__: f for f in (ddl_columns, json_columns, metadata_summary, metadata_ddl, metadata_by_ending, build_prompts, build_prompts_ddl, check_table)}

_DDL = """WITH p AS (SELECT p_partkey AS doc_id, p_type, p_partkey % 6 AS k, concat('part_', p_partkey) AS base FROM part),
c(k, suffix, pos, name, type, description, nullable, is_key, partition_column) AS (VALUES
  (0, '', 0, 'part_id', 'STRING', 'key', false, true, false), (0, '', 1, 'price', 'DECIMAL(18,2)', '', false, false, false), (0, '', 2, 'size', 'INT', '', true, false, false),
  (1, '', 0, 'part_id', 'BIGINT', '', true, false, false), (1, '', 1, 'dt', 'DATE', '', false, false, true), (1, '', 2, 'note', 'STRING', 'free text', true, false, false),
  (2, '', 0, 'part_id', 'bigint', '', false, false, false), (2, '', 1, 'brand name', 'string', '', true, false, false),
  (3, '', 0, 'part_id', 'BIGINT', '', false, false, false), (3, '', 1, 'brand', 'STRING', '', true, false, false), (3, '', 2, 'price', 'DECIMAL(18,2)', '', true, false, false),
  (4, '_a', 0, 'part_id', 'BIGINT', '', true, true, false),
  (4, '_b', 0, 'part_id', 'BIGINT', '', true, true, false), (4, '_b', 1, 'qty', 'DECIMAL(10, 0)', '', true, false, false), (4, '_b', 2, 'region', 'STRING', '', true, true, true)),
cols AS (SELECT doc_id, concat(base, suffix) AS table_name, CAST(pos AS BIGINT) AS pos, name, type,
         CASE WHEN description = 'key' THEN concat('key of ', p_type) ELSE description END AS description, nullable, is_key, partition_column
         FROM p JOIN c ON p.k = c.k)"""
_META = """WITH d AS (SELECT p_partkey AS doc_id, p_partkey % 5 AS k, p_name FROM part), t AS (
  SELECT doc_id, 0 AS no, concat('t_', doc_id) AS table_name, p_name FROM d WHERE k IN (0, 1, 3)
  UNION ALL SELECT doc_id, 1, concat('u_', doc_id), p_name FROM d WHERE k IN (0, 1))"""
_SUMMARY = """concat('## Available Tables', chr(10), chr(10), string_agg(concat('- **', table_name, '** — ', p_name,
  ': columns = id string PK, amount decimal(18,2), dt date (partition)'), chr(10) ORDER BY no))"""

ORACLE = {
    "ddl_columns": f"{_DDL} SELECT * FROM cols",
    "json_columns": f"""{_META} SELECT doc_id, table_name, CAST(pos AS BIGINT) AS pos, name, type, '' AS description, nullable, is_key, partition_column FROM t
        CROSS JOIN (VALUES (0, 'id', 'string', false, true, false), (1, 'amount', 'decimal(18,2)', true, false, false), (2, 'dt', 'date', false, false, true))
        c(pos, name, type, nullable, is_key, partition_column)""",
    "metadata_summary": f"{_META} SELECT doc_id, {_SUMMARY} AS summary FROM t GROUP BY doc_id",
    "metadata_ddl": f"""{_DDL}, lines AS (SELECT doc_id, table_name, string_agg(concat('    ', name, ' ', type, CASE WHEN nullable THEN '' ELSE ' NOT NULL' END,
          CASE WHEN description <> '' THEN concat(' COMMENT ''', description, '''') ELSE '' END), ',' || chr(10) ORDER BY pos) AS cols,
          string_agg(name, ', ' ORDER BY pos) FILTER (is_key) AS keys, string_agg(name, ', ' ORDER BY pos) FILTER (partition_column) AS parts FROM cols GROUP BY doc_id, table_name)
        SELECT doc_id, string_agg(concat('CREATE TABLE ', table_name, ' (', chr(10), cols, CASE WHEN keys IS NOT NULL THEN concat(',', chr(10), '    PRIMARY KEY (', keys, ')') ELSE '' END,
          chr(10), ')', CASE WHEN parts IS NOT NULL THEN concat(chr(10), 'PARTITIONED BY (', parts, ')') ELSE '' END), chr(10) || chr(10) ORDER BY table_name) AS ddl FROM lines GROUP BY doc_id""",
    "build_prompts": f"""{_META}, s AS (SELECT doc_id, {_SUMMARY} AS summary FROM t GROUP BY doc_id)
        SELECT d.doc_id, concat('Generate a Spark SQL ETL flow for the following business requirement:', chr(10), chr(10), 'report on part ', d.doc_id, chr(10), chr(10),
          coalesce(summary || chr(10) || chr(10), ''), 'Respond with ONLY the JSON flow definition. No extra text.') AS prompt FROM d LEFT JOIN s ON d.doc_id = s.doc_id""",
    "check_table": """SELECT 'orders' AS table_name, * FROM (VALUES ('o_orderkey', 'present', 0), ('o_orderkey', 'type', 0), ('o_custkey', 'present', 0), ('o_custkey', 'type', 0),
          ('o_totalprice', 'present', 0), ('o_totalprice', 'type', 1), ('o_comment', 'present', 1)) v(column_name, "check", violations)
        UNION ALL SELECT 'lineitem', * FROM (VALUES ('l_orderkey', 'present', 0), ('l_orderkey', 'type', 0), ('l_linenumber', 'present', 0), ('l_linenumber', 'type', 0),
          ('l_discounted', 'present', 0), ('l_discounted', 'type', 0)) v
        UNION ALL SELECT 'orders', 'o_orderkey', 'not_null', count(*) - count(o_orderkey) FROM orders
        UNION ALL SELECT 'orders', 'o_custkey', 'not_null', count(*) - count(o_custkey) FROM orders
        UNION ALL SELECT 'orders', 'o_totalprice', 'not_null', count(*) - count(o_totalprice) FROM orders
        UNION ALL SELECT 'orders', 'o_orderkey', 'unique_key', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem', 'l_orderkey', 'not_null', count(*) - count(l_orderkey) FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_linenumber', 'not_null', count(*) - count(l_linenumber) FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_discounted', 'not_null', count(*) FILTER (l_discount = CAST(0.05 AS DOUBLE)) FROM lineitem
        UNION ALL SELECT 'lineitem', 'l_orderkey,l_linenumber', 'unique_key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
}
ORACLE["metadata_by_ending"] = f"""SELECT 'ddl' AS kind, * FROM ({ORACLE['ddl_columns']}) WHERE doc_id % 4 <> 2
    UNION ALL BY NAME SELECT 'json' AS kind, * FROM ({ORACLE['json_columns']}) WHERE doc_id % 3 <> 1"""
ORACLE["build_prompts_ddl"] = f"""SELECT doc_id, concat('Generate a Spark SQL ETL flow for the following business requirement:', chr(10), chr(10), 'report on part ', doc_id,
    chr(10), chr(10), ddl, chr(10), chr(10), 'Respond with ONLY the JSON flow definition. No extra text.') AS prompt FROM ({ORACLE['metadata_ddl']})"""
