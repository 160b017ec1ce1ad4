"""Input tables derived from the given ones, as SQL both engines can read.

Spark and the comparison engine differ in a few spellings only; these are the
``{...}`` marks filled in by ``render``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK = {
    # one shuffle by flow for all that follows, the documents too: a flow's places come once as they
    # are and once halved, and those that meet are the halves that stand in the flow
    "places": """FROM (SELECT flow, pos, half, named_struct('first_pos', min(pos) OVER (PARTITION BY flow), 'last_pos', max(pos) OVER (PARTITION BY flow)) AS x,
                   named_struct('pos', CASE WHEN stands THEN half END) AS h
            FROM (SELECT flow, pos, half, own, bool_or(own) OVER (PARTITION BY flow, place) AS stands
                  FROM (SELECT flow, pos, CAST(floor(pos / 2) AS BIGINT) AS half
                        FROM (SELECT DISTINCT l_orderkey AS flow, CAST(l_linenumber AS BIGINT) AS pos FROM lineitem WHERE l_orderkey IS NOT NULL)
                        DISTRIBUTE BY flow) d
                  LATERAL VIEW stack(2, pos, true, half, false) v AS place, own)
            WHERE NOT own) p""",
    # from the calendar fields, so that the session time zone plays no part
    "epoch_us": (
        "(datediff(CAST(ts AS DATE), DATE'1970-01-01') * 86400000000 + hour(ts) * 3600000000 "
        "+ minute(ts) * 60000000L + CAST(extract(SECOND FROM ts) * 1000000 AS BIGINT))"
    ),
    "list_open": "string_agg(",
    "list_order": ") WITHIN GROUP (ORDER BY ",
    "list_close": ")",
    "lines": "SELECT doc_id, i AS line_no, line FROM documents LATERAL VIEW posexplode(split(text, chr(10))) x AS i, line",
    "iso_ts": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")",
}
DUCK = {
    "places": """FROM (SELECT flow, pos, CAST(floor(pos / 2) AS BIGINT) AS half
            FROM (SELECT DISTINCT l_orderkey AS flow, CAST(l_linenumber AS BIGINT) AS pos FROM lineitem)) p
      JOIN (SELECT l_orderkey AS flow, CAST(min(l_linenumber) AS BIGINT) AS first_pos, CAST(max(l_linenumber) AS BIGINT) AS last_pos
            FROM lineitem GROUP BY l_orderkey) x ON p.flow = x.flow
      LEFT JOIN (SELECT DISTINCT l_orderkey AS flow, CAST(l_linenumber AS BIGINT) AS pos FROM lineitem) h
             ON p.flow = h.flow AND p.half = h.pos""",
    "epoch_us": "epoch_us(ts)",
    "list_open": "string_agg(",
    "list_order": " ORDER BY ",
    "list_close": ")",
    "lines": (
        "SELECT doc_id, i - 1 AS line_no, parts[i] AS line FROM (SELECT doc_id, parts, "
        "unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))"
    ),
    "iso_ts": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
}


def _named(n: str) -> str:
    return f"concat(CASE WHEN {n} % 2 = 0 THEN 'SAVE_' ELSE 'LOAD_' END, CAST({n} AS STRING))"


# One row per step. The flow is the order key, the position the line number.
FLOW_STEPS = f"""
SELECT flow, pos, pos AS ord, flow_name, name,
       concat_ws(',', base_parent, loop_parent) AS parents,
       concat(view_prefix, name) AS temp_view,
       CASE WHEN pos = last_pos OR (flow % 11 = 0 AND pos = first_pos) THEN concat('OUT_', CAST(flow AS STRING)) ELSE '' END AS target_table,
       CASE WHEN flow % 4 = 0 THEN 'APPEND' ELSE 'REPLACE' END AS append_type,
       CASE WHEN flow % 5 = 0 THEN '' ELSE concat('step ', CAST(pos AS STRING)) END AS description,
       (flow + pos) % 19 <> 0 AS active,
       CASE (flow + pos) % 8
         WHEN 0 THEN concat('SELECT c_custkey', chr(10), '     , c_name', chr(10), 'FROM ', '$', '{{{{CLIENT_ROWS}}}}', chr(10), 'WHERE c_custkey IS NOT NULL')
         WHEN 1 THEN concat('SELECT c_custkey', chr(10), 'FROM ', CASE WHEN flow % 3 = 0 THEN concat(view_prefix, last_name) ELSE src END, chr(10), 'WHERE c_custkey IS NOT NULL')
         WHEN 2 THEN concat('SELECT *', chr(10), 'FROM ', src)
         WHEN 3 THEN concat('SELECT o_orderkey, o_custkey', chr(10), 'FROM warehouse.orders', chr(10), 'WHERE o_orderdate >= DATE_SUB(', '$', '[AS_OF_DAY], 90)')
         WHEN 4 THEN concat('SELECT TRUNC(o_orderdate, ''MONTH'') AS order_month', chr(10), '     , SUM(o_totalprice) AS total', chr(10), 'FROM ', src, chr(10), 'GROUP BY TRUNC(o_orderdate, ''MONTH'')')
         WHEN 5 THEN concat('SELECT /*+ BROADCAST(n) */ c.c_custkey', chr(10), 'FROM ', src, ' c', chr(10), 'JOIN ', '$', '{{{{CLIENT_ROWS}}}}', ' n', chr(10), '  ON c.c_custkey = n.c_custkey')
         WHEN 6 THEN concat('SELECT a.c_custkey', chr(10), 'FROM ', src, ' a', chr(10), 'LEFT JOIN ', '$', '{{{{ORDER_ROWS}}}}', ' b', chr(10), '  ON a.c_custkey = b.o_custkey', chr(10), 'WHERE b.o_custkey IS NULL')
         ELSE concat('select c_custkey, sum(coalesce(c_acctbal, 0)) as total from ', src, ' where c_acctbal is not null group by c_custkey')
       END AS sql_text
FROM (
  SELECT e.*,
         CASE WHEN base_parent IS NULL THEN concat('$', '{{{{ORDER_ROWS}}}}') ELSE concat(view_prefix, base_parent) END AS src
  FROM (
    SELECT n.*,
           CASE WHEN flow % 7 = 0 AND pos > first_pos THEN first_name
                WHEN half > 0 AND (flow % 10 = 0 OR half_pos IS NOT NULL) THEN {_named("half")} END AS base_parent,
           CASE WHEN flow % 17 = 0 AND pos = first_pos AND last_pos > first_pos THEN last_name END AS loop_parent
    FROM (
      SELECT p.flow, p.pos, x.first_pos, x.last_pos, p.half, h.pos AS half_pos,
             CASE WHEN p.flow % 6 = 5 THEN concat('flow ', CAST(p.flow AS STRING)) ELSE concat('FLOW_', CAST(p.flow AS STRING)) END AS flow_name,
             CASE WHEN p.flow % 13 = 0 THEN 'V_' ELSE '' END AS view_prefix,
             {_named("p.pos")} AS name,
             {_named("x.first_pos")} AS first_name,
             {_named("x.last_pos")} AS last_name
      {{places}}
    ) n
  ) e
) s
"""

# One JSON document per flow.
FLOW_DOCS = f"""
SELECT flow, concat('{{{{"name":"', max(flow_name), '","description":"flow of order ', CAST(flow AS STRING), '","steps":[',
         {{list_open}}step_json, ','{{list_order}}pos{{list_close}}, ']}}}}') AS doc
FROM (
  SELECT flow, pos, flow_name,
    concat('{{{{"name":"', name, '","parents":[',
      CASE WHEN parents = '' THEN '' ELSE concat('"', replace(parents, ',', '","'), '"') END,
      '],"order":', CAST(ord AS STRING), ',"sql":"', replace(sql_text, chr(10), concat(chr(92), 'n')),
      '","output":{{{{"tempView":"', temp_view, '","table":"', target_table, '","appendType":"', append_type,
      '","kafkaGroup":""}}}},"description":"', description, '","diagram":{{{{"x":', CAST(pos * 20 AS STRING),
      ',"y":100}}}},"active":', CASE WHEN active THEN 'true' ELSE 'false' END,
      ',"createdDate":{{{{"$', 'date":"2026-05-15T01:44:25.911Z"}}}}}}}}') AS step_json
  FROM ({FLOW_STEPS}) fs
) sj GROUP BY flow
"""

# Raw model answers: the document in the wrappings seen in practice, and broken ones.
RESPONSES = f"""
SELECT flow, CASE
    WHEN flow % 13 = 1 THEN replace(doc, '"order":', '"position":')
    WHEN flow % 13 = 2 THEN replace(doc, '"steps":', '"steps" ')
    WHEN flow % 13 = 3 THEN replace(replace(doc, '"order":', '"order":"'), ',"sql":', '","sql":')
    WHEN flow % 13 = 4 THEN replace(doc, '"name":"LOAD_1"', '"name":1')
    WHEN flow % 13 = 5 THEN ''
    WHEN flow % 6 = 0 THEN concat('  ', doc, chr(10))
    WHEN flow % 6 = 1 THEN concat('```json', chr(10), doc, chr(10), '```')
    WHEN flow % 6 = 2 THEN concat('Here it is:', chr(10), '```', chr(10), doc, chr(10), '```', chr(10), 'Done.')
    WHEN flow % 6 = 3 THEN concat('The flow is ', doc, ' as asked.')
    WHEN flow % 6 = 4 THEN substr(doc, 1, CAST(floor(length(doc) * (flow % 5 + 1) / 10) AS INT))
    ELSE 'I cannot build this flow.' END AS response
FROM ({FLOW_DOCS}) fd
"""

# Judge answers, one per (flow, iteration).
EVALUATIONS = """
SELECT flow, iteration, CASE
    WHEN doc_id % 19 = 0 THEN 'no verdict'
    WHEN doc_id % 17 = 0 THEN substr(body, 1, 40)
    WHEN doc_id % 3 = 0 THEN concat('```json', chr(10), body, chr(10), '```')
    ELSE body END AS response
FROM (
  SELECT doc_id, flow, iteration, concat('{{"score": ', CAST(CAST(floor(s / 10) AS BIGINT) AS STRING), '.', CAST(s % 10 AS STRING),
      CASE WHEN doc_id % 11 = 0 THEN '' ELSE concat(', "feedback": "note ', CAST(doc_id AS STRING), '"') END,
      ', "dimensions": {{"correctness": ', CAST(7 + (doc_id + n_chars) % 4 AS STRING),
      CASE WHEN doc_id % 13 = 0 THEN '' ELSE concat(', "spark_execution_efficiency": ', CAST(7 + (doc_id * 3 + n_chars) % 4 AS STRING)) END,
      ', "dependency_correctness": ', CAST(7 + n_chars % 4 AS STRING), '.5}}',
      CASE WHEN toxic = 1 THEN ', "critical_issues": ["column missing"]' WHEN doc_id % 2 = 0 THEN ', "critical_issues": []' ELSE '' END, '}}') AS body
  FROM (SELECT d.doc_id, CAST(floor(d.doc_id / 5) AS BIGINT) AS flow, d.doc_id % 5 + 1 AS iteration, d.n_chars, coalesce(l.toxic, 0) AS toxic,
               (d.doc_id * 7 + d.n_chars) % 31 + 70 AS s
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) a
) b
"""

# Calls to model providers. Time runs 3600 times faster than in the source, so
# that minute limits and one-minute expiry both take effect.
REQUEST_LOG = """
SELECT event_id, provider, model, concat(provider, ':', CAST(k AS STRING)) AS request_key, k, t_us,
       CASE WHEN k % 10 = 0 THEN NULL ELSE concat('key-', CAST(k % 20 AS STRING)) END AS api_key,
       CAST(10 + (event_id * 37) % 990 AS BIGINT) AS prompt_tokens,
       CAST((event_id * 53) % 700 AS BIGINT) AS completion_tokens,
       CASE WHEN k % 9 = 0 THEN 'failed' ELSE 'success' END AS status
FROM (
  SELECT event_id, event_type AS provider,
         CASE k % 6 WHEN 0 THEN 'gpt-4o' WHEN 1 THEN 'gpt-4o-mini' WHEN 2 THEN 'claude-sonnet-4'
                    WHEN 3 THEN 'claude-haiku-4' WHEN 4 THEN 'deepseek-chat' ELSE 'other-model' END AS model,
         k, t_us
  FROM (SELECT event_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
               CAST(floor({epoch_us} / 3600) AS BIGINT) AS t_us FROM events) a
) b
"""

# Tries of one request along its provider chain.
ATTEMPTS = f"""
SELECT CAST(floor(event_id / 3) AS BIGINT) AS request_id, event_id % 3 AS chain_pos, provider, model, k % 3 = 0 AS ok
FROM ({REQUEST_LOG}) r
"""

AUDIT_LINES = """
SELECT event_id, CASE WHEN event_id % 23 = 0 THEN concat('broken line ', CAST(event_id AS STRING))
  ELSE concat({iso_ts}, '+00:00 | 10.0.0.', CAST(user_id % 250 AS STRING), ' | ', event_type, '/model-', CAST(k % 7 AS STRING),
       ' | ', CASE WHEN k % 9 = 0 THEN 'failed' ELSE 'success' END, ' | cost=$', CAST(CAST(floor(m / 1000000) AS BIGINT) AS STRING), '.',
       lpad(CAST(m % 1000000 AS STRING), 6, '0')) END AS value
FROM (SELECT event_id, ts, user_id, event_type, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
             (event_id * 7919) % 3000000 AS m FROM events) a
"""

# Description files: one per document, some lines commented out or padded.
DESCRIPTION_LINES = """
SELECT doc_id, line_no, CASE WHEN line_no % 7 = 6 THEN concat('# ', line) WHEN line_no % 4 = 1 THEN concat('   ', line, '  ') ELSE line END AS line
FROM ({lines}) a
"""

# One CREATE TABLE text per part, in the spellings the metadata reader has to know.
DDL_DOCS = """
SELECT p_partkey AS doc_id, CASE p_partkey % 6
  WHEN 0 THEN concat('CREATE TABLE ', base, ' (', chr(10), '    part_id STRING NOT NULL COMMENT ''key of ', p_type, ''',', chr(10),
       '    price DECIMAL(18,2) NOT NULL,', chr(10), '    size INT,', chr(10), '    PRIMARY KEY (part_id)', chr(10), ')')
  WHEN 1 THEN concat('CREATE TABLE IF NOT EXISTS shop.', base, ' (', chr(10), '    part_id BIGINT,', chr(10), '    dt DATE NOT NULL,', chr(10),
       '    note STRING COMMENT ''free text''', chr(10), ')', chr(10), 'PARTITIONED BY (dt)')
  WHEN 2 THEN concat('create table ', chr(96), 'shop', chr(96), '.', chr(96), base, chr(96), ' (', chr(10), '  ', chr(96), 'part_id', chr(96), ' bigint not null,', chr(10),
       '  ', chr(96), 'brand name', chr(96), ' string', chr(10), ')')
  WHEN 3 THEN concat('CREATE TABLE ', base, ' (part_id BIGINT NOT NULL, brand STRING, price DECIMAL(18,2))')
  WHEN 4 THEN concat('CREATE TABLE ', base, '_a (', chr(10), '  part_id BIGINT,', chr(10), '  CONSTRAINT pk PRIMARY KEY (part_id)', chr(10), ');', chr(10), chr(10),
       'CREATE TABLE ', base, '_b (', chr(10), '  part_id BIGINT,', chr(10), '  qty DECIMAL(10, 0),', chr(10), '  region STRING,', chr(10),
       '  PRIMARY KEY (part_id, region)', chr(10), ') PARTITIONED BY (region)')
  ELSE concat('-- no table for ', base) END AS text
FROM (SELECT p_partkey, p_type, concat('part_', CAST(p_partkey AS STRING)) AS base FROM part) a
"""

# JSON metadata documents, in both accepted shapes, and broken ones.
META_DOCS = """
SELECT p_partkey AS doc_id, CASE WHEN p_partkey % 5 = 4 THEN concat('{{"columns": ', CAST(p_partkey AS STRING), '}}')
  WHEN p_partkey % 5 = 3 THEN concat('[', body, ']')
  WHEN p_partkey % 5 = 2 THEN 'not json'
  ELSE concat('{{"tables": [', body, ', ', replace(body, '"t_', '"u_'), ']}}') END AS text
FROM (SELECT p_partkey, concat('{{"name": "t_', CAST(p_partkey AS STRING), '", "description": "', p_name, '", "columns": [',
        '{{"name": "id", "type": "string", "nullable": false, "is_key": true}}, ',
        '{{"name": "amount", "type": "decimal(18,2)"}}, ',
        '{{"name": "dt", "type": "date", "nullable": false, "partition_column": true}}], "partitioned_by": ["dt"]}}') AS body FROM part) a
"""

ALL = {
    "flow_steps": FLOW_STEPS,
    "flow_docs": FLOW_DOCS,
    "responses": RESPONSES,
    "evaluations": EVALUATIONS,
    "request_log": REQUEST_LOG,
    "attempts": ATTEMPTS,
    "audit_lines": AUDIT_LINES,
    "description_lines": DESCRIPTION_LINES,
    "ddl_docs": DDL_DOCS,
    "meta_docs": META_DOCS,
}


def render(name: str, dialect: dict[str, str]) -> str:
    return ALL[name].format(**dialect)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table as a lazy plan over the given parquet tables."""
    text = render(name, SPARK)
    for source in TABLES:
        if f" {source}" in text:
            table(spark, sf_dir, source).createOrReplaceTempView(source)
    return spark.sql(text)


def with_tables(*names: str) -> str:
    """``WITH`` head that gives the comparison engine the same derived tables."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS MATERIALIZED ({render(n, DUCK)})" for n in names)
