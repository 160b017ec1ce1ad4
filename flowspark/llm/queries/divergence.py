from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.divergence import audit

NAME = "op13_stripe_divergence"

SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
per AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT d) AS docs FROM words GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS n FROM per GROUP BY lang, term HAVING sum(docs) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n_all FROM kept GROUP BY lang),
used AS (SELECT lang, source, sum(per.n) AS n FROM per JOIN kept USING (lang, term) GROUP BY lang, source),
groups AS (
  SELECT lang, source, coalesce(n, 0)::HUGEINT AS n, coalesce(v, 0)::HUGEINT AS v, coalesce(n_all, 0)::HUGEINT AS n_all
  FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN used USING (lang, source) LEFT JOIN langs USING (lang)),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(per.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(per.n, 0) + 5) // (g.n + 5 * g.v) AS p, 1 + 1000000000::HUGEINT * (k.n + 5) // (g.n_all + 5 * g.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN per ON per.lang = g.lang AND per.source = g.source AND per.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, r::INTEGER AS rank FROM ranked WHERE part = 'pair' OR r <= 50
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))
