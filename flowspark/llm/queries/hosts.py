from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.hosts import ASIDE, LEAST_WORDS, MARKS, MOST_MARKS, judge

NAME = "op10_host_reputation"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


def _text(column: str) -> str:
    out = f"regexp_replace({column}, '<!--.*?-->', ' ', 'gs')"
    for name in ASIDE:
        out = f"regexp_replace({out}, '<{name}[ >].*?</{name}>', ' ', 'gs')"
    return f"regexp_replace(regexp_replace({out}, '<[^>]*>', ' ', 'g'), '&(amp|lt|gt);', '&', 'g')"


_LEVEL = """
{name}_k AS (
  SELECT CASE WHEN base IS NULL OR base = 0 OR over / base <= 0 THEN 1000.0
              ELSE least(1000.0, greatest(1.0, base / over - 1)) END AS k
  FROM (SELECT sum(n * (good / n - prior) * (good / n - prior) - prior * (1 - prior)) AS over,
               sum((n - 1) * prior * (1 - prior)) AS base FROM {name}_own WHERE n > 0))"""

SQL = f"""
WITH parsed AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
cut AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parsed),
texts AS (SELECT host, {_text("html")} AS t FROM cut),
words AS (
  SELECT host, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, length(t) - length(translate(t, '{MARKS}', '')) AS marks FROM texts),
outcomes AS (
  SELECT host, CASE WHEN t IS NOT NULL THEN len(w) >= {LEAST_WORDS} AND 100 * marks <= {MOST_MARKS} * len(w)
    AND 2 * len(list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)])) > greatest(len(w) - 2, 0) END AS ok
  FROM words),
hosts AS (
  SELECT host, string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
         coalesce(sum(ok::INTEGER), 0)::DOUBLE AS good, count(ok)::DOUBLE AS n
  FROM outcomes GROUP BY ALL),
suffix_own AS (
  SELECT suffix, sum(good) AS good, sum(n) AS n,
         (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) FROM hosts) AS prior FROM hosts GROUP BY suffix),
{_LEVEL.format(name="suffix")},
suffixes AS (SELECT suffix, (prior * k + good) / (k + n) AS prior FROM suffix_own, suffix_k),
domain_own AS (
  SELECT suffix, domain, sum(good) AS good, sum(n) AS n, any_value(prior) AS prior
  FROM (SELECT suffix, domain, good, n FROM hosts) JOIN suffixes USING (suffix) GROUP BY suffix, domain),
{_LEVEL.format(name="domain")},
domains AS (SELECT suffix, domain, (prior * k + good) / (k + n) AS prior FROM domain_own, domain_k),
host_own AS (SELECT host, good, n, prior FROM hosts JOIN domains USING (suffix, domain)),
{_LEVEL.format(name="host")},
rates AS (SELECT host, (prior * k + good) / (k + n) AS rate, k + n + 1 AS weight FROM host_own, host_k),
bounds AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / weight) AS bound FROM rates),
ruled AS (
  SELECT page_id, host, path, bound, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM cut JOIN bounds USING (host))
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN bound >= 0.6 THEN 'allow' ELSE 'block' END AS verdict FROM ruled
"""
