from pyspark.sql import DataFrame, SparkSession

from flowspark.llm.bwtspans import cleaned_texts, per_document

NAME = "op12_bwt_spans"

# one row per window: for tables of some megabytes
SQL = """
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
starts AS (SELECT d, h, unnest(range(length(h) // 2 - 199)) AS p FROM docs WHERE length(h) >= 400),
hashed AS (SELECT d, p, hash(substr(h, 2 * p + 1, 400)) AS w FROM starts),
again AS (SELECT w FROM hashed GROUP BY w HAVING count(*) > 1),
hits AS (SELECT d, p, p - lag(p) OVER (PARTITION BY d ORDER BY p) AS gap FROM hashed SEMI JOIN again USING (w)),
grouped AS (SELECT d, p, count_if(gap IS NULL OR gap > 200) OVER (PARTITION BY d ORDER BY p) AS g FROM hits),
spans AS (SELECT d, g, min(p) AS a, max(p) + 200 AS b FROM grouped GROUP BY d, g),
gone AS (SELECT d, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last FROM spans GROUP BY d),
parts AS (SELECT d, g, coalesce(lag(b) OVER (PARTITION BY d ORDER BY a), 0) AS a, a AS b FROM spans),
kept AS (SELECT d, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k FROM parts JOIN docs USING (d) GROUP BY d)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN gone USING (d) LEFT JOIN kept USING (d)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = cleaned_texts(docs, 200).selectExpr(
        "t1", "t2", "n_bytes", "n_bytes - octet_length(kept) AS n_removed", "CAST(size(removed) AS BIGINT) AS n_spans",
        "sha2(kept, 256) AS kept_sha256",
    )
    return per_document(docs, texts)
