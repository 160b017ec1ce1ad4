from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.llm.convrepair import digest, repair

NAME = "op11_survivor_repair"


def damaged(rows: DataFrame) -> DataFrame:
    """Faults by a hash of each row's place; dropped rows stay with ``present`` false."""
    def text_of(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    ready = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind"))
    return ready.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(repair(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")), present="present"))


def _best(candidates: list[str]) -> str:
    """The least (cost, audit) of some ways; a way that isn't there has no cost."""
    return f"list_sort(list_filter([{', '.join(candidates)}], lambda w: w.c IS NOT NULL))[1]"


def _way(state: str, cost: str, letter: str, line: str | None) -> str:
    tail = f"CASE WHEN {state}.n = 0 THEN '' ELSE chr(10) END || {line}" if line else "''"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'n': {state}.n + {1 if line else 0}, 't': {state}.t || {tail}}}"


_KEEP, _USER, _ASSISTANT = "role || ':' || text", "'user:' || text", "'assistant:' || text"


def _inserts(source: str) -> str:
    return f"""
  SELECT conv_id, i, s0, s1, s2, {_best(["s3", _way("s2", "5", "I", "'assistant:'")])} AS s3 FROM (
    SELECT conv_id, i, s0, s1, s3,
           {_best(["s2", *[_way(s, "5", "I", "'user:'") for s in ("s0", "s1", "s3")]])} AS s2 FROM {source})"""


def _row(state: str, initial: str | None, kept: str, made: str) -> str:
    keep = _way(state, f"CASE WHEN NOT must AND left(role, 1) = '{initial}' THEN late END", "K", kept)
    change = _way(state, "CASE WHEN NOT must THEN 1 + late END", "R", made)
    return f"{keep}, {change}"


# The same search row by row, with whole letters and texts in the states: for tables of short conversations.
SQL = f"""
WITH RECURSIVE crc_base(n, v) AS (
  SELECT range, range::BIGINT FROM range(256)),
crc_table AS (
  SELECT n, list_reduce([v] || range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) AS v FROM crc_base),
lookup AS (SELECT list(v ORDER BY n) AS t FROM crc_table),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
kinds AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([4294967295] || [ascii(x)::BIGINT FOR x IN string_split(key, '')],
             lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS kind FROM keyed, lookup),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM hurt),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
judged AS (
  SELECT *, fault IN ('blank', 'duplicate') AS must, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS late FROM faults),
convs AS (SELECT DISTINCT conv_id FROM conversations),
nothing AS (SELECT {{'c': NULL::BIGINT, 'a': ''::VARCHAR, 'n': 0, 't': ''::VARCHAR}} AS w),
ways(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, 0::BIGINT, {{'c': 0::BIGINT, 'a': ''::VARCHAR, 'n': 0, 't': ''::VARCHAR}}, w, w, w FROM convs, nothing
  UNION ALL
  SELECT conv_id, i, {_best([_way("s0", "2", "D", None)])},
         {_best([_way("s1", "2", "D", None), _way("s0", "CASE WHEN NOT must AND left(role, 1) = 's' THEN late END", "K", _KEEP)])},
         {_best([_way("s2", "2", "D", None), *[_row(s, "u", _KEEP, _USER) for s in ("s0", "s1", "s3")]])},
         {_best([_way("s3", "2", "D", None), _row("s2", "a", _KEEP, _ASSISTANT)])}
  FROM (SELECT ready.conv_id, j.i, s0, s1, s2, s3, role, text, must, late
        FROM ({_inserts("ways")}) ready JOIN judged j ON j.conv_id IS NOT DISTINCT FROM ready.conv_id AND j.i = ready.i + 1)),
ends AS (
  SELECT conv_id, {_best(["s0", "s3"])} AS w
  FROM ({_inserts("(SELECT * FROM ways QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)")})),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, w.c AS cost, w.a AS audit, sha256(w.t) AS repaired_sha256
FROM ends e LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM e.conv_id
"""
