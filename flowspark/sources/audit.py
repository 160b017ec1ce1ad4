"""Audit lines: ``time | client | provider/model | status | cost=$x``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = r"^(\S+) \| (.*?) \| ([^/|]*)/(.*) \| (\w+) \| cost=\$(\d+\.\d+)$"


def audit_line(time: Column, client: Column, provider: Column, model: Column, status: Column, cost: Column) -> Column:
    return F.concat_ws(
        " | ", time, F.coalesce(client, F.lit("-")), F.concat_ws("/", provider, model), status, F.format_string("cost=$%.6f", cost)
    )


def write_audit(lines: DataFrame, path: str) -> None:
    """Add the one text column of ``lines`` to the audit log."""
    lines.write.mode("append").text(path)


def parse_audit(lines: DataFrame, column: str = "value") -> DataFrame:
    """Six typed columns beside the line; ``malformed`` lines keep only the text."""
    part = lambda i: F.regexp_extract(column, LINE, i)
    good = F.col(column).rlike(LINE)
    fields = {"client": 2, "provider": 3, "model": 4, "status": 5}
    return lines.select(
        "*",
        (~good).alias("malformed"),
        F.when(good, F.expr(f"try_to_timestamp(regexp_extract(`{column}`, '^([^ ]+)', 1))")).alias("time"),
        *[F.when(good, part(i)).alias(name) for name, i in fields.items()],
        F.when(good, part(6).try_cast("double")).alias("cost"),
    )


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return parse_audit(spark.read.text(path))
