"""The relational building blocks of flow steps, as DataFrame helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key: the first in ``order``, which should end in a unique column.

    Spark limits each key to one row per map task before the shuffle
    (WindowGroupLimit), so a hot key costs no more than a rare one.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def dedup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join against the distinct keys of ``right``: never multiplies rows."""
    return left.join(right.select(*keys).distinct(), list(keys), how)


def agg_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, *aggs: Column) -> DataFrame:
    """Aggregate the fact side to one row per key before it meets the dimension."""
    return fact.groupBy(fact_key).agg(*aggs).join(dim, F.col(fact_key) == F.col(dim_key))


def money(column: Column | str) -> Column:
    """Fixed-point value, so that sums do not depend on the order of rows."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("decimal(18,2)")


def total(column: Column) -> Column:
    """Exact decimal sum, given back as double."""
    return F.sum(column).cast("double")


def null_safe_total(column: Column) -> Column:
    return total(F.coalesce(column, F.lit(0).cast("decimal(18,2)")))


def clean_text(column: Column | str) -> Column:
    """Carriage returns become blanks."""
    return F.regexp_replace(column, "[\\r]", " ")


def shorten(column: Column | str, limit: int, mark: str = "...") -> Column:
    """Display form: the first ``limit`` characters, marked where cut."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(F.length(column) > limit, F.concat(F.substring(column, 1, limit), F.lit(mark))).otherwise(column)
