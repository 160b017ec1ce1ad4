"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowspark.session import ship_package

#: A word: anything between ASCII white space.
WORDS = r"[^\x20\x09-\x0D]+"
#: Spark's own default of the setting.
DEFAULT_BATCH_BYTES = "67108864b"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def unit_interval(h: Column) -> Column:
    """A 64-bit hash as a double in [0, 1)."""
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns of these names, in any case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def python_ready(spark: SparkSession, limit: int = 8 << 20) -> None:
    """What Python stages need: the package on the workers, and a bound on the bytes of
    an Arrow batch, so that very long texts don't add up.

    The bound changes no result; a setting of the session's own is kept.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES) == DEFAULT_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, str(limit))
