"""Flow documents, description files and session history on storage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowspark.functions.text import safe_name, strip
from flowspark.operators.corpus import parse_flows
from flowspark.schemas import FLOW


def read_flows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file: path, ``status`` of its validation, typed ``document``."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("response"))
    return parse_flows(files).drop("response", "json")


def write_flows(
    documents: DataFrame, folder: str, description: str | None = None, file_per_flow: bool = False, batch: str = "flows"
) -> None:
    """Documents as JSON with their names made safe for paths, and with ``description`` the
    column of that name beside them.

    By default one table of JSON lines with a ``safe_name`` column; documents of another
    ``batch`` stay, the same batch is replaced. With ``file_per_flow`` each name has its
    folder, which suits a few flows, not a corpus of millions; a name that is written again
    is replaced, others stay.
    """
    fields = [F.col("document.name").alias("name"), F.col("document.description").alias("description"), F.col("document.steps").alias("steps")]
    if description:
        fields.append(F.col(description).alias("business_description"))
    out = documents.select(F.concat(safe_name("document.name"), F.lit("_flow")).alias("safe_name"), *fields)
    if not file_per_flow:
        out = out.withColumn("batch", F.lit(batch))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("safe_name" if file_per_flow else "batch").json(folder)


def read_written(spark: SparkSession, folder: str) -> DataFrame:
    """Documents stored by ``write_flows``: their fields, safe name and description (null where none was kept)."""
    schema = T.StructType([*FLOW.fields, T.StructField("business_description", T.StringType()), T.StructField("safe_name", T.StringType())])
    return spark.read.schema(schema).json(folder).drop("batch")


def description_lines(files: DataFrame, text: Column | str = "value", *keys: str) -> DataFrame:
    """Lines of whole files that hold a description: stripped, not blank, not a
    ``#`` comment. ``line_no`` is the place in the file."""
    return (
        files.select(*keys, F.posexplode(F.split(text, r"\R")).alias("line_no", "line"))
        .withColumn("description", strip("line"))
        .filter((F.col("description") != "") & ~F.col("description").startswith("#"))
        .drop("line")
    )


def read_descriptions(spark: SparkSession, path: str | list[str], limit: int | None = None) -> DataFrame:
    """path, line_no and description of the lines of batch files; with ``limit`` the first so many of each file.

    Files are read as lines. Line numbers come from the counts of the splits of a
    file, so a long file is read and numbered in parallel.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"), "value",
        F.monotonically_increasing_id().alias("_id"),
    )
    inside = F.row_number().over(Window.partitionBy("path", "_split").orderBy("_id")) - 1
    before = Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy("path", "_split").agg(F.count("*").alias("_n")).select(
        "path", "_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    found = (
        lines.withColumn("_inside", inside).join(starts, ["path", "_split"])
        .select("path", (F.col("_start") + F.col("_inside")).alias("line_no"), strip("value").alias("description"))
        .filter((F.col("description") != "") & ~F.col("description").startswith("#"))
    )
    if limit is None:
        return found
    first = F.row_number().over(Window.partitionBy("path").orderBy("line_no"))
    return found.withColumn("_nth", first).filter(F.col("_nth") <= limit).drop("_nth")


def session_history(items: DataFrame, session: str = "started_at", order: str = "timestamp") -> DataFrame:
    """One row per flow with the counts of its session, whatever a session's size.

    Rows carry the time they are ordered by, the whole description, and the first 80
    characters of it for display.
    """
    counts = items.groupBy(session).agg(
        F.count("*").alias("flow_count"), F.count_if(F.col("status") == "success").alias("success_count")
    )
    return items.join(counts, session).select(
        session, "flow_count", "success_count", F.col(order).alias("timestamp"), "id", "description",
        F.left("description", F.lit(80)).alias("description_short"), "provider", "status", "path",
    )


def write_sessions(sessions: DataFrame, folder: str) -> None:
    sessions.write.mode("append").json(folder)


def recent_sessions(sessions: DataFrame, limit: int = 5) -> DataFrame:
    """All rows of the latest ``limit`` sessions."""
    latest = sessions.select("started_at").distinct().orderBy(F.desc("started_at")).limit(limit)
    return sessions.join(latest, "started_at", "left_semi")
