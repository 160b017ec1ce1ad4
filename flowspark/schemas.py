"""Column layouts of the documents and logs the library works on."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

CREATED = T.StructType([T.StructField("$date", S)])
OUTPUT = T.StructType(
    [
        T.StructField("tempView", S),
        T.StructField("table", S),
        T.StructField("appendType", S),
        T.StructField("kafkaGroup", S),
    ]
)
DIAGRAM = T.StructType([T.StructField("x", I), T.StructField("y", I)])
STEP = T.StructType(
    [
        T.StructField("name", S),
        T.StructField("parents", T.ArrayType(S)),
        T.StructField("order", I),
        T.StructField("sql", S),
        T.StructField("output", OUTPUT),
        T.StructField("description", S),
        T.StructField("diagram", DIAGRAM),
        T.StructField("active", B),
        T.StructField("createdDate", CREATED),
    ]
)
FLOW = T.StructType(
    [
        T.StructField("name", S),
        T.StructField("description", S),
        T.StructField("steps", T.ArrayType(STEP)),
    ]
)

# Field defaults of a flow document (fixed values of the document contract).
OUTPUT_DEFAULTS = {"table": "", "appendType": "REPLACE", "kafkaGroup": ""}

# The same document with untyped leaves: a leaf keeps its JSON type, so lax
# coercion ("1" for an integer) can be decided field by field.
FLOW_LOOSE = (
    "STRUCT<name: VARIANT, description: VARIANT, steps: ARRAY<STRUCT<"
    "name: VARIANT, parents: VARIANT, `order`: VARIANT, sql: VARIANT, "
    "output: STRUCT<tempView: VARIANT, `table`: VARIANT, appendType: VARIANT, kafkaGroup: VARIANT>, "
    "description: VARIANT, diagram: STRUCT<x: VARIANT, y: VARIANT>, active: VARIANT, "
    "createdDate: VARIANT>>>"
)

EVALUATION_LOOSE = (
    "STRUCT<score: VARIANT, feedback: VARIANT, dimensions: MAP<STRING, DOUBLE>, "
    "critical_issues: ARRAY<STRING>>"
)

COLUMN_META = (
    "STRUCT<name: VARIANT, type: VARIANT, description: VARIANT, nullable: VARIANT, "
    "is_key: VARIANT, partition_column: VARIANT>"
)
TABLE_META = (
    f"STRUCT<name: VARIANT, description: VARIANT, columns: ARRAY<{COLUMN_META}>, "
    "partitioned_by: ARRAY<VARIANT>>"
)
