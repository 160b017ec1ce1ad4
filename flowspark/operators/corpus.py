"""Flow documents as tables: raw answers in, validated flows and step rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions.text import json_object, truncated
from flowspark.operators.relational import shorten
from flowspark.schemas import FLOW_LOOSE, OUTPUT_DEFAULTS

TRUTH = "('true', 'false', '1', '0', 'yes', 'no', 'on', 'off', 't', 'f', 'y', 'n')"


def _is_text(v: str) -> str:
    return f"coalesce(schema_of_variant({v}) = 'STRING', false)"


def _may_be_text(v: str) -> str:
    return f"({v} IS NULL OR schema_of_variant({v}) = 'STRING')"


def _is_whole(v: str) -> str:
    return f"coalesce(exists(array(try_variant_get({v}, '$', 'double')), d -> d = floor(d)), false)"


def _text(v: str, default: str = "") -> str:
    return f"coalesce(try_variant_get({v}, '$', 'string'), '{default}')"


def _whole(v: str) -> str:
    return f"CAST(try_variant_get({v}, '$', 'double') AS INT)"


_DATE = "coalesce(try_variant_get(s.createdDate, '$[\"$date\"]', 'string'), try_variant_get(s.createdDate, '$.date', 'string'))"

#: Fields of a step in document order: path, whether it is valid, and what is expected.
_STEP_FIELDS = [
    ("name", _is_text("s.name"), "text"),
    (
        "parents",
        "(s.parents IS NULL OR (coalesce(schema_of_variant(s.parents) IN ('ARRAY<STRING>', 'ARRAY<VOID>'), false)"
        " AND forall(try_variant_get(s.parents, '$', 'array<string>'), p -> p IS NOT NULL)))",
        "a list of texts",
    ),
    ("order", _is_whole("s.`order`"), "a whole number"),
    ("sql", _is_text("s.sql"), "text"),
    ("output.tempView", _is_text("s.output.tempView"), "text"),
    *[(f"output.{k}", _may_be_text(f"s.output.`{k}`"), "text") for k in OUTPUT_DEFAULTS],
    ("description", _may_be_text("s.description"), "text"),
    ("diagram.x", _is_whole("s.diagram.x"), "a whole number"),
    ("diagram.y", _is_whole("s.diagram.y"), "a whole number"),
    ("active", f"(s.active IS NULL OR coalesce(lower(try_variant_get(s.active, '$', 'string')) IN {TRUTH}, false))", "true or false"),
    ("createdDate", f"coalesce(try_cast({_DATE} AS TIMESTAMP) IS NOT NULL OR try_cast({_DATE} AS DOUBLE) IS NOT NULL, false)", "a time under $date"),
]


def _first_failing(fields: list[tuple[str, str, str]], place: str) -> str:
    """CASE that names the first field that isn't valid; ``place`` is SQL for what stands before its path."""
    whens = [f"WHEN NOT coalesce({valid}, false) THEN concat({place}, '{path}: {kind} expected')" for path, valid, kind in fields]
    return f"CASE {' '.join(whens)} END"


_FLOW_REASON = (
    "coalesce("
    + _first_failing(
        [("name", _is_text("v.name"), "text"), ("description", _may_be_text("v.description"), "text"), ("steps", "v.steps IS NOT NULL", "a list of steps")],
        "''",
    )
    + f", get(array_compact(transform(v.steps, (s, i) -> {_first_failing(_STEP_FIELDS, place=chr(39) + 'steps[' + chr(39) + ', i, ' + chr(39) + '].' + chr(39))})), 0))"
)

_FLOW_TYPED = f"""named_struct(
  'name', {_text('v.name')}, 'description', {_text('v.description')},
  'steps', transform(v.steps, s -> named_struct(
    'name', {_text('s.name')},
    'parents', coalesce(try_variant_get(s.parents, '$', 'array<string>'), CAST(array() AS ARRAY<STRING>)),
    'order', {_whole('s.`order`')}, 'sql', {_text('s.sql')},
    'output', named_struct('tempView', {_text('s.output.tempView')}, 'table', {_text('s.output.`table`')},
      'appendType', {_text('s.output.appendType', 'REPLACE')}, 'kafkaGroup', {_text('s.output.kafkaGroup')}),
    'description', {_text('s.description')},
    'diagram', named_struct('x', {_whole('s.diagram.x')}, 'y', {_whole('s.diagram.y')}),
    'active', coalesce(lower(try_variant_get(s.active, '$', 'string')) IN ('true', '1', 'yes', 'on', 't', 'y'), true),
    'createdDate', named_struct('$date', {_DATE}))))"""


# Reason and typed document of the loose one, which is too wide to be carried from one to the other as a column.
_CHECKED = f"""get(transform(array(_loose), v -> get(transform(array(CASE WHEN v IS NOT NULL THEN {_FLOW_REASON} END), r -> named_struct(
  'valid', v IS NOT NULL, 'reason', r, 'document', CASE WHEN v IS NOT NULL AND r IS NULL THEN {_FLOW_TYPED} END)), 0)), 0)"""

NO_JSON, BAD_JSON, CUT_OFF = "no JSON object found", "not one valid JSON object", "; the answer seems to be cut off"


def strict_json(text: Column, schema: str) -> Column:
    """Parse one JSON value and nothing else; NULL where there is more or less.

    ``from_json`` alone takes trailing text and single quotes. As the only element
    of an array such text fails or gives a second element, unless it closes the
    bracket itself; as the only field of an object it then fails.
    """
    strict = {"allowSingleQuotes": "false"}
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"ARRAY<{schema}>", strict)
    field = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "STRUCT<v: STRING>", strict)["v"]
    return F.get(F.filter(F.array(parsed), lambda found: (F.size(found) == 1) & field.isNotNull()), 0)[0]


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that comes out of a generator, so that filters on what is
    derived from it cannot be pushed below it and work it out per reference."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_flows(responses: DataFrame, text: str = "response") -> DataFrame:
    """Add ``json``, ``status`` (ok, no_json, bad_json, invalid_flow), ``truncated``, the
    typed ``document`` (NULL unless ok) and the ``reason`` of all others: for an invalid
    flow the path of its first failing field and what is expected there, such as
    ``steps[2].order: a whole number expected``. Bad answers stay as rows."""
    found = responses.withColumn("json", json_object(text)).withColumn("_found", F.col("json").isNotNull())
    # the answer itself is not carried on from here, unless it is asked for
    found = _once(found.withColumn("truncated", ~F.col("_found") & truncated(text)), "_json", F.col("json"))
    checked = _once(found.withColumn("_loose", strict_json(F.col("_json"), FLOW_LOOSE)), "_checked", F.expr(_CHECKED)).drop("_loose", "_json")
    status = (
        F.when(~F.col("_found"), "no_json")
        .when(~F.col("_checked.valid"), "bad_json")
        .when(F.col("_checked.reason").isNotNull(), "invalid_flow")
        .otherwise("ok")
    )
    cut_off = F.when(F.col("truncated"), F.lit(CUT_OFF)).otherwise("")
    reason = (
        F.when(F.col("status") == "no_json", F.concat(F.lit(NO_JSON), cut_off))
        .when(F.col("status") == "bad_json", BAD_JSON)
        .otherwise(F.col("_checked.reason"))
    )
    told = checked.withColumn("status", status).withColumns({"reason": reason, "document": F.col("_checked.document")})
    added = ["json", "reason", "document", "status", "truncated"]
    return told.select(*[F.col(f"`{c}`") for c in responses.columns if c not in added], *added)


def flow_steps(documents: DataFrame, key: str = "flow", document: str = "document") -> DataFrame:
    """One row per step of each typed document; ``pos`` is the place in the document."""
    s = "step."
    return (
        documents.filter(F.col(document).isNotNull())
        .select(key, F.col(f"{document}.name").alias("flow_name"), F.posexplode(f"{document}.steps").alias("pos", "step"))
        .select(
            F.col(key).alias("flow"), "flow_name", F.col("pos").cast("bigint").alias("pos"), F.col(s + "name").alias("name"),
            F.col(s + "parents").alias("parents"), F.col(s + "order").cast("bigint").alias("ord"),
            F.col(s + "sql").alias("sql_text"), F.col(s + "output.tempView").alias("temp_view"),
            F.col(s + "output.table").alias("target_table"), F.col(s + "output.appendType").alias("append_type"),
            F.col(s + "description").alias("description"), F.col(s + "active").alias("active"),
        )
    )


def step_listing(steps: DataFrame) -> DataFrame:
    """Report line of each step; readers sort by (flow, ord, name)."""
    after = F.when(
        F.size("parents") > 0, F.concat(F.lit(" (depends on: "), F.array_join("parents", ", "), F.lit(")"))
    ).otherwise(" ")
    indent = F.when(F.size("parents") > 0, "  ").otherwise("")
    line = F.concat(indent, F.format_string("[%d] %s", F.col("ord"), F.col("name")), after)
    return steps.select("flow", "ord", "name", line.alias("line"), "sql_text", shorten("sql_text", 120).alias("sql_preview"))


def flow_variables(steps: DataFrame) -> DataFrame:
    """Table variables and parameters each step names."""
    kinds = F.array(
        F.struct(F.lit("table").alias("kind"), F.regexp_extract_all("sql_text", F.lit(r"\$\{(\w+)\}"), F.lit(1)).alias("names")),
        F.struct(F.lit("parameter").alias("kind"), F.regexp_extract_all("sql_text", F.lit(r"\$\[(\w+)\]"), F.lit(1)).alias("names")),
    )
    return (
        steps.select("flow", F.col("name").alias("step"), F.explode(kinds).alias("k"))
        .select("flow", "step", "k.kind", F.explode(F.array_distinct("k.names")).alias("variable"))
    )


def batch_items(descriptions: DataFrame, outcomes: DataFrame, key: list[str]) -> DataFrame:
    """Outcome of each description; one without outcome counts as failed. The
    texts stay whole, with their display forms beside them."""
    status = F.coalesce(F.col("status"), F.lit("failed"))
    shown = F.when((status == "failed") & (F.coalesce("error", F.lit("")) != ""), F.concat(F.lit("failed: "), F.left("error", F.lit(30)))).otherwise(status)
    return descriptions.join(outcomes, key, "left").select(
        *key, "description", shorten("description", 50).alias("description_short"), status.alias("status"), "error", shown.alias("status_text")
    )


def status_summary(items: DataFrame, by: list[str]) -> DataFrame:
    return items.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(F.col("status") == "success").alias("successful"))


# Prompt wording (fixed values: the texts a model is given).
GENERATE_HEAD = "Generate a Spark SQL ETL flow for the following business requirement:\n\n"
GENERATE_TAIL = "Respond with ONLY the JSON flow definition. No extra text."
EVALUATE_HEAD = "Evaluate the following Spark SQL ETL flow:\n\n```json\n"
EVALUATE_DESCRIPTION = "\n\nOriginal business description (use to verify correctness and completeness):\n\n"
TUNE_FEEDBACK = "\n\n---\nFeedback from previous evaluation (score < %s/10):\n"
TUNE_TAIL = "\n\nPlease address the feedback above and regenerate an improved Spark SQL flow."
RETRY_HEAD = "\n\n---\nThe previous response was NOT valid JSON. Error: "
RETRY_TAIL = (
    "\nFix the JSON syntax and respond with ONLY the JSON object — "
    "no explanations, no markdown, no code fences.\n"
)


def generation_prompt(description: Column | str, tables_text: Column | None = None) -> Column:
    description = F.col(description) if isinstance(description, str) else description
    parts = [F.lit(GENERATE_HEAD), description, F.lit("\n\n")]
    if tables_text is not None:
        parts.append(F.when(F.coalesce(tables_text, F.lit("")) != "", F.concat(tables_text, F.lit("\n\n"))).otherwise(""))
    return F.concat(*parts, F.lit(GENERATE_TAIL))


def flow_json(document: Column | str) -> Column:
    """A typed flow as JSON, all fields in the order of the contract."""
    return F.to_json(document, {"ignoreNullFields": "false"})


def evaluation_prompt(document: Column, description: Column | str) -> Column:
    """``document`` is the flow as JSON text, such as :func:`flow_json` of a typed one."""
    description = F.col(description) if isinstance(description, str) else description
    extra = F.when(F.coalesce(description, F.lit("")) != "", F.concat(F.lit(EVALUATE_DESCRIPTION), description)).otherwise("")
    return F.concat(F.lit(EVALUATE_HEAD), document, F.lit("\n```"), extra)


def tuned_description(description: Column, feedback: Column, threshold: float) -> Column:
    return F.concat(description, F.lit(TUNE_FEEDBACK % threshold), feedback, F.lit(TUNE_TAIL))


def tuning_rounds(judged: DataFrame, description: Column, threshold: float) -> DataFrame:
    """(flow, iteration, description): what each iteration that failed the gate leaves to the next one, the request of
    its flow with the feedback of this and all earlier failed iterations. ``description`` is made of ``flow``; answers of
    no flow have none. ``judged`` is the result of the gate; answers without a verdict add nothing, and a repeated row counts once."""
    failed = judged.filter("NOT passed AND flow IS NOT NULL").select("flow", "iteration", "feedback").distinct()
    so_far = Window.partitionBy("flow").orderBy("iteration", "feedback").rowsBetween(Window.unboundedPreceding, 0)
    told = failed.withColumn("_told", F.collect_list("feedback").over(so_far))
    return told.select("flow", "iteration", F.aggregate("_told", description, lambda d, f: tuned_description(d, f, threshold)).alias("description"))


def retry_prompt(prompt: Column, error: Column) -> Column:
    return F.concat(prompt, F.lit(RETRY_HEAD), error, F.lit(RETRY_TAIL))
