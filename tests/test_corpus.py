import json

import pytest
from pyspark.sql import functions as F

from flowspark.functions.text import error_class, json_object, safe_name
from flowspark.operators import corpus as C


def document(**step):
    base = {
        "name": "LOAD_A", "parents": [], "order": 1, "sql": "SELECT 1", "output": {"tempView": "LOAD_A"},
        "diagram": {"x": 1, "y": 2}, "createdDate": {"$date": "2026-05-15T01:44:25.911Z"},
    }
    base.update(step)
    return {"name": "F", "steps": [{k: v for k, v in base.items() if v is not None}]}


GOOD = json.dumps(document())

CASES = [
    (GOOD, "ok", False),
    (f"  \n{GOOD}\n ", "ok", False),
    (f"```json\n{GOOD}\n```", "ok", False),
    (f"```\n{GOOD}\n```", "ok", False),
    (f"text before\n```json\n{GOOD}\n```\nand after", "ok", False),
    (f"The flow {GOOD} as asked", "ok", False),
    ("no json here", "no_json", False),
    ("", "no_json", False),
    ('{"name": "F", "steps": [', "no_json", True),
    ("} {", "no_json", True),
    ('{"name": "F", "steps": [}', "bad_json", False),
    (GOOD + " " + GOOD, "bad_json", False),
    (GOOD + ',"w":{"a":1}', "bad_json", False),
    ("Options: [" + GOOD + "] and [" + GOOD + "]", "bad_json", False),
    (GOOD + "}} {{" + GOOD, "bad_json", False),
    (GOOD.replace('"', "'"), "bad_json", False),
    ('{"a": 1}', "invalid_flow", False),
    ('{"name": "F", "steps": {}}', "invalid_flow", False),
    ('{"name": "F", "steps": []}', "ok", False),
    (json.dumps(document(order="2")), "ok", False),
    (json.dumps(document(order=2.0)), "ok", False),
    (json.dumps(document(order=2.5)), "invalid_flow", False),
    (json.dumps(document(order="two")), "invalid_flow", False),
    (json.dumps(document(order=None)), "invalid_flow", False),
    (json.dumps(document(name=5)), "invalid_flow", False),
    (json.dumps(document(output={})), "invalid_flow", False),
    (json.dumps(document(output="LOAD_A")), "invalid_flow", False),
    (json.dumps(document(parents=["a", 1])), "invalid_flow", False),
    (json.dumps(document(active="yes")), "ok", False),
    (json.dumps(document(active="maybe")), "invalid_flow", False),
    (json.dumps(document(createdDate={"date": "2026-05-15"})), "ok", False),
    (json.dumps(document(createdDate={"$date": "yesterday"})), "invalid_flow", False),
    (json.dumps({**document(), "extra": {"a": [1]}}), "ok", False),
]


def test_answers_are_classified(spark):
    rows = [(i, text) for i, (text, _, _) in enumerate(CASES)]
    got = {r.i: (r.status, r.truncated) for r in C.parse_flows(spark.createDataFrame(rows, "i INT, response STRING")).collect()}
    wrong = {CASES[i][0]: v for i, v in got.items() if v != CASES[i][1:]}
    assert wrong == {}


REASONS = [
    (document(order=None), "steps[0].order: a whole number expected"),
    (document(order="two", sql=None), "steps[0].order: a whole number expected"),
    (document(name=5, order=None), "steps[0].name: text expected"),
    (document(output="LOAD_A"), "steps[0].output.tempView: text expected"),
    (document(output={"tempView": "A", "table": 1}), "steps[0].output.table: text expected"),
    (document(parents=["a", 1]), "steps[0].parents: a list of texts expected"),
    (document(diagram={"x": 1}), "steps[0].diagram.y: a whole number expected"),
    (document(active="maybe"), "steps[0].active: true or false expected"),
    (document(createdDate={"$date": "yesterday"}), "steps[0].createdDate: a time under $date expected"),
    ({**document(), "name": None}, "name: text expected"),
    ({"name": "F"}, "steps: a list of steps expected"),
    ({"name": "F", "steps": document()["steps"] * 2 + document(order=1.5)["steps"] + document(sql=3)["steps"]}, "steps[2].order: a whole number expected"),
    ({"name": "F", "steps": [*document()["steps"], 7]}, "steps: a list of steps expected"),
]


def test_reason_names_the_first_failing_field(spark):
    rows = [(i, json.dumps(d)) for i, (d, _) in enumerate(REASONS)] + [(100, ""), (101, '{"a'), (102, GOOD + GOOD), (103, GOOD)]
    got = {r.i: r.reason for r in C.parse_flows(spark.createDataFrame(rows, "i INT, response STRING")).collect()}
    want = {i: r for i, (_, r) in enumerate(REASONS)}
    assert got == want | {100: C.NO_JSON, 101: C.NO_JSON + C.CUT_OFF, 102: C.BAD_JSON, 103: None}


def test_defaults_are_filled(spark):
    row = C.parse_flows(spark.createDataFrame([(GOOD,)], "response STRING")).first().document
    s = row.steps[0]
    assert (row.description, s.description, s.active, s.parents) == ("", "", True, [])
    assert (s.output.table, s.output.appendType, s.output.kafkaGroup) == ("", "REPLACE", "")
    assert s.createdDate["$date"] == "2026-05-15T01:44:25.911Z"


def test_filter_on_status_does_not_repeat_the_parse(spark):
    df = C.parse_flows(spark.createDataFrame([(GOOD,)], "response STRING")).filter("status = 'ok'").select("document")
    # once in each of the two wrappers that strict parsing demands
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2


@pytest.mark.parametrize(
    "provider, error, expected",
    [
        ("openai", "this API key is blank", "api_key"),
        ("openai", "host does not connect", "connection"),
        ("opencode", "connection to the Gateway lost", "gateway"),
        ("gateway", "timeout", "gateway"),
        ("openai", "unauthorized, will not connect", "authentication"),
        ("openai", "out of memory", None),
    ],
)
def test_error_class(spark, provider, error, expected):
    df = spark.createDataFrame([(provider, error)], "provider STRING, error STRING")
    assert df.select(error_class("error", "provider")).first()[0] == expected


def test_safe_name(spark):
    df = spark.createDataFrame([("a b/c\\d",)], "n STRING")
    assert df.select(safe_name("n")).first()[0] == "a_b_c_d"


def test_prompts(spark):
    df = spark.createDataFrame([("do it", "bad")], "d STRING, f STRING")
    r = df.select(
        C.generation_prompt("d").alias("g"), C.tuned_description(F.col("d"), F.col("f"), 8.5).alias("t"),
        C.evaluation_prompt(F.lit("{}"), F.lit(None).cast("string")).alias("e"),
    ).first()
    assert r.g.endswith("do it\n\nRespond with ONLY the JSON flow definition. No extra text.")
    assert "score < 8.5/10):\nbad\n\n" in r.t and r.e.endswith("```json\n{}\n```")


def test_tuned_descriptions_hold_all_feedback_so_far(spark):
    rows = [(7, 2, "b", False), (7, 1, "a", False), (7, 3, None, None), (7, 4, "c", True), (7, 5, "d", False), (7, 5, "d", False), (8, 1, "e", False), (None, 1, "f", False)]
    judged = spark.createDataFrame(rows, "flow long, iteration int, feedback string, passed boolean")
    got = {(r.flow, r.iteration): r.description for r in C.tuning_rounds(judged, F.col("flow").cast("string"), 8.5).collect()}

    def plain(description, *feedback):
        for f in feedback:
            description = f"{description}\n\n---\nFeedback from previous evaluation (score < 8.5/10):\n{f}\n\nPlease address the feedback above and regenerate an improved Spark SQL flow."
        return description

    assert got == {(7, 1): plain("7", "a"), (7, 2): plain("7", "a", "b"), (7, 5): plain("7", "a", "b", "d"), (8, 1): plain("8", "e")}


def test_tune_prompts_cover_judged_flows_and_answers_that_did_not_parse(spark, folder):
    """The answer of order 14 has no field order, so it fails; the judge's notes on documents 5 and 6, of flow 1, are below the gate."""
    from flowspark.catalog.corpus import tune_prompts

    spark.createDataFrame([(14, 1), (14, 2)], "l_orderkey long, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(5, 1), (6, 2)], "doc_id long, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(5, 0)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    rows = [(r.flow, r.prompt) for r in tune_prompts(spark, folder).collect()]
    assert sorted(flow for flow, _ in rows) == [1, 1, 14]
    again, = (p for flow, p in rows if flow == 14)
    assert "requirement:\n\n14\n\n" in again and "Error: steps[0].order: a whole number expected" in again
    tuned = sorted((p for flow, p in rows if flow == 1), key=len)
    assert [[f"note {d}\n" in p for d in (5, 6)] for p in tuned] == [[True, False], [True, True]]
    assert all(p.endswith("Respond with ONLY the JSON flow definition. No extra text.") for p in tuned)


def test_answers_are_parsed_in_one_pass_and_not_carried_on(spark):
    """Neither the text nor the loose document travels from one step of parsing to the next."""
    answers = spark.range(3).selectExpr("id AS flow", "concat('x {\"name\":\"a\",\"steps\":[]} y', id) AS response")
    parsed = C.parse_flows(answers)
    plan = parsed.select("flow", "status", "reason", "document")._jdf.queryExecution().optimizedPlan().toString()
    carried = [line for line in plan.splitlines() if "Generate explode" in line]
    assert len(carried) == 2 and plan.count("variant_get") and "response#" not in plan.split("Generate explode")[1]
    assert [r.status for r in parsed.collect()] == ["ok"] * 3 and parsed.columns[:3] == ["flow", "response", "json"]


def test_braces_are_found_in_one_pass(spark):
    texts = ["", None, "{", "}", "}{", "{}", "a{b}c}d", "}}{{}}x", "é{ü}ö", "{\n}\n", "```", "```{}", "```x{a", "x```{a}```{b}```", "{``` }", "``` {1} ``` {2}", "``````{}", "{" * 300_000, "{" * 300_000 + "}"]

    def plain(text):
        parts = (text or "").split("```", 2)
        inner = parts[1] if len(parts) == 3 else text or ""
        first, last = inner.find("{"), inner.rfind("}")
        return inner[first : last + 1] if -1 < first < last else None

    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string").select("k", json_object("t").alias("j")).orderBy("k").collect()
    assert [r.j for r in rows] == [plain(t) for t in texts]
