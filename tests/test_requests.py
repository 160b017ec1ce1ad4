import pytest
from pyspark.sql import functions as F

from flowspark.operators import requests as R


def one(spark, columns, **values):
    df = spark.range(1).select(*[F.lit(v).cast("string" if v is None else type(v).__name__.replace("str", "string").replace("int", "bigint")).alias(k) for k, v in values.items()])
    return columns(df).first()


PROVIDERS = {"openai": "gpt-4o-mini", "opencode": None}
RULES = [("invoice|sales", "openai", "gpt-4o"), ("log|sales", "opencode", "flash")]


@pytest.mark.parametrize(
    "model, prompt, expected",
    [
        ("openai", "sales", ("openai", "gpt-4o-mini")),
        ("opencode", "sales", ("opencode", "opencode")),
        ("gpt-4", "SALES report", ("openai", "gpt-4o")),
        ("gpt-4", "debug LOG", ("opencode", "flash")),
        ("gpt-4", "other", ("openai", "gpt-4")),
        ("", "other", ("openai", "gpt-4o")),
    ],
)
def test_route(spark, model, prompt, expected):
    row = one(spark, lambda d: R.route(d, PROVIDERS, RULES), model=model, prompt=prompt)
    assert (row.provider, row.routed_model) == expected


def test_route_without_providers(spark):
    row = one(spark, lambda d: R.route(d, {}, []), model="m", prompt="x")
    assert (row.provider, row.routed_model) == ("opencode", "m")


def test_model_name_wins_for_a_named_provider(spark):
    row = one(spark, lambda d: R.route(d, PROVIDERS, RULES, model_name="model_name"), model="openai", prompt="x", model_name="own")
    assert row.routed_model == "own"


def test_user_text_is_the_first_user_message(spark):
    df = spark.sql("SELECT array(named_struct('role','system','content','s'), named_struct('role','user','content','a'), named_struct('role','user','content','b')) AS m, array(named_struct('role','system','content','s')) AS n")
    assert tuple(df.select(R.user_text("m"), R.user_text("n")).first()) == ("a", "")


def test_cost(spark):
    row = one(spark, lambda d: d.select(R.cost("model", "p", "c").alias("cost")), model="gpt-4o", p=1000, c=2000)
    assert row.cost == pytest.approx(0.0025 + 0.02)
    row = one(spark, lambda d: d.select(R.cost("model", "p", "c").alias("cost")), model="gpt-4o-2024", p=1000, c=2000)
    assert row.cost == pytest.approx(0.001 + 0.004)


def test_keys_depend_on_model_and_messages_only(spark):
    rows = [(1, 0, "user", "a", "m"), (1, 1, "user", "b", "m"), (2, 0, "user", "a", "m"), (2, 1, "user", "b", "m"),
            (3, 0, "user", "b", "m"), (3, 1, "user", "a", "m"), (4, 0, "user", "a", "n"), (4, 1, "user", "b", "n")]
    df = spark.createDataFrame(rows, "id INT, turn INT, role STRING, text STRING, model STRING")
    keys = {r.id: r.request_key for r in R.message_key(df, "id", "model", "turn").collect()}
    assert keys[1] == keys[2] and len(set(keys.values())) == 3


def test_access(spark):
    calls = spark.createDataFrame([(1, None), (2, ""), (3, "good"), (4, "empty"), (5, "strange")], "id INT, api_key STRING")
    grants = spark.createDataFrame([("good", ["openai"]), ("empty", [])], "api_key STRING, providers ARRAY<STRING>")
    got = {r.id: r.http_status for r in R.access_check(calls, grants).collect()}
    assert got == {1: 401, 2: 401, 3: 200, 4: 403, 5: 403}
    assert {r.http_status for r in R.access_check(calls, None).collect()} == {200}
    strict = R.access_check(calls.withColumn("provider", F.lit("opencode")), grants, provider="provider")
    assert {r.http_status for r in strict.filter("id = 3").collect()} == {403}


@pytest.mark.parametrize("header, other, key", [("Bearer abc ", None, "abc"), ("Basic abc", "x", "x"), ("Bearer ", "x", "x"), (None, None, "")])
def test_bearer_key(spark, header, other, key):
    df = spark.createDataFrame([(header, other)], "a STRING, x STRING")
    assert df.select(R.bearer_key(F.col("a"), F.col("x"))).first()[0] == key


def test_fallback(spark):
    rows = [(1, 0, False, "a"), (1, 1, True, "b"), (1, 2, True, "c"), (2, 0, False, "a")]
    df = spark.createDataFrame(rows, "r INT, pos INT, ok BOOLEAN, provider STRING")
    got = {x.r: (x.status, x.provider, x.tries) for x in R.resolve_fallback(df, "r", "pos", "ok", "provider").collect()}
    assert got == {1: ("success", "b", 3), 2: ("failed", None, 1)}


def test_catalog_and_purge(spark):
    rules = spark.createDataFrame([(2, "a", "m"), (1, "a", "m"), (3, "b", "n")], "rule_no INT, provider STRING, model STRING")
    spare = spark.createDataFrame([("c", None, 1)], "provider STRING, model STRING, place INT")
    assert sorted(r.id for r in R.model_catalog(rules, spare).collect()) == ["a/m", "b/n"]
    assert [r.id for r in R.model_catalog(rules.limit(0), spare).collect()] == ["c/gpt-4o"]
    left, removed = R.purge(rules, "m")
    assert (left.count(), removed.first().removed) == (1, 2)
    left, removed = R.purge(rules)
    assert (left.count(), removed.first().removed) == (0, 3)


def test_both_forms_of_the_key_agree_and_separators_do_not_collide(spark):
    long = [("user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(300)]
    requests = [
        ("m", [("user", "a"), ("assistant", "b")]), ("m", [("assistant", "b"), ("user", "a")]), ("n", [("user", "a"), ("assistant", "b")]),
        ("m", [("user|a", "b")]), ("m", [("user", "a|b")]), ("m", [("user", "")]), ("m", [("user", None)]), ("m", [(None, "x")]), ("m", [("", "x")]),
        ("m", [("user", "a"), ("user", "a")]), ("m", [("user", "a")]), (None, [("user", "a")]), ("", [("user", "a")]), ("m", long), ("m", long[::-1]),
    ]
    arrays = spark.createDataFrame(
        [(i, m, [{"role": r, "content": c} for r, c in messages]) for i, (m, messages) in enumerate(requests)],
        "id int, model string, messages array<struct<role: string, content: string>>",
    )
    whole = {r.id: r.request_key for r in arrays.select("id", R.request_key("model", "messages").alias("request_key")).collect()}
    assert len(set(whole.values())) == len(requests)
    schema = "id int, model string, turn bigint, role string, text string"
    for first, step in ((0, 1), (1, 1), (-7, 100_003)):  # other numbers, same order
        rows = [(i, m, first + step * t, r, c) for i, (m, messages) in enumerate(requests) for t, (r, c) in enumerate(messages)]
        keys = R.message_key(spark.createDataFrame(rows, schema).repartition(5), "id", "model", "turn")
        assert {r.id: r.request_key for r in keys.collect()} == whole
    odd = [(None, "m", None, "user", "a"), (None, "m", 5, "assistant", "b")]
    got = R.message_key(spark.createDataFrame(odd, schema), "id", "model", "turn").collect()
    assert [(r.id, r.request_key) for r in got] == [(None, whole[0])]
