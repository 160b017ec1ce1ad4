import pytest
from pyspark.sql import functions as F

from flowspark.operators import graph as G
from flowspark.operators import lint as L

SCHEMA = (
    "flow BIGINT, pos BIGINT, ord BIGINT, flow_name STRING, name STRING, parents ARRAY<STRING>, temp_view STRING, "
    "target_table STRING, append_type STRING, description STRING, active BOOLEAN, sql_text STRING"
)


def table(spark, *flows):
    rows = []
    for flow, steps in enumerate(flows):
        for pos, (name, parents) in enumerate(steps):
            rows.append((flow, pos, pos, "F", name, parents, name, "", "REPLACE", "d", True, f"SELECT col FROM {' '.join(parents)}"))
    return spark.createDataFrame(rows, SCHEMA)


GRAPHS = [
    ("chain", [("a", []), ("b", ["a"]), ("c", ["b"]), ("d", ["c"])], [0, 1, 2, 3]),
    ("diamond", [("a", []), ("b", ["a"]), ("c", ["a"]), ("d", ["b", "c"])], [0, 1, 1, 2]),
    ("fan", [("s", [])] + [(f"c{i}", ["s"]) for i in range(5)], [0, 1, 1, 1, 1, 1]),
    ("roots", [("a", []), ("b", []), ("c", [])], [0, 0, 0]),
    ("two arms", [("a", []), ("b", ["a"]), ("c", ["a"]), ("d", ["b"]), ("e", ["c"]), ("f", ["d", "e"])], [0, 1, 1, 2, 2, 3]),
    ("children first", [("c", ["b"]), ("b", ["a"]), ("a", [])], [2, 1, 0]),
    ("cycle", [("a", []), ("x", ["y"]), ("y", ["x"]), ("z", ["y", "a"])], [0, 1, 2, 3]),
    ("all cycle", [("x", ["y"]), ("y", ["x"])], [1, 2]),
    ("unknown parent", [("a", []), ("b", ["nowhere"]), ("c", ["b"])], [0, 1, 2]),
    ("repeated parent", [("a", []), ("b", ["a", "a"])], [0, 1]),
    ("self", [("a", ["a"]), ("b", [])], [1, 0]),
]


def test_levels(spark):
    got = G.step_levels(table(spark, *[g for _, g, _ in GRAPHS])).collect()
    levels = {(r.flow, r.name): r.level for r in got}
    for flow, (title, steps, expected) in enumerate(GRAPHS):
        assert [levels[flow, n] for n, _ in steps] == expected, title


def test_long_chain_in_few_rounds(spark, monkeypatch):
    """200 steps in a row, chains that meet, and a chain that hangs on a cycle."""
    chain = [("s0", [])] + [(f"s{k}", [f"s{k - 1}"]) for k in range(1, 200)]
    arms = [("a0", [])] + [(f"a{k}", [f"a{k - 1}"]) for k in range(1, 50)] + [("m", ["a49", "a3", "a0"]), ("n", ["m"])]
    ring = [("x", ["z"]), ("y", ["x"]), ("z", ["y"])] + [(f"t{k}", [f"t{k - 1}" if k else "z"]) for k in range(30)] + [("r", []), ("q", ["t9", "r"])]
    stored = []
    real = G.cut_lineage

    def counting(df):
        stored.append(df.columns)
        return real(df)

    monkeypatch.setattr(G, "cut_lineage", counting)
    for steps, expected in ((chain, list(range(200))), (arms, [*range(50), 50, 51]), (ring, None)):
        stored.clear()
        got = {r.name: (r.level, r.placed) for r in G.step_levels(table(spark, steps)).collect()}
        assert sum("open" in c for c in stored) + sum("need" in c for c in stored) <= 12
        if expected:
            assert [got[n] for n, _ in steps] == [(e, True) for e in expected]
        else:
            assert [n for n, (_, placed) in got.items() if placed] == ["r"] and got["x"] == (1, False) and got["q"] == (34, False)


def test_last_definition_of_a_name_counts(spark):
    got = G.step_levels(table(spark, [("a", []), ("b", []), ("b", ["a"])])).collect()
    assert {r.name: r.level for r in got} == {"a": 0, "b": 1}


@pytest.mark.parametrize("children, threshold, found", [(5, 3, 1), (2, 3, 0), (3, 3, 0), (3, 2, 1)])
def test_fan_out(spark, children, threshold, found):
    steps = table(spark, [("s", [])] + [(f"c{i}", ["s"]) for i in range(children)])
    rows = G.fan_out(steps, threshold).collect()
    assert len(rows) == found and all(r.children == children for r in rows)


def test_one_very_large_flow(spark):
    """A flow with thousands of steps is spread like any other rows."""
    n = 3000
    rows = spark.range(n).select(
        F.lit(0).cast("bigint").alias("flow"), F.col("id").alias("pos"), F.col("id").alias("ord"), F.concat(F.lit("s"), "id").alias("name"),
        F.when(F.col("id") < 30, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("s"), (F.col("id") % 30).cast("string")))).alias("parents"),
    )
    levels = G.step_levels(rows).groupBy("level").count().collect()
    assert {r.level: r["count"] for r in levels} == {0: 30, 1: n - 30}


def test_facts_travel_to_all_descendants_and_survive_cycles(spark):
    links = spark.createDataFrame([(0, "a", "b"), (0, "b", "c"), (0, "c", "b"), (0, "c", "d"), (1, "a", "b")], "flow BIGINT, parent STRING, child STRING")
    facts = spark.createDataFrame([(0, "a", "f")], "flow BIGINT, name STRING, fact STRING")
    assert sorted(r.name for r in G.inherited(links, facts).collect()) == ["b", "c", "d"]


def test_cycle_rule_leaves_unknown_parents_out(spark):
    steps = table(spark, [("a", ["nowhere"]), ("b", ["a"]), ("x", ["y"]), ("y", ["x"]), ("z", ["y"])])
    assert sorted(r.step for r in L.lint(steps, ["cycle"]).collect()) == ["x", "y", "z"]


def test_grandparent_view_is_upstream(spark):
    steps = table(spark, [("a", []), ("b", ["a"]), ("c", ["b"]), ("d", [])])
    steps = steps.withColumn("sql_text", F.when(F.col("name") == "c", "SELECT x FROM a JOIN d").otherwise(F.col("sql_text")))
    assert [(r.step, r.detail) for r in L.lint(steps, ["view_not_upstream"]).collect()] == [("c", "d")]


def test_comma_list_of_sources(spark):
    steps = table(spark, [("a", []), ("b", []), ("c", ["a", "b"])])
    sql = F.when(F.col("name") == "c", "SELECT x FROM a x, b AS y WHERE f(x.p, y.q) > 1").otherwise("SELECT 1 AS x")
    assert sorted(r.view for r in L.view_reads(steps.withColumn("sql_text", sql)).collect()) == ["a", "b"]


def test_numbering_in_stretches(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), (F.col("id") * 3).alias("p"))
    rows = G.numbered(df, "g", "p", width=100).collect()
    assert all(r.n == r.p // 6 + 1 for r in rows) and len(rows) == 5000


def _sql_steps(spark, *texts):
    rows = [(k, 0, 0, "F", f"LOAD_{k}", [], f"LOAD_{k}", "", "REPLACE", "d", True, text) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_text_rules_on_ctes_extract_aliases_and_nested_calls(spark):
    steps = _sql_steps(
        spark, "WITH c AS (SELECT a FROM ${T}), d AS (SELECT a FROM c) SELECT a FROM c JOIN d ON c.a = d.a",
        "SELECT EXTRACT(YEAR FROM day) AS y FROM ${T}", "SELECT a FROM real_table",
        "SELECT COALESCE(NULLIF(a, 0), 1) AS x\nFROM ${T}", "SELECT a, b\nFROM ${T}",
        "SELECT SUM(t.amount) AS s, AVG(cost) AS c FROM ${T} t WHERE cost IS NOT NULL",
    )
    found = lambda rule: sorted((r.flow, r.detail) for r in L.lint(steps, [rule]).collect())
    assert found("hardcoded_table") == [(2, "real_table")]
    assert [f for f, _ in found("columns_on_one_line")] == [4, 5]
    assert found("unsafe_aggregate") == [(5, "amount")]
