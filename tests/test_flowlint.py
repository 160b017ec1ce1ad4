"""Small flows are judged flow by flow, with the findings that the joins give."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowspark.operators import flowlint
from flowspark.operators import lint as L

SCHEMA = "flow long, pos long, ord long, flow_name string, name string, parents array<string>, temp_view string, target_table string, description string, active boolean, sql_text string"


def flow_rows(flow, n, rng, odd=False):
    """Steps with repeated names, cycles, unknown parents, parents twice, shared views and reads of every kind."""
    names = [f"{rng.choice(['LOAD', 'SAVE', 'x'])}_{rng.randrange(max(2, n))}" for _ in range(n)]
    texts = [
        "SELECT a, b FROM {v} x JOIN {w} ON x.a = y.a WHERE a IS NOT NULL", "WITH {w} AS (SELECT 1) SELECT SUM(x.a), avg( b ) FROM {w}, {v} WHERE b is not null",
        "select sum(A) from ${{T{k}}} JOIN ware.house", "SELECT EXTRACT(YEAR FROM d) FROM ${{T1}}", "", "SELECT SUM(c) FROM Ünï, {v}",
    ]
    for i, name in enumerate(names):
        view = lambda: f"V{rng.randrange(n + 1)}".upper() if rng.random() < 0.5 else f"v{rng.randrange(n + 1)}"  # noqa: B023, E731
        parents = [rng.choice([*names, "gone", names[max(i - 1, 0)]]) for _ in range(rng.choice([0, 0, 1, 1, 2, 3]))]
        row = [
            flow, i * 2 - 1, rng.randrange(4), f"F_{flow}", name, parents, view(), rng.choice(["", "OUT"]), rng.choice(["", "d"]), rng.random() < 0.7,
            rng.choice(texts).format(v=view(), w=view(), k=rng.randrange(3)),
        ]
        if odd and rng.random() < 0.2:
            row[rng.choice([1, 2, 4, 5, 6, 7, 9, 10])] = None
        yield tuple(row)


@pytest.fixture(scope="module")
def flows(spark):
    rng = random.Random(5)
    rows = [r for f in range(40) for r in flow_rows(f, rng.choice([1, 2, 3, 5, 9, 20]), rng)]
    rows += [r for f in range(100, 110) for r in flow_rows(f, 6, rng, odd=True)] + list(flow_rows(None, 5, rng))
    rows += [(200, i, i, "LONG", f"S{i}", [f"S{i - 1}"] if i else [], f"S{i}", "", "", True, f"SELECT a FROM S{i - 3} WHERE a IS NOT NULL") for i in range(12)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).localCheckpoint()


def found(df):
    return sorted(tuple(map(str, r)) for r in df.select("flow", "step", "rule", "detail").collect())


@pytest.fixture(scope="module")
def by_joins(flows):
    shared = L.Shared(flows)
    return {rule: found(judge(shared)) for rule, judge in L.GRAPH_RULES.items()}


def test_findings_are_those_of_the_joins(flows, by_joins):
    assert all(by_joins.values())
    got = found(L.lint(flows, list(L.GRAPH_RULES)))
    assert got == sorted(r for rows in by_joins.values() for r in rows)


def test_large_flows_go_through_joins_with_the_same_findings(flows, by_joins, monkeypatch):
    monkeypatch.setattr(L, "SMALL_ROWS", 9)
    small, large = L.small_and_large(flows)
    assert large.filter("flow = 200").count() == 12 and small.filter("flow = 200 OR flow IS NULL OR name IS NULL").count() == 0
    assert small.count() + large.count() == flows.count()
    two = ["cycle", "view_not_upstream"]
    assert found(L.lint(flows, two)) == sorted(by_joins["cycle"] + by_joins["view_not_upstream"])


def test_chunks_are_whole_flows_and_parts_agree(flows, by_joins, monkeypatch):
    columns = ["flow", "name", "pos", "ord", "active", "target_table", "parents"]
    small, _ = L.small_and_large(flows)
    rows = small.select(
        *columns, F.lower("temp_view").alias("view"), L._targets().alias("targets"), F.transform(L._targets(), F.lower).alias("target_views"),
        L._found(L.NOT_NULL).alias("filters"), L._found(L.TABLE_VARIABLE, False).alias("sources"), L._found(L.BARE_SUM).alias("summed"),
    ).orderBy("flow").toArrow()
    rules = set(L.GRAPH_RULES)
    results = []
    for most, marks in ((1 << 16, 1 << 26), (7, 1 << 26), (50, 30)):
        monkeypatch.setattr(flowlint, "CHUNK_ROWS", most)
        monkeypatch.setattr(flowlint, "MARKS", marks)
        parts = list(flowlint.chunks(iter(rows.to_batches(max_chunksize=4))))
        assert sum(p.num_rows for p in parts) == rows.num_rows
        ids = [f for p in parts for f in set(p["flow"].to_pylist())]
        assert len(ids) == len(set(ids)) and (len(parts) > 1 or most == 1 << 16)
        results.append(sorted(tuple(r.values()) for p in parts for b in flowlint.findings(p, rules) for r in pa.Table.from_batches([b]).to_pylist()))
    assert results[0] and results[0] == results[1] == results[2]


def test_small_flows_take_few_shuffles(flows):
    """Where all flows are small, no join is left, and steps are dealt once."""
    whole = flows.filter("flow < 100")
    plan = L.lint(whole)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression") == 1


def test_empty_table(flows):
    assert L.lint(flows.limit(0)).collect() == []
