from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowspark.llm.mixing import mix, mixed, source_targets, word_count


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by clamping and sharing again, in plain Python."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        new = {s for s in names if s not in full and rest * weight[s] / open_ >= most * sizes[s]} if open_ else set()
        if not new:
            return {s: most * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        full |= new


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 10, None: 5}, {"a": 0, "b": 7}, {"é": 4, "z": 90, "Z": 3, None: 1000},
    {f"s{k}": k * k for k in range(40)},
])
def test_targets(spark, sizes):
    table = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
    got = {r["source"]: r["target"] for r in source_targets(table, (5.0, 2.0, 1.0), 3).collect()}
    assert got == pytest.approx(water(sizes))


def test_mix_comes_near_targets_and_repeats(docs):
    rows = mix(docs, word_count()).select("doc_id", "source", word_count().alias("size"), "source_size", "target", "copies", "taken").collect()
    sizes, taken, longest, target = defaultdict(int), defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
        target[r["source"]] = r["target"]
    assert target == pytest.approx(water(dict(sizes)))
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)
    again = mix(docs.repartition(7), word_count()).select("doc_id", "source", word_count().alias("size"), "source_size", "target", "copies", "taken").collect()
    assert sorted(rows) == sorted(again)


def test_large_source_is_cut_in_slices(spark):
    table = spark.range(20_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', 's' || id % 5) AS source", "id % 50 + 1 AS n")
    rows = mix(table, F.col("n"), identity=["doc_id"]).groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 25 for r in rows)


def test_odd_rows(odd_docs, no_docs):
    found = mix(odd_docs, word_count())
    assert found.count() == odd_docs.count()
    assert {"kept", "size", "score"} <= set(found.columns) and dict(found.dtypes)["target"] == "double"
    assert mixed(odd_docs, word_count()).columns == odd_docs.columns
    assert mix(no_docs, word_count()).count() == 0
