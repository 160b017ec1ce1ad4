import math

import numpy as np
import pytest
from compare import oracle, rows

from flowspark.llm import mtree
from flowspark.llm.queries import mtree as registered


def brute(table, every, k, scale=256):
    good = []
    for vec_id, v in table:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((vec_id, tuple(math.floor(x * scale) for x in v)))
    out = []
    for q, v in set(x for x in good if x[0] % every == 0):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in good if c != q and len(w) == len(v))[:k]
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores)]
    return sorted(out)


def vectors(spark, table):
    return spark.createDataFrame(table, "vec_id long, embedding array<float>")


def search(spark, table, **options):
    return sorted(map(tuple, mtree.top_k(vectors(spark, table), **options).collect()))


def test_query_agrees_with_sql(spark, sf):
    df = registered.query(spark, sf)
    rel = oracle(sf).sql(registered.SQL)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(rel.columns, rel.fetchall())


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    table = [
        (0, [0.5, 0.25]), (0, [0.5, 0.25]), (10, None), (20, [0.5, None]), (30, [nan, 1.0]), (40, [inf, 1.0]), (50, [-0.001, 0.999]), (None, [1.0, 1.0]),
        (3, [0.5, 0.25]), (2, [0.5, 0.25]), (7, [1.0, 2.0, 3.0]), (60, [1.0, 2.0, 3.0]), (5, []), (70, []), (8, [-1.0, -1.0]), (4, [0.5, 0.25]), (4, [0.5, 0.25]),
    ]
    assert search(spark, table, every=10, k=4) == brute(table, 10, 4)
    assert search(spark, [], every=10) == []


def test_wide_vectors(spark):
    """Components whose products pass 2^53 or 64 bits, beside plain ones."""
    table = [
        (0, [0.5, 0.25]), (1, [1e10, 1.0]), (2, [1e7, -3.0]), (10, [1e10, 3.0]), (20, [-1e7, 2.5]), (3, [0.25, 0.125]), (30, [1e5, 1e5]), (4, [1e5, -2.0]), (5, [3e38, 3e38]),
        (40, [-3e38, 1.0]), (6, [1e10]),
    ]
    table = [(i, [float(np.float32(x)) for x in v]) for i, v in table]
    low, high = -(1 << 63), (1 << 63) - 1
    want = []
    for q, v in ((i, [math.floor(x * 256) for x in v]) for i, v in table if i % 10 == 0):
        scores = [(-min(high, max(low, sum(a * math.floor(b * 256) for a, b in zip(v, w)))), c) for c, w in table if c != q and len(w) == len(v)]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(scores)[:4])]
    assert search(spark, table, every=10, k=4) == sorted(want)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_clusters_and_copies(spark, monkeypatch, spread):
    monkeypatch.setattr(mtree, "TREE_VECTORS", 300)
    monkeypatch.setattr(mtree, "BLOCK", 20)
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 12))
    v = centres[r.integers(0, 6, 1500)] + spread * r.normal(size=(1500, 12))
    v[200:700] = v[200]  # one vector of a third of the rows
    table = [(int(k), [float(np.float32(x)) for x in row]) for k, row in enumerate(v)]
    assert search(spark, table, every=25) == brute(table, 25, 5)


def test_bounds_save_distances(monkeypatch):
    monkeypatch.setattr(mtree, "LEAF", 48)
    r = np.random.default_rng(1)
    centres = r.integers(-400, 400, (40, 16))
    v = (centres[r.integers(0, 40, 4000)] + r.integers(-9, 10, (4000, 16))).astype(np.int32)
    bound = float((v.astype(float) ** 2).sum(axis=1).max())
    nodes = mtree.build_tree(np.arange(4000), v, bound)
    leaves = [n for n in nodes if n["leaf"]]
    assert sorted(i for n in leaves for i in n["ids"]) == list(range(4000)) and max(len(n["ids"]) for n in leaves) <= mtree.LEAF
    for n in nodes:
        if n["parent"] >= 0:
            assert n["parent_distance"] == pytest.approx(float(np.linalg.norm(nodes[n["parent"]]["pivot"] - n["pivot"])))
    import pandas as pd

    tree = mtree.Tree(pd.DataFrame([n | {"vectors": n["vectors"].ravel()} for n in nodes]), bound)
    looked = 0
    real = mtree._distances
    for q in range(0, 4000, 400):
        ids, products = tree.search(v[q].astype(float), q, 5, -np.inf)
        scores = v.astype(np.int64) @ v[q].astype(np.int64)
        best = [i for i in np.lexsort((np.arange(4000), -scores)) if i != q][:5]
        assert ids.tolist() == best and products.tolist() == scores[best].tolist()
        counted = []
        mtree._distances = lambda a, b: counted.append(len(a)) or real(a, b)
        tree.search(v[q].astype(float), q, 5, -np.inf)
        mtree._distances = real
        looked += sum(counted)
    assert looked < 10 * len(nodes) * 0.7
