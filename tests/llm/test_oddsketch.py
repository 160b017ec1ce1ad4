import itertools

import numpy as np
import pyarrow as pa
import pytest
from plain_words import words

from flowspark.llm import oddsketch


def sets_of(rows, width):
    out = []
    for doc_id, text in rows:
        w = words(text, lower=True)
        grams = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
        out.append((doc_id, frozenset(grams)))
    return out


def brute(rows, width, percent):
    """(doc_id, size, component) of each row with an id, by comparing all pairs."""
    named = [x for x in sets_of(rows, width) if x[0] is not None]
    root = {d: d for d, _ in named}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, x), (b, y) in itertools.combinations(named, 2):
        both = len(x & y)
        if both and 100 * both >= percent * (len(x) + len(y) - both):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted((d, len(s), find(d)) for d, s in named)


def found(df, width, percent=80):
    rows = oddsketch.near_duplicates(df, width, percent).collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows if r["doc_id"] is not None)
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None)


@pytest.mark.parametrize("width", [2, 5])
def test_documents(docs, width):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, width) == brute(rows, width, 80)


def _edited(seed, copies, length, edits):
    """Copies of one text with a few other words each; chains and thresholds occur on their own."""
    r = np.random.default_rng(seed)
    base = [f"b{k}" for k in range(length)]
    out = []
    for k in range(copies):
        w = list(base)
        for at in r.integers(0, length, r.integers(0, edits + 1)):
            w[at] = f"e{r.integers(0, 4)}"
        out.append(" ".join(w))
    return out


def test_large_groups_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(oddsketch, "BLOCK", 16)
    monkeypatch.setattr(oddsketch, "WIDE_BLOCK", 32)
    texts = _edited(1, 220, 60, 9) + _edited(2, 60, 25, 4) + ["same text in many rows"] * 50
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, 2) == brute(rows, 2, 80)


def test_small_blocks_leave_the_rest_to_the_comparison_across(spark, monkeypatch):
    monkeypatch.setattr(oddsketch, "BLOCK", 1)
    monkeypatch.setattr(oddsketch, "WIDE_BLOCK", 8)
    rows = list(enumerate(_edited(4, 60, 40, 6)))
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), 2) == brute(rows, 2, 80)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert found(odd_docs, 2) == brute(rows, 2, 80)
    assert oddsketch.near_duplicates(no_docs).count() == 0
    kept = oddsketch.deduplicated(odd_docs, width=2)
    expected = {d for d, _, c in brute(rows, 2, 80) if d == c}
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == odd_docs.columns and sorted(i for i in ids if i is not None) == sorted(expected) and ids.count(None) == 1


def test_sketches_estimate_and_bound():
    r = np.random.default_rng(0)
    common = [f"c{k}" for k in range(400)]
    for similarity in (0.8, 0.9):
        own = round(400 * (1 - similarity) / similarity / 2)
        texts = [" ".join(common + [f"{s}{r.integers(1 << 40)}" for _ in range(own)]) for s in "ab" for _ in range(25)]
        (_, grams, at), = oddsketch._sorted_sets(pa.array(texts), 1)
        sketch = oddsketch._signatures(grams, at)[3].astype(np.uint64)
        apart = [int(sum(int(x).bit_count() for x in sketch[a] ^ sketch[b])) for a in range(25) for b in range(25, 50)]
        assert max(apart) <= oddsketch.farthest(similarity)
        m = 2 * oddsketch.SAMPLES * (1 - similarity)
        assert np.mean(apart) == pytest.approx(oddsketch.SKETCH_BITS / 2 * (1 - np.exp(-2 * m / oddsketch.SKETCH_BITS)), rel=0.1)


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, 200), (200, 100), (7, 7), (300, 299)]
    got = dict(map(tuple, oddsketch.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 200: 100, 299: 299, 300: 299}
