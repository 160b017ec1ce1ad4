import itertools
from collections import Counter

import numpy as np
import pytest
from plain_words import WORD, words
from pyspark.sql import functions as F

from flowspark.llm import linecrf


def counts(text):
    """The base figures in plain Python."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + j for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_counts_of_documents(docs):
    for r in linecrf.judge(docs, None, keep=["text"]).collect():
        assert tuple(r[c] for c in BASE) == counts(r["text"])
        assert r["kept"] is not r["base_failed"]


def test_odd_rows(odd_docs, no_docs, labels):
    rows = linecrf.judge(odd_docs, linecrf.train(odd_docs, labels.selectExpr("doc_id", "quality = 1 AS good")), keep=odd_docs.columns).collect()
    assert len(rows) == odd_docs.count() and {r["target"] for r in rows} == {"mine"}
    for r in rows:
        assert tuple(r[c] for c in BASE) == counts(r["text"])
    lines = ["\n\n a\n a\n b \n\na a a a a a", "x\ny\nx\n y\nx", "\n", "a\x0bb\nc\td", "#*$%&|<>\n#*$%&|<>"]
    df = odd_docs.sparkSession.createDataFrame([(x,) for x in lines], "text string").withColumn("doc_id", F.lit(1))
    for r in linecrf.judge(df, None, keep=["text"]).collect():
        assert tuple(r[c] for c in BASE) == counts(r["text"])
    assert linecrf.judge(no_docs, None).count() == 0
    assert linecrf.train(no_docs, labels.selectExpr("doc_id", "quality = 1 AS good")) is None
    assert linecrf.train(odd_docs, labels.selectExpr("doc_id", "true AS good")) is None


def test_training_runs_lie_anywhere():
    r = np.random.default_rng(0)
    starts = []
    for _ in range(300):
        features = r.random((100, 3))
        run = linecrf.run_of_lines(features, 40)
        starts.append(int(np.flatnonzero((features == run[0]).all(axis=1))[0]))
        assert (run == features[starts[-1] : starts[-1] + 40]).all()
    assert min(starts) < 5 and max(starts) > 55
    assert (linecrf.run_of_lines(features, 100) == features).all()


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(2)
    model = linecrf.Model(r.normal(size=(3, 2)), r.normal(size=(2, 2)), r.normal(size=2))
    sizes = [0, 1, 5, 0, 3, 8]
    at = np.concatenate([[0], np.cumsum(sizes)])
    scores = r.normal(size=(at[-1], 2))
    label = linecrf.viterbi(scores, at, model)
    for a, b in zip(at[:-1], at[1:]):
        if b > a:
            def total(path):
                s = scores[a:b]
                return model.first[path[0]] + sum(s[k, y] for k, y in enumerate(path)) + sum(model.pair[x, y] for x, y in zip(path, path[1:]))

            assert tuple(label[a:b]) == max(itertools.product((0, 1), repeat=int(b - a)), key=total)


def test_fit_is_the_gradient_of_the_likelihood():
    """Two chains, all paths written out: the fitted model is no worse than its neighbours."""
    chains = [np.array([[1, 0.2], [1, 0.9], [1, 0.4]]), np.array([[1, 2.0], [1, 1.1]])]
    model = linecrf.fit(chains, [0, 1], rounds=400)

    def value(w, pair, first):
        out = 0.0
        for c, y in zip(chains, (0, 1)):
            s = c @ w
            scores = {p: first[p[0]] + sum(s[k, z] for k, z in enumerate(p)) + sum(pair[u, v] for u, v in zip(p, p[1:])) for p in itertools.product((0, 1), repeat=len(c))}
            out += 0.5 / len(c) * (scores[(y,) * len(c)] - np.log(sum(np.exp(v) for v in scores.values())))
        return out - 0.5 * 1e-3 * sum((x**2).sum() for x in (w, pair, first))

    best = value(model.weight, model.pair, model.first)
    for part in (model.weight, model.pair, model.first):
        for k in np.ndindex(part.shape):
            for step in (-0.3, 0.3):
                part[k] += step
                assert value(model.weight, model.pair, model.first) <= best + 1e-3
                part[k] -= step


def test_junk_goes_and_prose_stays(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd = labels.filter("doc_id % 2 = 1").selectExpr("doc_id", "quality = 1 AS good")
    rows = linecrf.judge(docs, linecrf.train(docs, odd)).join(labels.filter("doc_id % 2 = 0"), "doc_id").filter("NOT base_failed").collect()
    share = lambda q: np.mean([r["kept"] for r in rows if r["quality"] == q])
    assert share(1) > 0.97 and share(0) < 0.2


@pytest.mark.parametrize("text,good", [("word " * 3, False), (" ".join(f"w{k}" for k in range(60)), True)])
def test_base_rules_come_first(spark, text, good):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert linecrf.judge(df, None).first()["kept"] is good
