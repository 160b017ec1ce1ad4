import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowspark.llm import bwtspans
from flowspark.llm.bwtspans import _slices, remove_repeats, repeated_windows, segments
from flowspark.llm.queries import bwtspans as registered


def plain(texts, length):
    """(bytes, removed runs, kept bytes) of each text by counting all windows."""
    bodies = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for b in bodies:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1]).tolist()
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((len(b), list(zip(edges[::2], edges[1::2])), kept))
    return out


def found(docs, length):
    rows = remove_repeats(docs, length).collect()
    return sorted((r["doc_id"] is not None, r["doc_id"], r["n_bytes"], [tuple(x) for x in r["removed"]], bytes(r["kept"])) for r in rows)


def wanted(rows, length):
    return sorted((i is not None, i, *r) for (i, _), r in zip(rows, plain([t for _, t in rows], length)))


def words(seed, n, size=5):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefé") for _ in range(r.randrange(1, size))) for _ in range(n))


def passages():
    """Texts that share passages in other surroundings, repeat lines, are copies, or hold one byte throughout."""
    common, line = words(1, 60), words(2, 14) + "\n"
    rows = [(k, f"{words(100 + k, 20)} {common if k % 3 else common[7:90]} {words(200 + k, 30)}") for k in range(40)]
    rows += [(50, line * 9), (51, words(3, 40) + line * 3), (52, "z" * 900), (53, "z" * 400 + "y" + "z" * 300), (54, "ab" * 300)]
    rows += [(60, words(4, 80)), (60, words(4, 80)), (61, words(4, 80) + "!"), (62, words(5, 400)), (63, words(5, 400)[::-1]), (None, words(6, 50))]
    return rows + [(70, None), (71, ""), (72, "short"), (73, "short"), (74, "\0" * 100), (75, "\0" * 99 + "x")]


@pytest.mark.parametrize("length", [33, 60])
@pytest.mark.parametrize("classes", [20_000, 3])
def test_against_all_windows(spark, monkeypatch, length, classes):
    monkeypatch.setattr(bwtspans, "CLASSES", classes)
    rows = passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(docs, length) == wanted(rows, length)


def test_odd_rows(odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "1 AS t1", "2 AS copies", "'x' AS body", "3 AS start", "4 AS anchor", "0 AS n_bytes", "'k' AS kept")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(docs, 40) == wanted(rows, 40)
    assert found(no_docs, 200) == []


def test_query_against_all_windows(spark, sf, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted(
        (i, n, sum(b - a for a, b in gone), len(gone), hashlib.sha256(kept).hexdigest()) for (i, _), (n, gone, kept) in zip(rows, plain([t for _, t in rows], 200))
    )
    assert sorted(map(tuple, registered.query(spark, sf).collect())) == want
    assert sum(w[2] for w in want) > 0


def test_search_on_random_segments():
    r = random.Random(7)
    for _ in range(200):
        length = r.choice([9, 10, 17, 33])
        some = bytes(r.sample(range(256), r.choice([1, 2, 20])))
        bodies = [bytes(r.choice(some) for _ in range(r.randrange(80))) for _ in range(r.randrange(1, 7))]
        bodies += [bodies[0][k:] + b"\0" * k + bodies[-1][:25] for k in range(3)]
        count = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
        want = [[i for i in range(len(b) - length + 1) if count[b[i : i + length]] > 1] for b in bodies]
        assert [f.tolist() for f in repeated_windows(bodies, length)] == want


def test_segments_cover_each_window_once_and_equal_windows_meet(monkeypatch):
    texts = [t for _, t in passages() if t]
    anchors, places = {}, Counter()
    for slice_size in (1 << 20, 100):  # long texts in slices
        monkeypatch.setattr(bwtspans, "SLICE", slice_size)
        for data, at, number, low in _slices(pa.array(texts), 50):
            for part, start, windows, anchor, _, _ in zip(*segments(data, at, 50)):
                body, first = texts[number[part]].encode(), start - at[part] + low[part]
                for k in range(first, first + windows):
                    places[slice_size, number[part], k] += 1
                    assert anchors.setdefault(body[k : k + 50], anchor) == anchor
    total = sum(max(len(t.encode()) - 49, 0) for t in texts)
    assert len(places) == 2 * total and set(places.values()) == {1}


def test_borders_are_found_near_and_far():
    rng = np.random.default_rng(3)
    held = bytearray((rng.random(5000) < 0.02).astype(np.uint8).tobytes())
    held[0] = 1
    held[2000:3000] = bytes(1000)
    before = bytes(held)
    front = np.sort(rng.choice(np.arange(1, 5000), 800, replace=False))
    borders = np.flatnonzero(np.frombuffer(held, bool))
    assert bwtspans._borders_before(held, front).tolist() == borders[np.searchsorted(borders, front) - 1].tolist()
    assert bytes(held) == before and bwtspans._borders_before(held, front[:0]).tolist() == []


def test_a_search_does_not_list_all_borders_per_symbol(monkeypatch):
    r = random.Random(5)
    bodies = [bytes(r.choices(b"abcdefgh", k=400)) for _ in range(50)]
    bodies += [b[:300] + bytes(r.choices(b"abcdefgh", k=100)) for b in bodies]
    large, real = [], np.flatnonzero
    monkeypatch.setattr(bwtspans.np, "flatnonzero", lambda x: (large.append(len(x)), real(x))[1])
    places = repeated_windows(bodies, 200)
    assert sum(map(len, places)) >= 2 * 50 * 101 and sum(n > 30_000 for n in large) < 20


def test_texts_are_stored_a_file_a_bucket_and_joined_where_they_lie(spark):
    docs = spark.createDataFrame([(k, f"text {k % 300}") for k in range(400)], "doc_id long, text string").repartition(5)
    texts = bwtspans.distinct_texts(docs)
    assert texts.count() == 300
    assert len(texts.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    places = texts.select("t1", "t2").withColumn("n", F.lit(1)).repartition(3)
    plan = texts.join(places.hint("merge"), ["t1", "t2"])._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "body" in line)
    assert "Bucketed: true" in scan
    assert texts.join(places.hint("merge"), ["t1", "t2"]).count() == 300
