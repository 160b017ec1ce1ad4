import math
import os
import zlib
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest
from plain_words import words

from flowspark.llm import bloom, bloomlm
from flowspark.llm.hashing import pieces


def plain(rows):
    """Base figures of each row in plain Python."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows]
    tokens = [words(t, lower=True) + [""] for _, t in rows]
    seen = Counter(x for h, t in zip(held, tokens) if not h for x in t)
    n, v = sum(seen.values()), len(seen)
    for h, t in zip(held, tokens):
        base = sum(math.log10((seen[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)
        yield h, len(t), sum(seen[x] > 0 for x in t), n, base


def check(df, **options):
    rows = bloomlm.score(df.select("doc_id", "text"), keep=["doc_id", "text"], **options).collect()
    source = [(r["doc_id"], r["text"]) for r in df.collect()]
    expected = sorted(zip(((d is not None, d or 0, t or "") for d, t in source), plain(source)), key=lambda x: (x[0], x[1]))
    rows.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "", r["base_score"]))
    assert len(rows) == len(source)
    for r, (_, (held, n, known, total, base)) in zip(rows, expected):
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
    return rows


@pytest.mark.parametrize("head", [200_000, 50])
def test_documents(docs, monkeypatch, head):
    monkeypatch.setattr(bloomlm, "CLASSES", 40)
    check(docs, head_words=head)


def test_rare_words_score_alike_broadcast_or_by_segments(spark, docs, monkeypatch):
    monkeypatch.setattr(bloomlm, "CLASSES", 40)
    # which word pairs are in the model depends on which words are frequent, so this is about words alone
    monkeypatch.setattr(bloomlm, "HEAD_PAIRS", 0)
    scores = [
        {r["doc_id"]: r["score"] for r in bloomlm.score(docs, head_words=head, keep=["doc_id"]).collect()} for head in (200_000, 50)
    ]
    # filters of different sizes err on different words, seldom
    off = [abs(scores[0][d] - scores[1][d]) / (1 - scores[0][d]) for d in scores[0]]
    assert sorted(off)[len(off) // 2] < 1e-3 and max(off) < 0.02


def test_model_beats_the_plain_score(spark):
    rows = bloomlm.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), keep=["doc_id"]).filter("held_out").collect()
    tokens = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / tokens > sum(r["base_score"] for r in rows) / tokens + 0.2


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    out = bloomlm.score(odd_docs)
    assert set(odd_docs.columns) - {"score"} <= set(out.columns) and out.columns.count("score") == 1
    assert bloomlm.score(no_docs).count() == 0


def test_filter_never_underestimates(spark):
    r = np.random.default_rng(0)
    item, q = r.integers(-(1 << 62), 1 << 62, 60_000), r.integers(1, 12, 60_000)
    table = spark.createDataFrame(list(zip(item.tolist(), q.tolist())), "item long, q int")
    built = bloom.build_filter(table)
    assert built.segments > 1
    got = built.levels(item.view(np.uint64))
    assert (got >= q).all() and (got > q).mean() < 0.03
    assert (built.levels(r.integers(1 << 62, (1 << 63) - 1, 20_000).view(np.uint64)) > 0).mean() < 0.03
    # items that all have some level at least need no probes below it, and what is there for no level is not found
    high = q >= 5
    assert (built.levels(item[high].view(np.uint64), 5) == got[high]).all()
    assert (built.levels(r.integers(1 << 62, (1 << 63) - 1, 20_000).view(np.uint64), 5) > 0).mean() < 1e-3
    # the table of segments says the same
    bits, segments = bloom.filter_table(table)
    asked = spark.createDataFrame([(k, int(x)) for k, x in enumerate([*item, *r.integers(1 << 62, (1 << 63) - 1, 500)])], "k int, item long")
    found = bloom.probe(asked, bits, segments).orderBy("k").toPandas()
    assert segments == built.segments and (found["q"] == built.levels(found["item"].to_numpy().view(np.uint64))).all()
    nothing, one = bloom.filter_table(table.limit(0))
    assert one == 1 and set(bloom.probe(asked, nothing, one).toPandas()["q"]) == {0}


def test_filter_grows_with_its_entries():
    for entries in (0, 1, 90_000_000, 400_000_000, 5_000_000_000):
        assert bloom.segments_for(entries) * bloom.SEGMENT_BITS >= entries * bloom.BITS_PER_ENTRY


def test_most_frequent(spark):
    table = spark.createDataFrame([(bytes([k]), c) for k, c in enumerate([1, 9, 9, 5, 1, 700, 2, 1])], "word binary, c long")
    kept = lambda limit: sorted(r["c"] for r in bloomlm.most_frequent(table, limit).collect())
    assert kept(8) == [1, 1, 1, 2, 5, 9, 9, 700] and kept(7) == kept(5) == [2, 5, 9, 9, 700]
    assert kept(2) == [700] and kept(0) == [] and bloomlm.most_frequent(table.limit(0), 3).count() == 0


def test_levels():
    c = np.arange(1, 3000)
    q = bloomlm.level(c)
    value = bloomlm.level_values()[q]
    assert (np.diff(q) >= 0).all() and (np.abs(value / c - 1) < 0.35).all() and bloomlm.level_values()[0] == 0


def test_probabilities_sum_to_one():
    text = "a a a b b c d e a b a " * 20 + "once twice twice"
    counts = Counter(text.split())
    piece = next(pieces(pa.array([text])))
    hashes = dict(zip(text.split(), piece.word_hashes()))
    known = np.sort(np.array([hashes["a"], hashes["b"]], np.uint64))

    class Exact:
        def levels(self, item):
            held = {int(x): c for x, c in zip(bloomlm.word_item(np.array(list(hashes.values()), np.uint64)), (counts[w] for w in hashes))}
            return np.array([bloomlm.level(held[int(x)]) if int(x) in held else 0 for x in item], np.int64)

    rare = sum(c for w, c in counts.items() if w not in ("a", "b"))
    none = bloomlm.PairModel(1, np.zeros(1), np.ones(1))
    scorer = bloomlm.WordScorer(Exact(), (np.zeros(0, np.uint64), np.zeros(0)), known, rare, 1, none)
    assert (10**scorer.pair_log).sum(axis=1) == pytest.approx(np.ones(4))
    scorer.value = {}
    scorer.value = np.arange(128)
    scorer.filter.levels = lambda item: np.array([
        next((counts[w] for w in hashes if bloomlm.word_item(np.array([hashes[w]], np.uint64))[0] == x), 0) for x in item
    ])
    scorer.value = np.arange(1000)
    place = scorer.places(piece)
    own = {w: 10 ** scorer.log_p[p] for w, p in zip(text.split(), place) if w not in ("a", "b")}
    assert sum(own.values()) + scorer.unseen == pytest.approx(1)


def neighbours(tokens, frequent):
    """Pairs of neighbours that are frequent words or the boundary (None)."""
    around = [None, *tokens, None]
    return [(a, b) for a, b in zip(around, around[1:]) if (a is None or a in frequent) and (b is None or b in frequent)]


def test_word_pairs_are_those_of_plain_python(spark, docs, monkeypatch):
    texts = [words(r["text"], lower=True) for r in docs.select("text").collect()]
    frequent = {w for w, _ in Counter(x for t in texts for x in t).most_common(300)}
    expected = Counter(p for t in texts for p in neighbours(t, frequent))
    number = {None: 0}
    hashes = {w: next(pieces(pa.array([w.decode() if isinstance(w, bytes) else w]))).word_hashes()[0] for w in frequent}
    head = np.sort(np.array(list(hashes.values()), np.uint64))
    number |= {w: int(np.searchsorted(head, h)) + 1 for w, h in hashes.items()}
    for fold in (1 << 22, 100):
        monkeypatch.setattr(bloomlm, "FOLD_PAIRS", fold)
        got = {r["pair"]: r["c"] for r in bloomlm.word_pair_counts(docs, head).collect()}
        assert got == {number[a] << 32 | number[b]: c for (a, b), c in expected.items()}


def test_word_pairs_score_as_in_plain_python(spark):
    """Each factor of a small corpus from the counts themselves, and what follows a word sums to one."""
    text = "a b a b a c d a b e a c " * 30
    tokens = text.split()
    hashes = {w: next(pieces(pa.array([w]))).word_hashes()[0] for w in set(tokens)}
    head = np.sort(np.array(list(hashes.values()), np.uint64))
    number = {w: int(np.searchsorted(head, h)) + 1 for w, h in hashes.items()} | {None: 0}
    counts, seen = Counter(tokens), Counter(neighbours(tokens, set(tokens)))
    table = spark.createDataFrame([(number[a] << 32 | number[b], c) for (a, b), c in seen.items()], "pair long, c long")
    by_number = np.zeros(len(head) + 1)
    for w in counts:
        by_number[number[w]] = counts[w]
    by_number[0] = 1
    model = bloomlm.pair_model(table, by_number)
    bits = bloom.build_filter(bloomlm.leveled(bloomlm.pair_items(table)))
    scorer = bloomlm.WordScorer(bits, (head, by_number[1:]), np.zeros(0, np.uint64), 1, 1, model)
    value = bloomlm.level_values()
    back = np.log10(np.full(len(number), 1 / len(number)))
    every = np.array(sorted(number.values()))
    for a, first in number.items():
        got = 10 ** scorer.after(np.full(len(every), first), every, back)
        after = {number[b]: value[bloomlm.level(c)] for (x, b), c in seen.items() if x == a}
        total = max(sum(after.values()), by_number[first]) + bloomlm.BACK_OFF
        rest = (total - sum(after.values())) / len(every)
        assert got == pytest.approx([(after.get(s, 0) + rest) / total for s in every])
        assert got.sum() == pytest.approx(1)
    # a word that is not frequent gets the back-off's share alone, and nothing is known after one
    assert scorer.after(np.array([-1]), np.array([1]), np.array([-2.0])) == pytest.approx([-2.0])
    first = number["a"]
    left = (model.total[first] - model.kept[first]) / model.total[first]
    assert 10 ** scorer.after(np.array([first]), np.array([-1]), np.array([0.0])) == pytest.approx([left])


def test_word_pairs_help(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    told = lambda: bloomlm.score(table, keep=["doc_id"]).filter("held_out").selectExpr("sum(score) / sum(n_tokens) AS s").first()["s"]
    whole = told()
    monkeypatch.setattr(bloomlm, "HEAD_PAIRS", 0)
    assert whole > told() + 0.3


def test_pairs_outside_the_filter_score_the_same(spark, monkeypatch):
    """Which pairs are broadcast, and which words are frequent, decides the way to a pair's count and not whether it counts."""
    texts = [" ".join(f"w{(k * k + j * (1 + k % 3)) % 23}" for j in range(5 + k % 40)) for k in range(120)] + [None, "", "never seen"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(bloomlm, "CLASSES", 4)
    scores = []
    for limit in (1_000_000, 40):
        monkeypatch.setattr(bloomlm, "HEAD_PAIRS", limit)
        for head in (1000, 6):
            scores.append({r["doc_id"]: r["score"] for r in bloomlm.score(table, head_words=head, keep=["doc_id"]).collect()})
    for other in scores[1:]:
        # a filter may err on a pair or a word, seldom
        off = sorted(abs(scores[0][d] - other[d]) / (1 - scores[0][d]) for d in scores[0])
        assert off[len(off) // 2] < 1e-9 and off[len(off) * 9 // 10] < 0.02


def test_rare_pairs_are_those_of_plain_python(spark):
    texts = ["a b a c", "b", None, "c c d a"]
    table = spark.createDataFrame([(t,) for t in texts], "text string")
    hashes = {w: next(pieces(pa.array([w]))).word_hashes()[0] for w in "abcd"}
    head = np.sort(np.array([hashes["a"], hashes["b"]], np.uint64))
    key = {w: int(bloomlm.word_keys(np.array([h]), bloomlm.head_numbers(np.array([h]), head))[0]) for w, h in hashes.items()} | {None: 0}
    assert {w for w, k in key.items() if k < 0} == {"c", "d"}
    expected = Counter(
        (key[a], key[b]) for t in texts for a, b in neighbours((t or "").split(), set("abcd")) if key[a] < 0 or key[b] < 0
    )
    rare = bloomlm.rare_pair_counts(table, head)
    assert {(r["first"], r["second"]): r["c"] for r in rare.collect()} == expected
    every = bloomlm.words_before(bloomlm.word_pair_counts(table, head), rare)
    counts = Counter(a for t in texts for a, _ in neighbours((t or "").split(), set("abcd")))
    assert {r["first"]: r["n"] for r in every.collect()} == {key[a]: n for a, n in counts.items()}


def test_places_outside_the_filter_are_stored_packed(spark, monkeypatch):
    """What the job stores for a token stays small when most of the places are not in the broadcast filter."""
    r = np.random.default_rng(5)
    texts = [" ".join(f"w{int(x)}" for x in r.zipf(1.3, 400) % 5000) for _ in range(300)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(bloomlm, "HEAD_PAIRS", 100)
    stored, store = [], bloomlm.cut_lineage

    def kept(df):
        out = store(df)
        stored.extend(os.path.getsize(urlparse(f).path) for f in out.inputFiles())
        return out

    monkeypatch.setattr(bloomlm, "cut_lineage", kept)
    assert bloomlm.score(table, head_words=2000, keep=["doc_id"]).count() == 300
    assert sum(stored) < 9 * 300 * 401


def test_packed_numbers_come_back():
    for numbers in ([], [7], [-5, -5, 0, 1 << 62], [-(1 << 63), (1 << 63) - 1]):
        x = np.array(numbers, np.int64)
        assert (bloomlm.unpack(bloomlm.pack(x), len(x)) == x).all() and (bloomlm.unpack(bloomlm.pack(x, True), len(x), True) == x).all()


@pytest.mark.parametrize("buckets, fold", [(1, 1 << 20), (5, 100)])
def test_packed_pairs_are_the_plain_ones(spark, docs, monkeypatch, buckets, fold):
    monkeypatch.setattr(bloomlm, "FOLD_PLACES", fold)
    monkeypatch.setattr(bloomlm, "KEPT_NUMBERS", 64)
    some = docs.limit(60)
    counts = Counter(x for r in some.select("text").collect() for x in words(r["text"], lower=True))
    head = np.sort(np.array([next(pieces(pa.array([w.decode() if isinstance(w, bytes) else w]))).word_hashes()[0] for w, _ in counts.most_common(200)]))
    own = np.concatenate([[bloomlm.BOUNDARY], bloomlm.classes_of(head, head[:50]), [bloomlm.SHARED]])
    table = bloomlm.packed_pairs(some, head, own, buckets).cache()
    plain, rare = bloomlm.word_pair_counts(some, head), bloomlm.rare_pair_counts(some, head)
    expected = {r["pair"]: r["c"] for r in plain.collect()}
    assert {r["pair"]: r["c"] for r in bloomlm.unpacked(table, bloomlm.PAIRS).collect()} == expected
    classes = Counter()
    for r in plain.collect():
        classes[own[r["pair"] >> 32] * bloomlm.CLASSES + own[r["pair"] & 0xFFFFFFFF]] += r["c"]
    for r in rare.collect():
        classes[own[max(r["first"], -1)] * bloomlm.CLASSES + own[max(r["second"], -1)]] += r["c"]
    assert {r["pair"]: r["c"] for r in bloomlm.unpacked(table, bloomlm.CLASS_PAIRS).collect()} == classes
    kept = bloomlm.kept_after(table, len(head))
    assert {k: x for k, x in enumerate(kept) if x} == {
        r["first"]: r["kept"] for r in bloomlm.words_before(plain, rare).collect() if r["first"] >= 0
    }
    for limit in (0, 50, 1 << 20):
        want = {r["pair"]: r["c"] for r in bloomlm.most_frequent(plain, limit).collect()}
        assert {r["pair"]: r["c"] for r in bloomlm.frequent_pairs(table, limit).collect()} == want
