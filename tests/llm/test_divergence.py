import re
import string
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from compare import oracle, rows

from flowspark.llm import divergence
from flowspark.llm.divergence import audit, shares, terms_of
from flowspark.llm.queries import divergence as registered

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(docs, min_docs, smoothing, top):
    """The audit of (lang, source, text) rows by whole-number Python."""
    df, counts, groups = Counter(), defaultdict(Counter), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(TERM.findall((text or "").translate(LOWER)))
        for t, n in terms.items():
            df[lang, t] += 1
            counts[lang, source][t] += n
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for (g, t), n in df.items() if g == lang and n >= min_docs]
        sources = [s for g, s in groups if g == lang]

        def p_of(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + smoothing) // (total + smoothing * len(kept)) for t in kept}

        p = {s: p_of(counts[lang, s]) for s in sources}
        q = p_of(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            over = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", over)):
                out += [(lang, s, part, item, -f, r + 1) for r, (f, _, item) in enumerate(found)]
    return sorted(out)


def found(docs, **options):
    return sorted(map(tuple, audit(docs, **options).collect()))


def table(docs):
    return [(r["lang"], r["source"], r["text"]) for r in docs.collect()]


def test_query_agrees_with_sql(spark, sf):
    df, rel = registered.query(spark, sf), oracle(sf).sql(registered.SQL)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(rel.columns, rel.fetchall())


def test_documents_in_many_blocks(docs, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 17)
    assert found(docs, min_docs=5, top=7) == plain(table(docs), 5, 5, 7)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.selectExpr("*", "IF(doc_id % 2 = 0, 'x', NULL) AS lang", "1 AS value", "'mine' AS term", "2 AS n", "3 AS block", "4 AS df")
    for min_docs in (1, 2, 1000):
        assert found(docs, min_docs=min_docs, top=5) == plain(table(docs), min_docs, 5, 5)
    assert found(no_docs) == []
    # groups without any kept term still stand beside each other, at 0
    quiet = spark.createDataFrame([("l", "a", None), ("l", "b", "1 2 3"), ("l", None, "word")], "lang string, source string, text string")
    assert found(quiet, min_docs=2) == plain(table(quiet), 2, 5, 50) != []


def test_spilled_stripes_merge(monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 50)
    texts = [("l", f"s{k % 3}", f"w{chr(97 + k % 26)}{chr(97 + k // 26)} common x{'y' * (k % 7)} Common".encode()) for k in range(500)]

    class Batch:
        columns = [type("C", (), {"to_pylist": lambda self, c=c: list(c)})() for c in zip(*texts)]

    spilled = [r for b in divergence._fold([Batch]) for r in b.to_pylist()]
    assert len(spilled) > 500 / 10
    total = Counter()
    for r in spilled:
        total.update({(r["term"], s): n for s, n in zip(r["sources"], r["counts"])})
    want = Counter()
    for _, s, body in texts:
        want.update((t.decode(), s) for t in re.findall(rb"[a-z]+", body.lower()))
    assert total == want
    assert sum(r["df"] for r in spilled if r["term"] == "common") == 500

    spilled.sort(key=lambda r: (r["lang"], r["term"]))
    for size in (1, 7, 10_000):  # keys that go on from batch to batch
        batches = [pa.RecordBatch.from_pylist(spilled[k : k + size], divergence._STRIPES) for k in range(0, len(spilled), size)]
        merged = [r for b in divergence._merge(batches) for r in b.to_pylist()]
        assert len({r["term"] for r in merged}) == len(merged)
        assert {(r["term"], s): n for r in merged for s, n in zip(r["sources"], r["counts"])} == want
        assert [r["df"] for r in merged if r["term"] == "common"] == [500]


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = " ".join(f"W{chr(97 + k % 26) * (k % 9)}é{chr(0x4E00 + k % 50)}" for k in range(2000)).encode()
    (whole,) = terms_of(text)
    monkeypatch.setattr(divergence, "SLICE", 10)
    cut = list(terms_of(text))
    assert len(cut) > 100 and [t for part in cut for t in part] == whole and len(whole) == 2000


def test_shares_are_exact():
    count = np.array([0, 1, 7, 10**14, 3 * 10**15])
    total = 5 * 10**15 + 3
    want = [1 + 10**9 * (int(c) + 5) // (total + 5 * 12345) for c in count]
    assert shares(count, total, 12345, 5).tolist() == want
