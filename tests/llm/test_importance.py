import numpy as np
import pyarrow as pa
import pytest
from plain_words import words

from flowspark.llm import importance
from flowspark.llm.hashing import pieces


def good(labels):
    return labels.selectExpr("doc_id", "quality = 1 AND toxic = 0 AS good")


def test_counts_and_ratios(docs, labels):
    sample = importance.label_sample(docs, good(labels))
    table = importance.document_counts(docs, sample)
    got = {r["bucket"]: (r["raw"], r["target"]) for r in table.collect()}
    kind = {r["doc_id"]: r["good"] for r in sample.collect()}
    raw, target = {}, {}
    for r in docs.collect():
        piece = next(pieces(pa.array([r["text"]]), lower=True))
        bucket, text = importance.buckets(piece)
        n = len(words(r["text"], lower=True))
        assert len(bucket) == max(0, 2 * n - 1) and (bucket[:n] < importance.WORD_BUCKETS).all()
        for b in set(bucket.tolist()):
            raw[b] = raw.get(b, 0) + 1
            target[b] = target.get(b, 0) + bool(kind.get(r["doc_id"]))
    assert got == {b: (raw[b], target[b]) for b in raw}
    ratios = importance.log_ratios(table)
    share = sum(target.values()) / sum(raw.values())
    for b in list(raw)[:3000]:
        e, t = raw[b] * share + 1, target[b] + 1
        r = np.log(t / e)
        assert np.isclose(ratios[b], np.sign(r) * max(0, abs(r) - np.sqrt(1 / t + 1 / e) - 0.5))


def test_raw_model_counts_beside_labelled_documents(spark):
    """Buckets 1 and 2 differ in all documents only; bucket 3 is common, but no labelled document holds it."""
    rows = [(0, 400, 40, 40), (1, 400, 30, 10), (2, 40, 30, 10), (3, 900, 0, 0), (4, 60, 1, 30)]
    table = spark.createDataFrame(rows, "bucket int, raw long, target long, bad long")
    ratios = importance.labelled_ratios(table, 50, 45)
    share = sum(r[2] for r in rows) / sum(r[1] for r in rows)
    certain = lambda a, b, r, c: np.sign(r) * max(0, abs(r) - c * np.sqrt(1 / a + 1 / b) - importance.DEAD_ZONE)
    for bucket, raw, target, bad in rows:
        t, e, b = target + 1, raw * share + 1, bad + 1
        want = certain(t, e, np.log(t / e), importance.CERTAINTY)
        if target + bad:
            want += certain(t, b, np.log(t / 52 / (b / 47)), importance.LABELLED_CERTAINTY)
        assert np.isclose(ratios[bucket], importance.SHARPNESS * want)
    assert ratios[2] > ratios[1] and ratios[3] < 0 and ratios[5:].any() == 0


def test_greatest(spark):
    values = np.random.default_rng(0).integers(0, 1 << 62, 500).tolist() + [0, (1 << 62) - 1, 5, 5, 5]
    keys = spark.createDataFrame([(v,) for v in values], "key long")
    order = sorted(values, reverse=True)
    for k in (1, 2, 100, 501, 502, 505):
        assert importance.greatest(keys, k) == order[k - 1]
    assert importance.greatest(keys, 0) is None


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = good(labels).filter("doc_id % 3 <> 0")
    found = importance.resample(docs, seen, keep=["doc_id"]).join(labels.filter("doc_id % 3 = 0 AND quality = 1"), "doc_id").collect()
    share = lambda t: np.mean([r["kept"] for r in found if r["toxic"] == t])
    assert share(0) > 0.93 and share(1) < 0.3


@pytest.mark.parametrize("part", [0, 1, 2])
def test_unseen_documents_part_by_weight(spark, part):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    seen = good(labels).filter(f"doc_id % 3 <> {part}")
    rows = importance.resample(docs, seen, keep=["doc_id"]).join(labels.filter(f"doc_id % 3 = {part}"), "doc_id").toPandas()
    clean, toxic, bad = (rows[x] for x in ((rows.quality == 1) & (rows.toxic == 0), (rows.quality == 1) & (rows.toxic == 1), rows.quality == 0))
    print(part, *[(len(x), round(x.kept.mean(), 4)) for x in (clean, toxic, bad)], round((clean.log_weight == 0).mean(), 4))
    assert clean.kept.mean() > 0.93 and toxic.kept.mean() < 0.17 and bad.kept.mean() < 0.06
    # noise alone decides about hardly any
    assert (clean.log_weight == 0).mean() < 0.1


def test_runs_of_one_word_share_a_bucket():
    piece = next(pieces(pa.array(["", "a a a a a a a b", "c c c c c c", "c c c c c", "c d"]), lower=True))
    bucket, text = importance.buckets(piece)
    assert text[bucket == importance.BUCKETS - 1].tolist() == [1, 1, 2]


def test_number_kept_and_reruns(docs, labels):
    rows = importance.resample(docs, good(labels), share=0.5, keep=["doc_id"]).collect()
    keys = sorted((r["key"] for r in rows), reverse=True)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == -(-len(rows) // 2) and min(r["key"] for r in kept) >= keys[len(kept) - 1] - 1e-5
    again = importance.resample(docs.repartition(5), good(labels), share=0.5, keep=["doc_id", "text"]).drop("text").collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_noise_is_gumbel(docs, labels):
    none = good(labels).limit(0)
    key = np.array([r["key"] for r in importance.resample(docs, none, keep=["doc_id"]).collect()])
    assert abs(key.mean() - 0.5772) < 0.3 and abs(key.std() - 1.2825) < 0.3


def test_odd_rows(odd_docs, no_docs, labels):
    for table in (good(labels), good(labels).limit(0), labels.selectExpr("doc_id", "false AS good")):
        rows = importance.resample(odd_docs, table)
        assert rows.count() == odd_docs.count() and rows.columns.count("kept") == 1
    assert importance.resample(no_docs, good(labels)).count() == 0
    assert importance.resample(odd_docs, good(labels).limit(0)).filter("kept").count() == odd_docs.count()
