import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flowspark.llm import sharding
from flowspark.llm.sharding import numbered, propagate, propagated, quotas, shard, slice_starts


def check(rows, total, shards):
    counts = Counter(r["shard"] for r in rows)
    assert len(rows) == total and max(counts.values(), default=0) - min((counts[s] for s in range(shards)), default=0) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def cut_links(rows):
    groups = defaultdict(Counter)
    for r in rows:
        if r["text"] is not None:
            groups[r["text"]][r["shard"]] += 1
    return sum((sum(c.values()) ** 2 - sum(n * n for n in c.values())) // 2 for c in groups.values())


def test_documents(docs):
    rows = shard(docs, shards=40).collect()
    check(rows, docs.count(), 40)
    assert cut_links(rows) == 0
    for r in rows[:50]:
        body = r["text"].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(body) + 16, zlib.crc32(body), "rows", None)
    assert sorted(rows) == sorted(shard(docs.repartition(5), shards=40).collect())


def test_groups_larger_than_a_shard_fill_whole_shards(spark):
    docs = spark.range(1000).selectExpr("id AS doc_id", "IF(id < 400, 'hot', IF(id < 700, 'p' || id % 100, 'u' || id)) AS text")
    rows = shard(docs, shards=10).collect()
    check(rows, 1000, 10)
    # 400 copies fill four shards of 100 at best; at the start they lie 40 by 40 in all ten, and groups of three apart.
    # Propagation must end nearer to the best than to the start.
    best, start = (400**2 - 4 * 100**2) / 2, (400**2 - 10 * 40**2) / 2 + 100 * 3
    assert cut_links(rows) <= (best + start) / 2


def test_all_documents_linked(spark):
    docs = spark.range(640).selectExpr("id AS doc_id", "'t' || id % 160 AS text")
    rows = shard(docs, shards=8).collect()
    check(rows, 640, 8)
    assert cut_links(rows) <= 0.2 * 160 * 6


def test_state_keeps_quotas(spark):
    groups = spark.createDataFrame([("a", 50), ("b", 3), ("c", 2), ("d", 25)], "text_key string, n long")
    state = propagate(groups, 100, 7, 6, 1).collect()
    held = Counter()
    for r in state:
        held[r["shard"]] += r["docs"]
    assert sum(held.values()) == 80 and all(held[s] <= q for s, q in enumerate(quotas(100, 7)))


def test_odd_rows(odd_docs, no_docs):
    rows = shard(odd_docs, shards=4).collect()
    check(rows, odd_docs.count(), 4)
    assert {(r["size"], r["text_crc32"]) for r in rows if r["text"] is None} == {(16, 0)}
    assert shard(no_docs, shards=4).count() == 0


@pytest.mark.parametrize("block", [4096, 3])
def test_sums_before_slices(spark, monkeypatch, block):
    monkeypatch.setattr(sharding, "BLOCK_SLICES", block)
    rows = [(k % 3, k // 3 * 2, k * k % 17) for k in range(60)]
    table = spark.createDataFrame(rows, "k int, __slice long, v long")
    got = {(r["k"], r["__slice"]): r["s"] for r in slice_starts(table, ["k"], "v", "s").collect()}
    assert got == {(k, s): sum(v for a, b, v in rows if a == k and b < s) for k, s, _ in rows}
    whole = slice_starts(table.groupBy("__slice").agg(F.sum("v").alias("v")), [], "v", "s").collect()
    assert {r["__slice"]: r["s"] for r in whole} == {s: sum(v for _, b, v in rows if b < s) for _, s, _ in rows}
    n = numbered(spark.range(500).selectExpr("id", "id % 41 AS __slice"), [], ["id"], "n").orderBy("__slice", "id").collect()
    assert [r["n"] for r in n] == list(range(500))


def test_hot_rare_and_null_texts_get_the_same_shards(spark, monkeypatch):
    """Which texts count as hot decides the way to their groups, not the result."""
    docs = spark.range(900).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'hot', IF(id % 3 = 1, NULL, 'p' || id % 200)) AS text")
    results = []
    for hot in (1, 20, 1000):
        monkeypatch.setattr(sharding, "HOT_TEXTS", hot)
        results.append(sorted((r["doc_id"], r["shard"], r["slot"]) for r in shard(docs, shards=7).collect()))
        check([r for r in shard(docs, shards=7).collect()], 900, 7)
    assert results[0] == results[1] == results[2]


@pytest.mark.parametrize("slice_rows", [256, 1])
def test_driver_knows_what_moved(spark, monkeypatch, slice_rows):
    """Limits are met to the document, in one slice a level and in many; no text loses or gains documents."""
    monkeypatch.setattr(sharding, "SLICE_ROWS", slice_rows)
    sizes = {f"t{k}": 2 + (k * k) % 7 + 90 * (k == 5) for k in range(200)}
    groups = spark.createDataFrame(list(sizes.items()), "text_key string, n long")
    rows = sum(sizes.values()) + 20
    for rounds in (0, 1, 2, 5):
        state, held = propagated(groups, rows, 6, rounds, 3)
        state = state.collect()
        found = Counter()
        for r in state:
            assert sum(p["docs"] for p in r["parts"]) == r["n"] == sizes[r["text_key"]] and all(p["docs"] > 0 for p in r["parts"])
            assert len({p["shard"] for p in r["parts"]}) == len(r["parts"])
            for p in r["parts"]:
                found[p["shard"]] += p["docs"]
        assert len(state) == len(sizes) and found == Counter(held)
        assert all(held[s] <= q for s, q in enumerate(quotas(rows, 6)))


def test_a_round_moves_no_rows(spark):
    """A round is a sum per pair of shards, the places of limits and a pass over the state: few jobs, and no shuffle of it."""
    groups = spark.createDataFrame([(f"t{k}", 2 + k % 9) for k in range(300)], "text_key string, n long")
    jobs = []
    for rounds in (0, 6):
        spark.sparkContext.setJobGroup(f"rounds {rounds}", "")
        propagate(groups, 2000, 40, rounds, 1)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds {rounds}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 6 <= jobs[1] - jobs[0] <= 6 * 6


def test_keeps_the_columns_asked_for(odd_docs):
    out = shard(odd_docs, shards=4, keep=["source"])
    assert out.columns == ["source", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    whole = shard(odd_docs, shards=4).select(*out.columns)
    assert sorted(map(str, out.collect())) == sorted(map(str, whole.collect()))
