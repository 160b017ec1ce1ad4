"""Token bucket and expiry: block effects against running every request in order."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowspark.operators import ordered as O

SECOND = 1_000_000


def blocks(times, cuts):
    marks = sorted({c for c in cuts if 0 < c < len(times)})
    return [times[a:b] for a, b in zip([0, *marks], [*marks, len(times)])]


gaps = st.lists(st.sampled_from([0, 1, 333_333, SECOND // 2, SECOND - 1, SECOND, SECOND + 1, 2 * SECOND, 7 * SECOND, 61 * SECOND]), min_size=1, max_size=80)
cuts = st.lists(st.integers(1, 79), max_size=6)


def cumulated(steps):
    out, t = [], 1_700_000_000 * SECOND
    for s in steps:
        t += s
        out.append(t)
    return out


@settings(max_examples=400, deadline=None)
@given(gaps, cuts, st.sampled_from([1, 2, 3, 7, 30, 60, 61, 120]), st.integers(0, 200))
def test_bucket_effect_equals_run(steps, cut, rpm, ahead):
    times, state = cumulated(steps), None
    rate, token, room = O.bucket_scale(rpm)
    for block in blocks(times, cut):
        effect = O.bucket_effect(block, rpm)
        other = block[0] * rate + ahead * (room + token) // 200
        for start in (state, other):
            assert O.bucket_apply(effect, start) == O.bucket_run(block, rpm, start)[2]
        state = O.bucket_run(block, rpm, state)[2]


@settings(max_examples=400, deadline=None)
@given(gaps, cuts, st.sampled_from([1, SECOND, 3 * SECOND, 60 * SECOND]), st.integers(0, 100), st.integers(0, 2**32))
def test_expiry_effect_equals_run(steps, cut, ttl, back, seed):
    times, state, at = cumulated(steps), None, 0
    for block in blocks(times, cut):
        fills = [(seed >> (i % 32)) & 1 == 1 for i in range(at, at + len(block))]
        at += len(block)
        ttls = [ttl if (seed >> (i % 7)) & 1 else 3 * ttl // 2 for i in range(at, at + len(block))]
        effect = O.ttl_effect(block, fills, ttls)
        for start in (None, state, block[0] + ttl - back * ttl // 40):
            assert O.ttl_apply(effect, start) == O.ttl_run(block, fills, ttls, start)[1]
        state = O.ttl_run(block, fills, ttls, state)[1]


def in_both_orders(effects, compose):
    """The composition from the left, and that of the halves."""
    if len(effects) == 1:
        return effects[0], effects[0]
    left = effects[0]
    for e in effects[1:]:
        left = compose(left, e)
    half = len(effects) // 2
    return left, compose(in_both_orders(effects[:half], compose)[1], in_both_orders(effects[half:], compose)[1])


@settings(max_examples=400, deadline=None)
@given(gaps, cuts, st.sampled_from([1, 2, 3, 7, 30, 60, 61, 120]), st.integers(0, 200))
def test_composed_bucket_effects_equal_run(steps, cut, rpm, ahead):
    times = cumulated(steps)
    rate, token, room = O.bucket_scale(rpm)
    some = times[0] * rate + ahead * (room + token) // 200
    for effect in in_both_orders([O.bucket_effect(b, rpm) for b in blocks(times, cut)], O.bucket_compose):
        for start in (None, some):
            assert O.bucket_apply(effect, start) == O.bucket_run(times, rpm, start)[2]


@settings(max_examples=400, deadline=None)
@given(gaps, cuts, st.sampled_from([1, SECOND, 3 * SECOND, 60 * SECOND]), st.integers(0, 100), st.integers(0, 2**32))
def test_composed_expiry_effects_equal_run(steps, cut, ttl, back, seed):
    times = cumulated(steps)
    fills = [(seed >> (i % 32)) & 1 == 1 for i in range(len(times))]
    ttls = [ttl if (seed >> (i % 7)) & 1 else 3 * ttl // 2 for i in range(len(times))]
    at = [0]
    for b in blocks(times, cut):
        at.append(at[-1] + len(b))
    parts = [O.ttl_effect(times[a:b], fills[a:b], ttls[a:b]) for a, b in zip(at, at[1:])]
    for effect in in_both_orders(parts, O.ttl_compose):
        for start in (None, times[0] + ttl - back * ttl // 40):
            assert O.ttl_apply(effect, start) == O.ttl_run(times, fills, ttls, start)[1]


def test_bucket_matches_token_arithmetic():
    """The whole-number form gives the verdicts of counting tokens one by one."""
    times = [int(i * 0.37 * SECOND) for i in range(500)]
    tokens, last, expected = 60.0, times[0], []
    for t in times:
        tokens = min(60.0, tokens + (t - last) / 1e6)
        last = t
        expected.append(tokens >= 1 - 1e-9)
        tokens -= 1 if expected[-1] else 0
    assert O.bucket_run(times, 60, None)[0] == expected


def test_limit_one_allows_one_then_waits():
    allowed, waits, _ = O.bucket_run([0, 15 * SECOND, 60 * SECOND], 1, None)
    assert allowed == [True, False, True]
    assert waits[1] / O.bucket_scale(1)[0] / SECOND == 45


def test_age_counts_from_the_making_and_ends_after_the_limit():
    hits, _ = O.ttl_run([0, 5, 10, 11, 12], [True] * 5, [10] * 5, None)
    assert hits == [False, True, True, False, True]


@pytest.mark.parametrize(("part_rows", "fan_bits"), [(7, 2), (100, 10), (10_000, 10)])
def test_hot_key_is_cut_into_parts_and_stays_exact(spark, monkeypatch, part_rows, fan_bits):
    """Nine tenths of all requests on one key, parts far shorter than an answer holds, a tree of several levels."""
    monkeypatch.setattr(O, "FAN_BITS", fan_bits)
    monkeypatch.setattr(O, "FAN", 1 << fan_bits)
    n = 3000
    t = (F.col("id") * 100_000 + F.pmod(F.hash("id"), F.lit(90_000))).cast("bigint")
    key = F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 30 > 0, F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    df = spark.range(n).select("id", t.alias("t"), key.alias("key_name"), F.array("id").alias("more")).repartition(4)
    got = O.throttle(df, "key_name", "t", "id", F.when(F.col("key_name") == "k0", 0).otherwise(60), part_rows).collect()
    own = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, 45)
    hits = O.ttl_dedup(df, "key_name", "t", "id", F.col("id") % 5 > 0, own, part_rows, default_seconds=30).collect()
    assert len(got) == n and len(hits) == n and all(r.more == [r.id] for r in hits)
    by_key = {}
    for r in df.orderBy("t", "id").collect():
        by_key.setdefault(r.key_name, []).append(r)
    allowed = {r.id: (r.allowed, r.retry_after) for r in got}
    hit = {r.id: r.hit for r in hits}
    for name, rows in by_key.items():
        times = [r.t for r in rows]
        if name == "k0":
            assert all(allowed[r.id] == (False, None) for r in rows)
        else:
            ok, waits, _ = O.bucket_run(times, 60, None)
            assert [allowed[r.id][0] for r in rows] == ok
            assert all(math.isclose(allowed[r.id][1], w / SECOND) for r, w in zip(rows, waits))
        ttls = [(45 if r.id % 3 == 1 else 30) * SECOND for r in rows]
        assert [hit[r.id] for r in rows] == O.ttl_run(times, [r.id % 5 > 0 for r in rows], ttls, None)[0]


def test_no_requests(spark):
    none = spark.createDataFrame([], "id long, t long, k string")
    assert O.throttle(none, "k", "t", "id", F.lit(5)).count() == 0
    assert O.ttl_dedup(none, "k", "t", "id", F.lit(True)).count() == 0
