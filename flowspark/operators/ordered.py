"""Order-dependent request rules, token bucket and expiry, run in parallel within a key.

Both rules carry one number from request to request: when the bucket is full
again, or when the stored answer expires. A key may hold a large part of the
log, so its requests must not go through one task. The log is dealt by ranges of
(key, time) and cut into parts of a bounded number of rows:

1. every part alone gives its effect: the number it ends with as a function of
   the number it begins with, in a few pieces;
2. effects of neighbouring parts compose to one effect, and those again, as a tree
   whose nodes have at most ``FAN`` children; down the tree every node's starting
   number gives those of its children;
3. every part is run with its true starting number.

No task holds all requests or all effects of a key. Results are exact; there is no
window, cap or sampling. Times are whole microseconds and the bucket is counted
in whole units, so no rounding depends on how the log was cut.
"""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Callable, Iterator
from math import gcd

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from flowspark.session import cut_lineage, ship_package

MINUTE_US = 60_000_000
PART_ROWS = 50_000
#: Effects that are composed or applied in a row, and the bits of their numbers.
FAN_BITS = 10
FAN = 1 << FAN_BITS


# --- token bucket of one key -------------------------------------------------------
# The state is the time at which the bucket is full again. A request takes one
# token: it moves that time by ``token``; it is refused when that would put the
# time more than ``room`` + ``token`` ahead.


def bucket_scale(rpm: int) -> tuple[int, int, int]:
    """(units per microsecond, units per token, room) without a fraction."""
    g = gcd(MINUTE_US, rpm)
    token = MINUTE_US // g
    return rpm // g, token, (rpm - 1) * token


def bucket_run(times: list[int], rpm: int, full_at: int | None) -> tuple[list[bool], list[int], int | None]:
    """Verdict and waiting units of each request, and the state after the last."""
    rate, token, room = bucket_scale(rpm)
    allowed, waits = [], []
    for t in times:
        now = t * rate
        if full_at is None or full_at < now:
            full_at = now
        wait = full_at - room - now
        if wait <= 0:
            full_at += token
        allowed.append(wait <= 0)
        waits.append(max(wait, 0))
    return allowed, waits, full_at


def bucket_effect(times: list[int], rpm: int) -> dict:
    """State after the block as a function of the state before it.

    Three forms, tried in turn. A block in which even the emptiest bucket fills
    up ends in one fixed state. One too busy for any bucket to fill up follows
    from the request count and the tightest point. The rest, such as requests at
    exactly the refill rate, is a list of pieces.
    """
    rate, token, room = bucket_scale(rpm)
    first = times[0] * rate
    worst, low, ahead, busy = first + room + token, None, 0, True
    for i, t in enumerate(times):
        now = t * rate
        if worst <= now:
            _, _, last = bucket_run(times[i:], rpm, None)
            return _fixed(first, last)
        if i and now > min(first + ahead, low + ahead - token):
            busy = False
        tight = now + room - ahead
        low = tight if low is None or tight < low else low
        worst = min(worst + token, now + room + token)
        ahead += token
    if busy:
        return {"first": first, "n": len(times), "low": low, "token": token, "room": room}
    return {"first": first, **_bucket_pieces(times, rpm)}


def _fixed(first: int, last: int) -> dict:
    return {"first": first, "bounds": [], "outs": [last], "fixed": [True]}


def _bucket_pieces(times: list[int], rpm: int) -> dict:
    """Pieces (upper bound of the state before, state after): shifted or fixed."""
    rate, token, room = bucket_scale(rpm)
    pieces: list[Piece] = [(times[0] * rate + room + token, 0, False)]
    for t in times:
        now = t * rate
        cut: list[Piece] = []
        for bound, value, is_fixed in pieces:
            if is_fixed:
                parts = [(bound, max(value, now) + token if value <= now + room else value, True)]
            else:
                parts = [(now - 1 - value, now + token, True), (now + room - value, value + token, False), (bound, value, False)]
            _add_pieces(cut, parts, bound)
        pieces = cut
    return _listed(pieces)


#: (upper bound of the state before, None for any; state after or shift; whether it is the state itself)
Piece = tuple[int | None, int, bool]


def _add_pieces(out: list[Piece], parts: list[Piece], bound: int | None) -> None:
    """Append what of ``parts`` lies above the pieces so far and up to ``bound``."""
    below = out[-1][0] if out else None
    for upper, value, is_fixed in parts:
        upper = bound if upper is None else upper if bound is None else min(upper, bound)
        if below is not None and upper is not None and upper <= below:
            continue
        if out and out[-1][1:] == (value, is_fixed):
            out.pop()
        out.append((upper, value, is_fixed))
        if upper == bound:
            break
        below = upper


def _listed(pieces: list[Piece]) -> dict:
    return {"bounds": [p[0] for p in pieces[:-1]], "outs": [p[1] for p in pieces], "fixed": [p[2] for p in pieces]}


def _pieces(effect: dict) -> list[Piece]:
    if "outs" in effect:
        return list(zip([*effect["bounds"], None], effect["outs"], effect["fixed"]))
    n, low, token = effect["n"], effect["low"], effect["token"]
    # one request fewer for every token that the state before lies above the tightest point
    fewer = min(n, max(0, -((low - effect["first"] - effect["room"] - token) // token)))
    return [(low + k * token if k < fewer else None, (n - k) * token, False) for k in range(fewer + 1)]


def bucket_apply(effect: dict, full_at: int | None) -> int:
    start = effect["first"] if full_at is None else max(full_at, effect["first"])
    if "outs" not in effect:
        return start + effect["token"] * (effect["n"] + min(0, (effect["low"] - start) // effect["token"]))
    i = bisect_left(effect["bounds"], start)
    return effect["outs"][i] if effect["fixed"][i] else start + effect["outs"][i]


def bucket_compose(a: dict, b: dict) -> dict:
    """The effect of ``a`` and then ``b``; composing is associative."""
    first = a["first"]
    if b.get("fixed") == [True]:
        return _fixed(first, b["outs"][0])
    if a.get("fixed") == [True]:
        return _fixed(first, bucket_apply(b, a["outs"][0]))
    if "outs" not in a and "outs" not in b:
        n, low, token = a["n"], a["low"], a["token"]
        if b["first"] <= min(first + n * token, low + n * token - token):  # no bucket fills up in between
            return {**a, "n": n + b["n"], "low": min(low, b["low"] - n * token)}
    out: list[Piece] = []
    then = _pieces(b)
    for bound, value, is_fixed in _pieces(a):
        if is_fixed:
            parts = [(bound, bucket_apply(b, value), True)]
        else:
            parts = [(b["first"] - value, bucket_apply(b, b["first"]), True)]
            parts += [(None if u is None else u - value, v if fixed else value + v, fixed) for u, v, fixed in then]
        _add_pieces(out, parts, bound)
    return {"first": first, **_listed(out)}


# --- expiry of one key -------------------------------------------------------------
# The state is the time until which the stored answer holds.


def ttl_run(times: list[int], fills: list[bool], ttls: list[int], expires: int | None) -> tuple[list[bool], int | None]:
    """Hit or miss of each request, and the state after the last."""
    hits = []
    for t, fill, ttl in zip(times, fills, ttls):
        hit = expires is not None and t <= expires
        if not hit and fill:
            expires = t + ttl
        hits.append(hit)
    return hits, expires


def ttl_effect(times: list[int], fills: list[bool], ttls: list[int]) -> dict:
    """Pieces of the state before, each with the state it leads to; later states stay as they are.

    Starting states that have come to the same answer stay together from then on: a heap
    holds such groups by the time their answer ends, and those that have ended join.
    """
    bounds: list[int] = []
    group_of: list[int] = []
    parent: list[int] = []
    ends: list[int] = []
    alive: list[tuple[int, int]] = []
    for t, fill, ttl in zip(times, fills, ttls):
        if not fill:
            continue
        group = len(parent)
        expired = []
        while alive and alive[0][0] < t:
            expired.append(heapq.heappop(alive)[1])
        untouched = not bounds or bounds[-1] < t - 1
        if not expired and not untouched:
            continue
        parent.append(group)
        ends.append(t + ttl)
        heapq.heappush(alive, (t + ttl, group))
        for g in expired:
            parent[g] = group
        if untouched:
            bounds.append(t - 1)
            group_of.append(group)
    for g in range(len(parent) - 1, -1, -1):
        ends[g] = ends[parent[g]]
    return _joined(zip(bounds, (ends[g] for g in group_of)))


def _joined(pieces) -> dict:
    """Neighbouring pieces with one result as one."""
    bounds: list[int] = []
    outs: list[int] = []
    for bound, out in pieces:
        if outs and outs[-1] == out:
            bounds[-1] = bound
        else:
            bounds.append(bound)
            outs.append(out)
    return {"bounds": bounds, "outs": outs}


def ttl_apply(effect: dict, expires: int | None) -> int | None:
    if expires is None:
        return effect["outs"][0] if effect["outs"] else None
    i = bisect_left(effect["bounds"], expires)
    return effect["outs"][i] if i < len(effect["outs"]) else expires


def ttl_compose(a: dict, b: dict) -> dict:
    """The effect of ``a`` and then ``b``; composing is associative."""
    known = [(bound, ttl_apply(b, out)) for bound, out in zip(a["bounds"], a["outs"])]
    above = [(bound, out) for bound, out in zip(b["bounds"], b["outs"]) if not known or bound > known[-1][0]]
    return _joined(known + above)


# --- the three steps on Spark ------------------------------------------------------


def _runs(*columns: list) -> list[tuple[int, int]]:
    """Stretches of equal values in sorted columns."""
    marks = list(zip(*columns))
    starts = [i for i, m in enumerate(marks) if not i or m != marks[i - 1]]
    return list(zip(starts, [*starts[1:], len(marks)]))


def _in_order(df: DataFrame, columns: list[str], then: list[str]) -> DataFrame:
    return df.repartition(*columns).sortWithinPartitions(*columns, *then)


def _parts(df: DataFrame, values: list[str], tie: str, effect: Callable[..., dict], part_rows: int) -> DataFrame:
    """``df`` in order of key and time with the ``place`` of each row's part, and one more row per part with its ``effect``.

    Places number the parts of a key in order of time.
    """
    schema = StructType([*df.schema.fields, *_parse_datatype_string("place BIGINT, effect STRING").fields])
    for field in schema:
        field.nullable = True
    arrow = to_arrow_schema(schema)
    at = df.columns.index("key")

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 2 * FAN_BITS
        held: list[list] = [[] for _ in values]
        key, part, open_ = None, 0, False
        found: list[tuple] = []

        def close() -> None:
            nonlocal held
            if open_ and held[0]:
                found.append((key, task + part, json.dumps(effect(*held))))
            held = [[] for _ in values]

        def effects() -> pa.RecordBatch:
            columns = [pa.nulls(len(found), f.type) for f in arrow]
            columns[at], columns[-2], columns[-1] = (pa.array(c, f) for c, f in zip(zip(*found), (pa.string(), pa.int64(), pa.string())))
            return pa.RecordBatch.from_arrays(columns, schema=arrow)

        for batch in batches:
            lists = [batch.column(v).to_pylist() for v in values]
            keys, places = batch.column("key").to_pylist(), []
            for a, b in _runs(keys):
                if not open_ or keys[a] != key:
                    close()
                    key, part, open_ = keys[a], 0, True
                while a < b:
                    if len(held[0]) == part_rows:
                        close()
                        part += 1
                    end = min(b, a + part_rows - len(held[0]))
                    for column, new in zip(held, lists):
                        column.extend(new[a:end])
                    places += [task + part] * (end - a)
                    a = end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64()), pa.nulls(len(places), pa.string())], schema=arrow)
            if len(found) >= 1000:
                yield effects()
                found = []
        close()
        if found:
            yield effects()

    order = ["key", values[0], tie]
    return df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(tag, schema)


def _starts(effects: DataFrame, apply: Callable, compose: Callable) -> DataFrame:
    """(key, place, entry): the state before each effect, by a tree over the places."""
    most = effects.groupBy("key").count().agg(F.max("count")).first()[0] or 0
    nodes = effects.withColumn("node", F.shiftright("place", FAN_BITS))

    def entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark, state = None, None
        for frame in frames:
            before = []
            for key, node, effect, entry in zip(frame["key"], frame["node"], frame["effect"], frame["entry"]):
                if (key, node) != mark:
                    mark, state = (key, node), None if entry is None else int(entry)
                before.append(None if state is None else str(state))
                state = apply(json.loads(effect), state)
            yield frame[["key", "place"]].assign(entry=pd.Series(before, dtype=object, index=frame.index))

    def composed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mark, whole = None, None
        for frame in frames:
            done = []
            for key, node, effect in zip(frame["key"], frame["node"], frame["effect"]):
                if (key, node) == mark:
                    whole = compose(whole, json.loads(effect))
                    continue
                if mark:
                    done.append((*mark, json.dumps(whole)))
                mark, whole = (key, node), json.loads(effect)
            yield pd.DataFrame(done, columns=["key", "place", "effect"])
        if mark:
            yield pd.DataFrame([(*mark, json.dumps(whole))], columns=["key", "place", "effect"])

    if most <= FAN:
        first = effects.withColumns({"node": F.lit(0).cast("bigint"), "entry": F.lit(None).cast("string")})
        return _in_order(first, ["key", "node"], ["place"]).mapInPandas(entries, "key STRING, place BIGINT, entry STRING")
    above = cut_lineage(_in_order(nodes, ["key", "node"], ["place"]).mapInPandas(composed, "key STRING, place BIGINT, effect STRING"))
    begun = _starts(above, apply, compose).withColumnRenamed("place", "node")
    ready = nodes.join(begun, (nodes["key"].eqNullSafe(begun["key"])) & (nodes["node"] == begun["node"])).select(
        nodes["key"], nodes["node"], "place", "effect", "entry"
    )
    return _in_order(ready, ["key", "node"], ["place"]).mapInPandas(entries, "key STRING, place BIGINT, entry STRING")


def _scan(
    df: DataFrame, values: list[str], tie: str, effect: Callable[..., dict], apply: Callable, compose: Callable, run: Callable,
    result: dict[str, str], part_rows: int,
) -> DataFrame:
    """The three steps over ``df``, which has ``key``.

    ``values`` are the columns the rule reads, the time first. ``effect`` gets
    them as lists for one part, ``run`` as lists and the state before them.
    """
    ship_package(df.sparkSession)
    stored = cut_lineage(_parts(df, values, tie, effect, part_rows))
    starts = _starts(stored.filter("effect IS NOT NULL").select("key", "place", "effect"), apply, compose)
    kept = [f for f in df.schema if f.name != "key"]
    schema = StructType([*kept, *_parse_datatype_string(", ".join(f"{n} {kind}" for n, kind in result.items())).fields])
    arrow = to_arrow_schema(schema)

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            lists = [batch.column(v).to_pylist() for v in values]
            keys, places, entry = (batch.column(c).to_pylist() for c in ("key", "place", "entry"))
            out: list[list] = [[] for _ in result]
            for a, b in _runs(keys, places):
                if (keys[a], places[a]) != last:
                    last, state = (keys[a], places[a]), None if entry[a] is None else int(entry[a])
                *columns, state = run(*[v[a:b] for v in lists], state)
                for column, new in zip(out, columns):
                    column.extend(new)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], *[pa.array(c, f.type) for c, f in zip(out, list(arrow)[len(kept):])]], schema=arrow
            )

    # clustered before the join: both kinds of join keep a part in one partition
    rows = stored.filter("effect IS NULL").drop("effect").repartition("key", "place").alias("r")
    begun = starts.select(F.col("key").alias("_key"), F.col("place").alias("_place"), "entry")
    ready = rows.join(begun, F.col("key").eqNullSafe(F.col("_key")) & (F.col("place") == F.col("_place"))).drop("_key", "_place")
    return ready.sortWithinPartitions("key", "place", values[0], tie).mapInArrow(verdicts, schema)


def throttle(
    requests: DataFrame, key: str, time_us: str, tie: str, rpm: Column, part_rows: int = PART_ROWS
) -> DataFrame:
    """Add ``allowed`` and ``retry_after`` (seconds): a token bucket of ``rpm``
    tokens per key, full at first, refilled evenly over the minute. Refused
    requests take nothing. A limit of zero refuses all, without a time to wait."""
    df = requests.withColumn("rpm", rpm.cast("bigint")).withColumn("key", F.col(key).cast("string"))

    def run(times: list[int], limits: list[int], state: int | None):
        allowed, waits, state = bucket_run(times, limits[0], state)
        second = bucket_scale(limits[0])[0] * 1_000_000
        return allowed, [w / second for w in waits], state

    open_ = _scan(
        df.filter("rpm > 0"), [time_us, "rpm"], tie,
        lambda times, limits: bucket_effect(times, limits[0]), bucket_apply, bucket_compose, run,
        {"allowed": "BOOLEAN", "retry_after": "DOUBLE"}, part_rows,
    )
    closed = df.filter("NOT coalesce(rpm > 0, false)").drop("key").withColumns(
        {"allowed": F.lit(False), "retry_after": F.lit(None).cast("double")}
    )
    return open_.unionByName(closed).drop("rpm")


def ttl_us(ttl_seconds: Column | int, default_seconds: int = 300) -> Column:
    """Microseconds an answer holds; none or 0 means the default."""
    seconds = ttl_seconds if isinstance(ttl_seconds, Column) else F.lit(ttl_seconds)
    given = F.coalesce(F.nullif(seconds.cast("double"), F.lit(0.0)), F.lit(float(default_seconds)))
    return F.round(given * 1_000_000).cast("bigint")


def ttl_dedup(
    requests: DataFrame, key: str, time_us: str, tie: str, fills: Column, ttl_seconds: Column | int = 300,
    part_rows: int = PART_ROWS, default_seconds: int = 300,
) -> DataFrame:
    """Add ``hit``: an answer to the same key, made by a request with ``fills``, still
    holds. It does so for the ``ttl_seconds`` of the request that made it (none or 0:
    the default), counted from the making; hits do not renew it."""
    df = requests.withColumns({
        "_fills": F.coalesce(fills, F.lit(False)), "_ttl": ttl_us(ttl_seconds, default_seconds), "key": F.col(key).cast("string")
    })
    return _scan(
        df, [time_us, "_fills", "_ttl"], tie, ttl_effect, ttl_apply, ttl_compose, ttl_run, {"hit": "BOOLEAN"}, part_rows
    ).drop("_fills", "_ttl")
