"""Stateful processors of the request rules: keyed state that ends, late requests included.

Neither rule puts a watermark on the stream, so Spark drops no request, however late. State
ends by its own time to live instead (``keep``, by the clock, from its last change). A
micro-batch's requests of one key are taken chunk by chunk into arrays of numbers (time,
tie and what the rule reads), put in order, and answered in chunks.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from flowspark.operators.ordered import bucket_run, bucket_scale

CHUNK = 10_000


def _ordered(rows: Iterator[pd.DataFrame], columns: list[str]) -> dict[str, np.ndarray]:
    """The columns of all chunks as arrays, in order of time and tie."""
    held: dict[str, list[np.ndarray]] = {c: [] for c in columns}
    for chunk in rows:
        for c in columns:
            held[c].append(chunk[c].to_numpy(copy=True))
    whole = {c: np.concatenate(parts) for c, parts in held.items()}
    order = np.lexsort((whole["tie"], whole["t_us"]))
    return {c: v[order] for c, v in whole.items()}


class TokenBucket(StatefulProcessor):
    """Verdicts of a bucket per key; its state is the time at which it is full again."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.full_at = handle.getValueState("full_at", "units STRING", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        calls = _ordered(rows, ["t_us", "tie", "rpm"])
        limit = int(calls["rpm"][0])
        state = int(self.full_at.get()[0]) if limit > 0 and self.full_at.exists() else None
        for a in range(0, len(calls["tie"]), CHUNK):
            tie = calls["tie"][a : a + CHUNK]
            if limit > 0:
                allowed, units, state = bucket_run(calls["t_us"][a : a + CHUNK].tolist(), limit, state)
                second = bucket_scale(limit)[0] * 1_000_000
                waits = [u / second for u in units]
            else:
                allowed, waits = [False] * len(tie), [None] * len(tie)
            yield pd.DataFrame({"tie": tie, "key": key[0], "allowed": allowed, "retry_after": pd.Series(waits, dtype="float64")})
        if limit > 0:
            self.full_at.update((str(state),))

    def close(self) -> None:
        pass


class Answers(StatefulProcessor):
    """Hits among stored answers; the state maps when an answer was made to when it ends.

    A request is judged by the answers that were made by its time and still held then. An
    answer stays until ``delay_us`` after its end, by the key's own latest time, so that
    requests up to that late find it.
    """

    def __init__(self, keep_ms: int, delay_us: int):
        self.keep_ms, self.delay_us = keep_ms, delay_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.answers = handle.getMapState("answers", "made BIGINT", "ends BIGINT", self.keep_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        calls = _ordered(rows, ["t_us", "tie", "fills", "ttl"])
        stored = {int(made[0]): int(ends[0]) for made, ends in self.answers.iterator()}
        ends = dict(stored)
        made = sorted(ends)
        latest = max([int(calls["t_us"][-1]), *made])
        for a in range(0, len(calls["tie"]), CHUNK):
            part = slice(a, a + CHUNK)
            hits = []
            for t, fill, ttl in zip(calls["t_us"][part].tolist(), calls["fills"][part].tolist(), calls["ttl"][part].tolist()):
                k = bisect_right(made, t)
                # the youngest first: older ones matter only where late answers came in between
                hit = any(ends[m] >= t for m in reversed(made[max(k - 1, 0) : k])) or any(ends[m] >= t for m in made[: max(k - 1, 0)])
                if not hit and fill:
                    if t not in ends:
                        insort(made, t)
                    ends[t] = t + ttl
                    k = bisect_right(made, t)
                hits.append(hit)
                # what ended long before this request is of no use to it or to any later one
                if k > 64:
                    gone = [m for m in made[: k - 1] if ends[m] < t - self.delay_us]
                    for m in gone:
                        del ends[m]
                    made = sorted(ends) if gone else made
            yield pd.DataFrame({"tie": calls["tie"][part], "key": key[0], "hit": hits})
        keep = {m: e for m, e in ends.items() if e >= latest - self.delay_us}
        for m in stored.keys() - keep.keys():
            self.answers.removeKey((m,))
        for m, e in keep.items():
            if stored.get(m) != e:
                self.answers.updateValue((m,), (e,))

    def close(self) -> None:
        pass
