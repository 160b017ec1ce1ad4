"""Packing documents into sequences: best fit, then a swap-based local search.

Documents are encoded where they lie; only (document, piece, start, length, checksum)
goes on. Pieces are dealt by a hash into groups of about ``GROUP_PIECES``, and each
group is packed in one task. A group ends with at most a part of one sequence more
than it needs, so groups of this size cost less than one sequence in ten thousand,
and none grows with the input.

Within a group, best fit places the longest piece first. The search then takes the
sequences from the emptiest on and tries to empty each: a piece moves into a gap
elsewhere, or goes to a sequence in exchange for one shorter piece or for two together
shorter ones, or two pieces go for one, wherever that sequence becomes fuller by it. Every
step raises the sum of squared fills, as what is taken back is less than what was given to
a sequence that was no emptier. Sequences that become empty vanish. Sequences are filed by
their gap and by the lengths, and sums of two lengths, that they hold, so a partner is found
if there is one. The search ends when no step is left, or no fewer sequences can hold the pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowspark.llm.common import python_ready
from flowspark.llm.tokens import encoder
from flowspark.session import cut_lineage

GROUP_PIECES = 20_000
STEP = 256


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, row.

    A document is its ids (null text: none) and ``end_id``; only one of more than
    ``capacity`` ids is cut. ``row`` numbers the pieces, so that repeated documents
    stay apart.
    """
    python_ready(docs.sparkSession)
    key = docs.schema["doc_id"].dataType
    schema = pa.schema([
        ("doc_id", to_arrow_type(key)), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("row", pa.int64()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, row = encoder(tokenizer), TaskContext.get().partitionId() << 33
        for batch in batches:
            for first in range(0, batch.num_rows, STEP):
                some = batch.slice(first, STEP)
                found, sizes = enc.encode_many(some.column(1))
                ids = np.insert(found.astype("<u4"), np.cumsum(sizes), end_id)
                sizes = sizes + 1
                at = np.cumsum(sizes) - sizes
                count = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                begin = at[doc] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                yield pa.RecordBatch.from_arrays([
                    some.column(0).take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(row + np.arange(len(doc)), pa.int64()),
                ], schema=schema)
                row += len(doc)

    kinds = f"doc_id {key.simpleString()}, piece int, start long, length long, ids_crc32 long, row long"
    return docs.select("doc_id", "text").mapInArrow(cut, kinds)


def sums_of_two(lengths: list[int]) -> set[int]:
    """Sums of two of the sorted ``lengths``."""
    different = sorted(set(lengths))
    sums = {x + y for k, x in enumerate(different) for y in different[k + 1 :]}
    return sums | {2 * x for x, y in zip(lengths, lengths[1:]) if x == y}


class Bins:
    """Sequences of a group, found by their gap and by the lengths they hold."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []  # sorted (length, piece) of each bin
        self.fill: list[int] = []
        self.by_gap: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.gaps = 0  # bit g is set where a bin with gap g exists
        # per gap: bins by a length that they hold, by a sum of two, and those as bits; filled by :meth:`file`
        self.single: list[dict[int, set[int]]] | None = None
        self.double: list[dict[int, set[int]]] = []
        self.single_bits, self.double_bits = [0] * (capacity + 1), [0] * (capacity + 1)

    def file(self) -> None:
        """File all bins by what they hold, from now on."""
        self.single, self.double = [{} for _ in range(self.capacity + 1)], [{} for _ in range(self.capacity + 1)]
        for b in range(len(self.fill)):
            self._filed(b, True)

    @staticmethod
    def _entered(found: dict[int, set[int]], bits: int, keys: list[int] | set[int], b: int, on: bool) -> int:
        for key in keys:
            if on:
                found.setdefault(key, set()).add(b)
                bits |= 1 << key
            else:
                found[key].discard(b)
                if not found[key]:
                    del found[key]
                    bits &= ~(1 << key)
        return bits

    def _filed(self, b: int, on: bool) -> None:
        gap = self.capacity - self.fill[b]
        if self.single is not None and gap and self.items[b]:
            held = self.lengths(b)
            self.single_bits[gap] = self._entered(self.single[gap], self.single_bits[gap], set(held), b, on)
            self.double_bits[gap] = self._entered(self.double[gap], self.double_bits[gap], sums_of_two(held), b, on)
        (self.by_gap[gap].add if on else self.by_gap[gap].discard)(b)
        if self.by_gap[gap]:
            self.gaps |= 1 << gap
        else:
            self.gaps &= ~(1 << gap)

    def new(self) -> int:
        self.items.append([])
        self.fill.append(0)
        self._filed(len(self.fill) - 1, True)
        return len(self.fill) - 1

    def lengths(self, b: int) -> list[int]:
        return [length for length, _ in self.items[b]]

    def partner(self, a: int, length: int, two: bool = True) -> int | None:
        """A bin no emptier than ``a`` that becomes fuller by ``length`` for one of its pieces, or with ``two`` for two."""
        gaps = self.gaps & ((2 << (self.capacity - self.fill[a])) - 1) & ~1
        while gaps:
            gap = (gaps & -gaps).bit_length() - 1
            low = max(1, length - gap)
            window = ((1 << length) - 1) >> low << low
            for bits, found in ((self.single_bits[gap], self.single[gap]), (self.double_bits[gap] if two else 0, self.double[gap])):
                bits &= window
                while bits:
                    held = found[(bits & -bits).bit_length() - 1]
                    if len(held) > 1 or a not in held:
                        first = iter(held)
                        b = next(first)
                        return next(first) if b == a else b
                    bits &= bits - 1
            gaps &= gaps - 1
        return None

    def put(self, b: int, item: tuple[int, int]) -> None:
        self._filed(b, False)
        insort(self.items[b], item)
        self.fill[b] += item[0]
        self._filed(b, True)

    def take(self, b: int, item: tuple[int, int]) -> None:
        self._filed(b, False)
        self.items[b].remove(item)
        self.fill[b] -= item[0]
        self._filed(b, True)

    def tightest(self, length: int, but: int = -1) -> int | None:
        """A bin with the smallest gap of at least ``length``."""
        rest = self.gaps >> length
        while rest:
            low = (rest & -rest).bit_length() - 1
            found = min((b for b in self.by_gap[length + low] if b != but), default=None)
            if found is not None:
                return found
            rest &= rest - 1
        return None


def best_fit(lengths: list[int], capacity: int) -> Bins:
    """Longest first, each into the tightest gap."""
    bins = Bins(capacity)
    for piece in sorted(range(len(lengths)), key=lambda p: (-lengths[p], p)):
        b = bins.tightest(lengths[piece])
        bins.put(bins.new() if b is None else b, (lengths[piece], piece))
    return bins


def _exchange(bins: Bins, a: int, item: tuple[int, int], b: int) -> bool:
    """Give ``item`` of bin a to bin b for one or two shorter pieces, if b becomes fuller."""
    length, gap, held = item[0], bins.capacity - bins.fill[b], bins.items[b]
    # one for one: the shortest piece that makes room gives b the most
    at = bisect_left(held, (length - gap, -1))
    if at < len(held) and held[at][0] < length:
        back = [held[at]]
    else:
        # two for one: the smallest pair of at least length - gap
        best, left, right = None, 0, len(held) - 1
        while left < right:
            pair = held[left][0] + held[right][0]
            if pair >= length - gap:
                if pair < length and (best is None or pair < best[0]):
                    best = (pair, left, right)
                right -= 1
            else:
                left += 1
        if best is None:
            return False
        back = [held[best[1]], held[best[2]]]
    _swap(bins, a, [item], b, back)
    return True


def _swap(bins: Bins, a: int, given: list[tuple[int, int]], b: int, back: list[tuple[int, int]]) -> None:
    for x in given:
        bins.take(a, x)
    for x in back:
        bins.take(b, x)
    for x in given:
        bins.put(b, x)
    for x in back:
        bins.put(a, x)


def _step(bins: Bins, a: int) -> bool:
    """Move or exchange something out of bin a, if any step raises the sum of squared fills."""
    held = bins.items[a]
    # pieces of one length are alike
    for item in reversed([x for k, x in enumerate(held) if k == 0 or held[k - 1][0] < x[0]]):
        b = bins.tightest(item[0], but=a)
        if b is not None and bins.fill[b] > bins.fill[a] - item[0]:
            _swap(bins, a, [item], b, [])
            return True
        b = bins.partner(a, item[0])
        if b is not None:
            return _exchange(bins, a, item, b)
    for total in sorted(sums_of_two(bins.lengths(a)), reverse=True):
        b = bins.partner(a, total, two=False)
        if b is not None:
            left, right = _pair(held, total)
            shortest = bins.items[b][bisect_left(bins.items[b], (total - bins.capacity + bins.fill[b], -1))]
            _swap(bins, a, [left, right], b, [shortest])
            return True
    return False


def _pair(held: list[tuple[int, int]], total: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """Two of the sorted pieces that are ``total`` long together."""
    left, right = 0, len(held) - 1
    while held[left][0] + held[right][0] != total:
        if held[left][0] + held[right][0] < total:
            left += 1
        else:
            right -= 1
    return held[left], held[right]


def improve(bins: Bins) -> Bins:
    """Empty bins by moves and exchanges, from the emptiest on, until none has a step left or they are as few
    as the sum of all lengths allows."""
    least = -(-sum(bins.fill) // bins.capacity)
    used = sum(1 for items in bins.items if items)
    bins.file()
    stepped = True
    while stepped and used > least:
        stepped, stuck = False, set()
        for a in sorted((b for b, items in enumerate(bins.items) if items), key=lambda b: (bins.fill[b], b)):
            while bins.items[a] and used > least:
                # bins that hold the same lengths are stuck together
                held = tuple(bins.lengths(a))
                if held in stuck:
                    break
                if not _step(bins, a):
                    stuck.add(held)
                    break
                stepped = True
                stuck.clear()
            used -= not bins.items[a]
    return bins


def pack_lengths(lengths: list[int], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece."""
    short = [k for k, n in enumerate(lengths) if n < capacity]
    bins = improve(best_fit([lengths[k] for k in short], capacity))
    sequence, offset = np.full(len(lengths), -1, np.int64), np.zeros(len(lengths), np.int64)
    n = 0
    for items in bins.items:
        at = 0
        for length, piece in reversed(items):
            sequence[short[piece]], offset[short[piece]] = n, at
            at += length
        n += bool(items)
    full = np.flatnonzero(sequence < 0)
    sequence[full] = n + np.arange(len(full))
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (any columns with length and row) with sequence_id and offset in place of row.

    Lengths lie between 1 and ``capacity``. An empty table gives an empty result.
    """
    stored = cut_lineage(pieces)
    groups = max(1, -(-stored.count() // group_pieces))
    kept = [f for f in stored.schema.fields if f.name != "row"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"

    def packed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", kind="stable")
        sequence, offset = pack_lengths(rows["length"].tolist(), capacity)
        out = rows[[f.name for f in kept]].copy()
        out["sequence_id"], out["offset"] = (int(key[0]) << 32) + sequence, offset
        return out

    group = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int")
    return stored.withColumn("__group", group).groupBy("__group").applyInPandas(
        lambda key, rows: packed(key, rows.drop(columns="__group")), schema
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A null text is the end id alone; repeated rows are packed each; other columns
    of ``docs`` are not read.
    """
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)
