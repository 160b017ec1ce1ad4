"""A segmented log-frequency Bloom filter, built by tasks and held by workers.

An item of level q is entered as (item, 1) to (item, q); its level is found again by
probing level after level. All entries of an item lie in one segment, so a segment is
built from the items that hash to it alone. With level 1 it is a plain Bloom filter.

A filter of bounded size is collected and broadcast (``build_filter``). One that grows with
the input stays a table of segments (``filter_table``), and items go to their segments (``probe``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.hashing import mix

PROBES, BITS_PER_ENTRY = 6, 12
SEGMENT_BITS = 1 << 19


class Filter:
    """Log-frequency Bloom filter over hashed items (64 bits, mixed)."""

    def __init__(self, bits: np.ndarray, segments: int):
        self.bits, self.segments = bits, segments
        self.shift = np.uint64(64 - (segments.bit_length() - 1)) if segments > 1 else None

    def segment(self, item: np.ndarray) -> np.ndarray:
        return (item >> self.shift).astype(np.int64) if self.shift is not None else np.zeros(len(item), np.int64)

    @staticmethod
    def places(item: np.ndarray, q: np.ndarray | int) -> Iterator[np.ndarray]:
        """Bit places of an entry within its segment."""
        h = mix(item + (np.asarray(q).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        step = (h >> np.uint64(32)) | np.uint64(1)
        for k in range(PROBES):
            yield ((h + np.uint64(k) * step) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64)

    def _held(self, item: np.ndarray, q: int) -> np.ndarray:
        """Places in ``item`` whose entry of level ``q`` is there; once a quarter has failed, only the others are probed on."""
        at, base = np.arange(len(item)), self.segment(item) * (SEGMENT_BITS // 8)
        h = mix(item + np.uint64(q * 0x9E3779B97F4A7C15 % (1 << 64)))
        step = (h >> np.uint64(32)) | np.uint64(1)
        there = np.ones(len(at), bool)
        for k in range(PROBES):
            bit = ((h + np.uint64(k) * step) & np.uint64(SEGMENT_BITS - 1)).astype(np.int64)
            there &= (self.bits[base + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1 == 1
            if k + 1 < PROBES and 4 * np.count_nonzero(there) < 3 * len(there):
                at, base, h, step = (x[there] for x in (at, base, h, step))
                there = np.ones(len(at), bool)
        return at[there]

    def levels(self, item: np.ndarray, least: int = 1) -> np.ndarray:
        """Level of each item, 0 where it is not there. Where all items of a kind have at least level ``least``, the levels
        between 1 and that one need no probes."""
        out = np.zeros(len(item), np.int64)
        alive = np.arange(len(item))
        for q in (1, *range(max(2, least), 127)):
            alive = alive[self._held(item[alive], q)]
            if not len(alive):
                break
            if q >= least:
                out[alive] = q
        return out


def segments_for(entries: int) -> int:
    """The number of segments, a power of two."""
    return 1 << (max(1, math.ceil(entries * BITS_PER_ENTRY / SEGMENT_BITS)) - 1).bit_length()


def _segment(segments: int) -> Column:
    return F.shiftrightunsigned("item", 64 - (segments.bit_length() - 1)).cast("int") if segments > 1 else F.lit(0)


def filter_table(items: DataFrame) -> tuple[DataFrame, int]:
    """(segment, bits) of the filter over stored (item, q), and the number of segments; segments without items are missing."""
    entries, rows = items.agg(F.coalesce(F.sum("q"), F.lit(0)), F.count("*")).first()
    segments = segments_for(entries)
    shape = Filter(np.zeros(0, np.uint8), segments)
    parts = max(1, math.ceil(rows / segments / 200_000))

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(SEGMENT_BITS, np.uint8)
        item, q = rows["item"].to_numpy().view(np.uint64), rows["q"].to_numpy()
        for turn in range(1, int(q.max()) + 1):
            for at in shape.places(item[q >= turn], turn):
                bits[at] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    def merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        every = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in rows["bits"]])
        return pd.DataFrame({"segment": [key[0]], "bits": [every.tobytes()]})

    schema = "segment int, bits binary"
    built = items.withColumns({"segment": _segment(segments), "part": F.pmod(F.xxhash64("item"), F.lit(parts))}).groupBy(
        "segment", "part"
    ).applyInPandas(lambda key, rows: build(key, rows), schema)
    if parts > 1:
        built = built.groupBy("segment").applyInPandas(merged, schema)
    return built, segments


def build_filter(items: DataFrame) -> Filter:
    """The filter over stored (item, q), collected; for items of bounded number."""
    built, segments = filter_table(items)
    bits = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for row in built.toLocalIterator():
        bits[row["segment"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return Filter(bits.ravel(), segments)


def probe(rows: DataFrame, table: DataFrame, segments: int) -> DataFrame:
    """``rows`` with q, the level of their ``item``; a task holds one segment and the rows that ask it."""

    def look(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        q = np.zeros(len(rows), np.int32)
        if len(rows) and len(held):
            bits = Filter(np.frombuffer(bytes(held["bits"].iloc[0]), np.uint8), 1)
            q[:] = bits.levels(rows["item"].to_numpy().view(np.uint64))
        return rows.drop(columns="segment").assign(q=q)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", q int"
    return rows.withColumn("segment", _segment(segments)).groupBy("segment").cogroup(table.groupBy("segment")).applyInPandas(look, schema)
