"""Token ids in Simple-8b files: word-aligned coding with vectorised decoding.

A 64-bit word holds a selector in its upper four bits and ``n`` ids of ``60 // n``
bits below, the first id lowest. Selectors 0 to 13 stand for the counts in
``COUNTS``; selector 15 stands for one id of more than 60 bits, which lies in the
block's list of escapes, in order. The encoder always takes the most ids that fit.

A file row is a block of whole documents, at least ``BLOCK_IDS`` ids but for the
last of a part: ``part`` and ``block`` number it, ``start`` is the number of ids
before it in its part, ``doc_ids`` and ``lengths`` describe its documents, ``words``
and ``escapes`` are little-endian 64-bit words. Parts follow each other in the
order of doc_id, so a document's place in the whole is the ids of earlier parts
plus ``start`` plus the lengths before it in its block. Files are Parquet written by
Spark itself: commits, retries and remote stores are Spark's.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowspark.llm.common import python_ready
from flowspark.llm.tokens import encoder
from flowspark.session import scratch_path

#: Ids in a word, by selector.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
ESCAPE = 15
BLOCK_IDS = 1 << 16
#: Documents encoded at a time.
STEP = 256
_COUNT_OF = np.concatenate([COUNTS, [0, 1]])


def encode_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned 64-bit ids."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    if not n:
        return ids, ids
    # bits of each id; rounding may add one to huge ids, which then only take a wider slot
    bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    choice = np.full(n, len(COUNTS) - 1, np.uint8)
    widest = {1: bits}
    for sel in range(len(COUNTS) - 2, -1, -1):
        count = int(COUNTS[sel])
        half = min(c for c in widest if 2 * c >= count)
        if count > n:
            break
        w = widest[half]
        widest[count] = np.maximum(w[: n - count + 1], w[count - half : n - half + 1])
        choice[: n - count + 1][widest[count] <= 60 // count] = sel
    choice[bits > 60] = ESCAPE
    step = _COUNT_OF[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    start = np.array(starts)
    selector = choice[start]
    words = selector.astype(np.uint64) << np.uint64(60)
    for sel in np.unique(selector):
        if sel == ESCAPE:
            continue
        count = int(COUNTS[sel])
        rows = np.flatnonzero(selector == sel)
        shifts = (np.arange(count) * (60 // count)).astype(np.uint64)
        words[rows] |= np.bitwise_or.reduce(ids[start[rows][:, None] + np.arange(count)] << shifts, axis=1)
    return words, ids[start[selector == ESCAPE]]


def decode_block(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit ids of a block."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = _COUNT_OF[selector]
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for sel in np.unique(selector):
        rows = np.flatnonzero(selector == sel)
        if sel == ESCAPE:
            out[start[rows]] = escapes
            continue
        n = int(COUNTS[sel])
        shifts = (np.arange(n) * (60 // n)).astype(np.uint64)
        keep = np.uint64((1 << (60 // n)) - 1)
        out[start[rows][:, None] + np.arange(n)] = (words[rows][:, None] >> shifts) & keep
    return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode whole texts (null: empty), add ``end_id`` to each, and write them in
    ascending order of doc_id (null first; ties by the text's hash).

    Texts are sorted by range and encoded where they then lie, so ids are never
    shuffled. A task holds one Arrow batch and one open block. An empty table gives
    an empty file. Repeated rows are written each.
    """
    python_ready(docs.sparkSession)
    key = docs.schema["doc_id"].dataType
    block = pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("doc_ids", pa.list_(to_arrow_type(key))),
        ("lengths", pa.list_(pa.int64())), ("words", pa.large_binary()), ("escapes", pa.large_binary()),
    ])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        number = start = 0
        doc_ids: list = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def closed() -> pa.RecordBatch:
            nonlocal number, start, doc_ids, lengths, ids
            every = np.concatenate(ids)
            words, escapes = encode_block(every)
            out = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(
                ([part], [number], [start], [doc_ids], [np.concatenate(lengths)], [words.astype("<u8").tobytes()], [escapes.astype("<u8").tobytes()]), block,
            )], schema=block)
            number, start, doc_ids, lengths, ids = number + 1, start + len(every), [], [], []
            return out

        held = 0
        for batch in batches:
            names, texts = batch.column(0), batch.column(1)
            first = 0
            while first < batch.num_rows:
                some = texts.slice(first, STEP)
                found, sizes = enc.encode_many(some)
                ends = np.cumsum(sizes)
                ids.append(np.insert(found.astype(np.uint32), ends, end_id))
                lengths.append(sizes + 1)
                doc_ids += names.slice(first, STEP).to_pylist()
                held += len(found) + len(sizes)
                first += STEP
                if held >= BLOCK_IDS:
                    yield closed()
                    held = 0
        if doc_ids:
            yield closed()

    place = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", place).sortWithinPartitions("doc_id", place)
    schema = f"part int, block int, start long, doc_ids array<{key.simpleString()}>, lengths array<long>, words binary, escapes binary"
    ordered.mapInArrow(blocks, schema).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), ids (array<long>)."""
    return _read(spark, path, False)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_tokens`` with n_tokens and ids_crc32 (unsigned, ids as little-endian 32 bits) in place of ids."""
    return _read(spark, path, True)


def _read(spark: SparkSession, path: str, digest: bool) -> DataFrame:
    python_ready(spark)
    files = spark.read.parquet(path)
    key = files.schema["doc_ids"].dataType.elementType
    # one row per part of the file, which is what the parts' order needs
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)
    parts = files.groupBy("part").agg(F.sum(size).alias("ids")).select(
        "part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before")
    )
    placed = files.join(F.broadcast(parts), "part").select(
        "doc_ids", "lengths", (F.col("before") + F.col("start")).alias("start"), "words", "escapes"
    )
    kinds = [("n_tokens", pa.int64()), ("ids_crc32", pa.int64())] if digest else [("ids", pa.list_(pa.int64()))]
    result = pa.schema([("doc_id", to_arrow_type(key)), ("start", pa.int64()), *kinds])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, lengths, start, words, escapes = (c[row] for c in batch.columns)
                ids = decode_block(np.frombuffer(words.as_buffer(), "<u8"), np.frombuffer(escapes.as_buffer(), "<u8"))
                sizes = lengths.values.to_numpy()
                ends = np.concatenate([[0], np.cumsum(sizes)])
                if digest:
                    small = ids.astype("<u4")
                    more = [pa.array(sizes), pa.array([zlib.crc32(small[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())]
                else:
                    more = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int64)))]
                yield pa.RecordBatch.from_arrays([doc_ids.values, pa.array(start.as_py() + ends[:-1]), *more], schema=result)

    more = "n_tokens long, ids_crc32 long" if digest else "ids array<long>"
    return placed.mapInArrow(documents, f"doc_id {key.simpleString()}, start long, {more}")


def token_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` to a new file below the shared scratch folder and read it back as digests."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_digests(docs.sparkSession, path)
