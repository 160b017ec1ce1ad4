"""Repeated byte strings by threshold-bounded interval expansion on Burrows-Wheeler transforms.

*Dealing.* Every window of ``length`` bytes belongs to its anchor, the least hash of its
``GRAM``-byte strings. Neighbouring windows with one anchor form a segment, and equal
windows meet under one anchor wherever they stand. Equal texts are one text from the start and
equal segments one class, both combined on the map side, so large groups of copies shrink
before they travel. An anchor with one segment in all has no repeats, unless it stands twice in
it; a lone class that occurs twice is repeated as a whole. Only classes that share an anchor with other classes are sent as
bytes, one copy each.

*Search.* A task takes its anchors in blocks of about ``BLOCK`` bytes and builds suffix order
and Burrows-Wheeler transform of a block (every segment ends in a symbol of its own). Common
prefixes of neighbouring suffixes are derived by increasing value: a border between two
intervals at value l, extended backwards by each symbol of the interval before it, gives the
borders at l + 1, breadth first. At ``length`` it stops; suffixes that no border parts
share that many bytes. Each border is set once, so the work follows the block's size.

An anchor with more than ``CLASSES`` classes (a passage in ever other surroundings) would
not fit a block. Its classes' windows are counted by 128 bits of hash each instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import python_ready
from flowspark.llm.hashing import PIECE, _eights, mix, powers
from flowspark.session import cut_lineage, scratch_path

GRAM = 32
#: A segment's windows at most; texts of few repeated bytes have one anchor for long stretches.
RUN = 512
SLICE = 1 << 20
#: More than the bytes of any piece that is hashed at once.
PLACES = 1 << 21
BLOCK = 2 << 20
CLASSES = 20_000
_SALT = 0x9E3779B9
_BACK = pow(int(powers(2)[1]), -1, 1 << 64)
_backs = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _backs
    if len(_backs) < n:
        out = np.full(max(n, 2 * len(_backs), 4096), _BACK, np.uint64)
        out[0] = 1
        _backs = np.multiply.accumulate(out)
    return _backs


# ---------------------------------------------------------------- segments


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte a hash of the ``GRAM`` bytes from it on (what lies beyond the end counts as zeros)."""
    padded = np.zeros(len(data) + GRAM, np.uint8)
    padded[: len(data)] = data
    h = _eights(padded)[:-1] * np.uint64(0x9DDFEA08EB382D69)
    h ^= h >> np.uint64(32)
    h = h[:-8] * np.uint64(0xFF51AFD7ED558CCD) + h[8:]
    return mix(h[:-16] * np.uint64(0xC4CEB9FE1A85EC53) + h[16:])[: len(data)]


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    if done < width:
        values = np.minimum(values[: len(values) - (width - done)], values[width - done :])
    return values


def segments(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(text, start in data, windows, anchor, hash, twice) of the segments of texts that lie at ``at`` in ``data``.

    ``twice``: the anchor stands at several places, so that the segment may repeat windows of its own.
    """
    size = np.diff(at) - length + 1
    text = np.flatnonzero(size > 0)
    if not len(text):
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.int64, bool))
    # the place in the low bits: of equal hashes the first counts, wherever the text lies
    hashes = gram_hashes(data) & ~np.uint64(PLACES - 1)
    first_least = least_in_window(hashes | np.arange(len(data), dtype=np.uint64), length - GRAM + 1)
    least = first_least & ~np.uint64(PLACES - 1)
    moved = np.zeros(len(least) + 1, np.int64)
    np.cumsum(first_least[1:] != first_least[:-1], out=moved[1 : len(least)])
    first, end = at[:-1][text], at[:-1][text] + size[text]
    new = np.zeros(len(least) + 1, bool)
    new[1 : len(least)] = least[1:] != least[:-1]
    inside = np.zeros(len(least) + 1, np.int8)
    inside[first] += 1
    np.add.at(inside, end, -1)
    new[: len(least)] &= np.cumsum(inside[: len(least)]) > 0
    new[first] = True
    start = np.flatnonzero(new)
    of = np.searchsorted(first, start, "right") - 1
    stop = np.minimum(np.append(start[1:], len(data)), end[of])
    parts = -(-(stop - start) // RUN)
    inside = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    anchor = mix(least[start]).view(np.int64)
    start, stop, of, anchor = (np.repeat(x, parts) for x in (start, stop, of, anchor))
    start = start + inside * RUN
    windows = np.minimum(stop - start, RUN)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[: len(data)], out=total[1:])
    content = (total[start + windows + length - 1] - total[start]) * _inverse_powers(len(data) + 1)[start]
    content = mix(content + windows.astype(np.uint64) * np.uint64(_SALT)).view(np.int64)
    return text[of], start, windows, anchor, content, moved[start + windows - 1] > moved[start]


def _slices(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces: (data, offsets, number of the text, place in the text). Long texts are cut into slices that overlap."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    everything = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    parts, held = [], 0
    for k in range(len(column)):
        for low in range(0, max(at[k + 1] - at[k] - length + 1, 0), SLICE):
            high = min(low + SLICE + length - 1, at[k + 1] - at[k])
            parts.append((k, low, everything[at[k] + low : at[k] + high]))
            held += high - low
            if held >= PIECE:
                yield _joined(parts)
                parts, held = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    text, low, bodies = zip(*parts)
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(b) for b in bodies], out=at[1:])
    return np.concatenate(bodies), at, np.array(text), np.array(low)


SEGMENT = "t1 long, t2 long, copies long, start long, windows int, anchor long, class long, twice int"


def _segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2, copies = (batch.column(c) for c in ("t1", "t2", "copies"))
            for data, at, number, low in _slices(batch.column("body"), length):
                part, start, windows, anchor, content, twice = segments(data, at, length)
                row = pa.array(number[part])
                yield pa.RecordBatch.from_arrays([
                    t1.take(row), t2.take(row), copies.take(row), pa.array(start - at[part] + low[part]),
                    pa.array(windows.astype(np.int32)), pa.array(anchor), pa.array(content), pa.array(twice.astype(np.int32)),
                ], names=["t1", "t2", "copies", "start", "windows", "anchor", "class", "twice"])

    return run


# ---------------------------------------------------------------- search


def _suffixes(data: np.ndarray, left: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix order, its inverse, and the common prefixes of neighbours where they are below 8 (else 8).

    ``left`` is the distance to the end of the own segment, ``which`` the segment: its end is
    smaller than every byte, and ends differ by segment.
    """
    n, segs = len(data), int(which[-1]) + 1
    eight = _eights(data)[:n].byteswap()
    keep = np.minimum(left, 8)
    masks = np.array([(~0 << (64 - 8 * k)) & (2**64 - 1) for k in range(9)], np.uint64)
    eight = eight & masks[keep]
    tail = keep * (segs + 1) + np.where(keep < 8, which + 1, 0)
    order = np.lexsort((tail, eight))
    a, b = order[:-1], order[1:]
    differ = eight[a] ^ eight[b]
    common = np.full(n, 8, np.int64)
    common[0] = 0
    same = np.zeros(n - 1, np.int64)
    for k in range(1, 9):
        same += (differ >> np.uint64(64 - 8 * k)) == 0
    common[1:] = np.minimum(same, np.minimum(keep[a], keep[b]))
    start = np.ones(n, bool)
    start[1:] = common[1:] < 8
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    tied = ~start
    tied[:-1] |= ~start[1:]
    todo, h = np.flatnonzero(tied), 8
    while len(todo):
        here = order[todo]
        key = rank[here] * n + rank[here + h]
        by = np.argsort(key, kind="stable")
        here, key = here[by], key[by]
        order[todo] = here
        new = np.ones(len(todo), bool)
        new[1:] = key[1:] != key[:-1]
        rank[here] = todo[np.maximum.accumulate(np.where(new, np.arange(len(todo)), 0))]
        alone = new.copy()
        alone[:-1] &= new[1:]
        todo, h = todo[~alone], 2 * h
    return order, rank, common


def _borders_before(held: bytearray, front: np.ndarray) -> np.ndarray:
    """The last border before each place of ``front``; ``held`` is 1 at every border."""
    border = np.frombuffer(held, bool)
    low = front - 1
    far = np.flatnonzero(~border[low])
    # most are a few places away
    for _ in range(16):
        low[far] -= 1
        far = far[~border[low[far]]]
    low[far] = [held.rfind(1, 0, place) for place in low[far].tolist()]
    return low


def repeated_windows(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, the places of its windows of ``length`` bytes that another place of any segment holds too."""
    sizes = np.array([len(b) for b in bodies])
    data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    n, which = len(data), np.repeat(np.arange(len(bodies)), sizes + 1)
    ends = np.cumsum(sizes + 1) - 1
    left = ends[which] - np.arange(n)
    order, rank, common = _suffixes(data, left, which)
    # the transform: the byte before each suffix; a segment's first byte has none
    before = order - 1
    begins = np.ones(n, bool)
    begins[1:] = left[:-1] == 0
    extends = ~begins[order]
    back = np.where(extends, rank[before], 0)
    # the next suffix after the same byte: neighbours stay neighbours under backward extension
    follows = np.append(rank[1:], 0)  # by place: rank of the suffix one byte shorter
    after = np.minimum(back + 1, n - 1)
    same = extends & (back + 1 < n) & (data[order[after]] == data[before]) & (left[order[after]] > 0)
    following = np.where(same, follows[order[after]], n)
    held = bytearray(np.append(common < 8, True).tobytes())  # the last one beyond the last suffix
    border = np.frombuffer(held, bool)
    front = np.append(np.flatnonzero(common == 7), n)
    for _ in range(8, length):
        if not len(front):
            break
        low = _borders_before(held, front)
        size = front - low
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        # the last one of each byte within its interval
        last = inside[extends[inside] & (following[inside] >= np.repeat(front, size))]
        reached = back[last] + 1
        front = np.sort(reached[~border[reached]])
        border[front] = True
    shared = ~border[:-1]
    shared[:-1] |= ~border[1:-1]
    place = np.sort(order[shared])
    owner = which[place]
    cut = np.searchsorted(owner, np.arange(len(bodies) + 1))
    offset = place - (ends - sizes)[owner]
    return [offset[cut[k] : cut[k + 1]] for k in range(len(bodies))]


def _runs(places: np.ndarray) -> list[int]:
    """Sorted places as from, to, from, to, ..."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    first = places[np.insert(cut, 0, 0)]
    last = places[np.append(cut - 1, len(places) - 1)] + 1
    return np.stack([first, last], 1).ravel().tolist()


FOUND = "anchor long, class long, runs array<int>"


def _search(length: int):
    schema = pa.schema([("anchor", pa.int64()), ("class", pa.int64()), ("runs", pa.list_(pa.int32()))])

    def block(rows: list[tuple]) -> pa.RecordBatch:
        found = repeated_windows([r[3] for r in rows], length)
        runs = [[0, len(r[3]) - length + 1] if r[2] > 1 else _runs(f) for r, f in zip(rows, found)]
        some = [(r[0], r[1], f) for r, f in zip(rows, runs) if f]
        return pa.RecordBatch.from_arrays([pa.array([s[k] for s in some], schema.field(k).type) for k in range(3)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if size >= BLOCK and row[0] != rows[-1][0]:
                    yield block(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield block(rows)

    return run


def _bodies(length: int):
    """Texts with places of classes: the bytes of each class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, places in zip(batch.column("body"), batch.column("places")):
                body, places = body.as_py(), places.as_py()
                for first in range(0, len(places), 4096):
                    some = places[first : first + 4096]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p["anchor"] for p in some], pa.int64()), pa.array([p["class"] for p in some], pa.int64()),
                        pa.array([p["n"] for p in some], pa.int64()),
                        pa.array([body[p["start"] : p["start"] + p["windows"] + length - 1] for p in some], pa.binary()),
                    ], names=["anchor", "class", "n", "body"])

    return run


def _windows(length: int):
    """Classes with their bytes: two hashes of each window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, content, n, body in zip(*[c.to_pylist() for c in batch.columns]):
                data = np.frombuffer(body, np.uint8)
                found = []
                for salt in (1, 0x1D):
                    total = np.zeros(len(data) + 1, np.uint64)
                    value = mix(data.astype(np.uint64) + np.uint64(salt << 8))
                    np.cumsum(value * powers(len(data) + 1)[: len(data)], out=total[1:])
                    found.append(mix((total[length:] - total[:-length]) * _inverse_powers(len(data) + 1)[: len(data) - length + 1]))
                width = len(found[0])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(width, anchor)), pa.array(np.full(width, content)), pa.array(np.full(width, n)),
                    pa.array(np.arange(width, dtype=np.int32)), *[pa.array(f.view(np.int64)) for f in found],
                ], names=["anchor", "class", "n", "place", "w1", "w2"])

    return run


# ---------------------------------------------------------------- texts and documents


def identified(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs`` (null: empty), and 128 bits of hash that stand for the text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(_SALT), "text").alias("t2")
    )


def distinct_texts(docs: DataFrame) -> DataFrame:
    """t1, t2, body, copies (2 for more): each text once, combined before it travels.

    Stored in buckets of (t1, t2) in the scratch folder: texts travel this once, and later
    joins bring what belongs to a text to it. They are dealt as for their grouping, so a
    bucket is one file, and by all columns that joins use, without which Spark deals them anew.
    """
    spark = docs.sparkSession
    same = identified(docs).groupBy("t1", "t2").agg(F.any_value("text").alias("text"), F.count("*").alias("n"))
    texts = same.select("t1", "t2", F.encode("text", "UTF-8").alias("body"), F.least("n", F.lit(2).cast("long")).alias("copies"))
    path = scratch_path(spark, "texts")
    name = "texts_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = texts.write.format("parquet").option("path", path).option("compression", "zstd")
    writer.bucketBy(buckets, "t1", "t2").sortBy("t1", "t2").saveAsTable(name)
    return spark.table(name)


def text_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """t1, t2, body, copies, spans: each distinct text and its windows that also start elsewhere.

    ``spans`` has one struct (start, runs) per segment: runs are from, to, ... places of windows
    from ``start`` on. Null where nothing repeats.
    """
    if length <= GRAM:
        raise ValueError(f"strings of more than {GRAM} bytes only")
    python_ready(docs.sparkSession)
    texts = distinct_texts(docs)
    cut = cut_lineage(texts.mapInArrow(_segments(length), SEGMENT))
    classes = cut.groupBy("anchor", "class").agg(F.sum("copies").alias("n"), F.max("twice").alias("twice"))
    anchors = classes.groupBy("anchor").agg(
        F.sum("n").alias("all"), F.max("twice").alias("any"), F.count("*").alias("classes")
    ).filter((F.col("all") > 1) | (F.col("any") > 0)).select("anchor", "classes")
    shared = classes.select("anchor", "class", "n").join(anchors, "anchor")
    hits = cut_lineage(cut.drop("copies", "twice").join(shared, ["anchor", "class"]))
    alone = (F.col("classes") == 1) & (F.col("n") > 1)

    def bodies(some: DataFrame) -> DataFrame:
        place = [F.any_value(c).alias(c) for c in ("n", "t1", "t2", "start", "windows")]
        places = some.groupBy("anchor", "class").agg(*place).groupBy("t1", "t2").agg(
            F.collect_list(F.struct("start", "windows", "anchor", "class", "n")).alias("places")
        )
        return texts.join(places, ["t1", "t2"]).mapInArrow(_bodies(length), "anchor long, class long, n long, body binary")

    searched = (
        bodies(hits.filter(~alone & (F.col("classes") <= CLASSES)))
        .repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_search(length), FOUND)
    )
    windows = bodies(hits.filter(F.col("classes") > CLASSES)).mapInArrow(
        _windows(length), "anchor long, class long, n long, place int, w1 long, w2 long"
    )
    again = windows.groupBy("w1", "w2").agg(F.sum("n").alias("all")).filter(F.col("all") > 1)
    counted = windows.join(again, ["w1", "w2"]).groupBy("anchor", "class").agg(
        F.flatten(F.collect_list(F.array(F.col("place"), F.col("place") + 1))).alias("runs")
    )
    found = cut_lineage(searched.unionByName(counted))
    spans = hits.filter(alone).select("t1", "t2", "start", F.array(F.lit(0), F.col("windows")).alias("runs")).unionByName(
        hits.filter(~alone).join(found, ["anchor", "class"]).select("t1", "t2", "start", "runs")
    ).groupBy("t1", "t2").agg(F.collect_list(F.struct("start", "runs")).alias("spans"))
    return texts.join(spans, ["t1", "t2"], "left")


def _covered(spans: list | None, copies: int, size: int, length: int) -> list[list[int]]:
    """Maximal runs of bytes that repeated windows cover."""
    if size < length:
        return []
    if copies > 1:
        return [[0, size]]
    runs = sorted((s["start"] + a, s["start"] + b - 1 + length) for s in spans or [] for a, b in zip(s["runs"][::2], s["runs"][1::2]))
    out: list[list[int]] = []
    for a, b in runs:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


CLEANED = "t1 long, t2 long, n_bytes long, removed array<struct<first:long,end:long>>, kept binary"


def cleaned_texts(docs: DataFrame, length: int = 200) -> DataFrame:
    """t1, t2, n_bytes, removed (runs of bytes, end excluded) and kept (all other bytes) of each distinct text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t1, t2, body, copies, spans in zip(*[batch.column(c) for c in ("t1", "t2", "body", "copies", "spans")]):
                body = body.as_py()
                gone = _covered(spans.as_py(), copies.as_py(), len(body), length)
                at = [0, *[x for run in gone for x in run], len(body)]
                kept = b"".join(body[a:b] for a, b in zip(at[::2], at[1::2]))
                yield pa.RecordBatch.from_pylist([{
                    "t1": t1.as_py(), "t2": t2.as_py(), "n_bytes": len(body),
                    "removed": [{"first": a, "end": b} for a, b in gone], "kept": kept,
                }], schema=arrow)

    arrow = pa.schema([
        ("t1", pa.int64()), ("t2", pa.int64()), ("n_bytes", pa.int64()),
        ("removed", pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()),
    ])
    return text_spans(docs, length).mapInArrow(run, CLEANED)


def per_document(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """doc_id and what ``texts`` holds for the document's text."""
    return identified(docs).select("doc_id", "t1", "t2").join(texts, ["t1", "t2"]).drop("t1", "t2")


def remove_repeats(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, removed and kept for every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, null ones empty. Removed is every byte that a string of ``length``
    bytes covers which also starts at another place of any document; strings never reach
    across documents and are judged on the input. Repeated rows are documents of their own,
    whatever their ids; other columns are left out; an empty table gives no rows.
    """
    return per_document(docs, cleaned_texts(docs, length))
