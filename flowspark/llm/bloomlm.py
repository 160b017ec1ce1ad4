"""Language-model scoring with a log-frequency Bloom filter.

The model is a word bigram that backs off to one of classes. After a word, or at
the start, a word or the end has the part that its count as a pair has of the
count of the word before, and ``BACK_OFF`` counts more go to the classes. All pairs are in
the model; the ``HEAD_PAIRS`` most frequent ones of frequent words are in the broadcast filter. The places of
all others go, packed, to a bucket of their pair or of its rare word; there those of training texts are its count,
and what the bucket's places add to each text goes back as one sum. The ``CLASSES`` most
frequent words are classes of their own, all other words share one, and texts begin and end
with a boundary. The class of a word depends on the class before it, smoothed by the class's
own share; a word of the shared class then has its count's part of that class, of which the
share of words seen once (Good-Turing) is set aside for unseen words. As in the plain score,
all unseen words are one event, so both are probabilities over the same events.

Counts of words, word pairs, classes and class pairs lie quantised in Bloom filters: an item of
level q, its rounded logarithm, is entered as (item, 1) to (item, q), and is looked up
by probing level after level until one is missing. A count is never taken too low; too
high with the filter's error rate. A filter is cut into segments, each built by one
task from the items that hash to it, and its size follows the number of entries, so the
error rate stays the same. The class pairs and the most frequent words and word pairs, all bounded in
number, have a filter that is broadcast. All other word pairs are counted in their buckets, quantised alike. The filter of all other words grows with the corpus: it stays
a table of segments, and each distinct rare word of the texts is sent to its segment once.

The plain score beside it needs exact counts. The most frequent words, a bounded
number, go to the workers as a table; the rest of each document's words meet their
counts in the buckets of their places, which have no hot keys left.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from flowspark.llm.bloom import Filter, build_filter, filter_table, probe
from flowspark.llm.common import python_ready, without
from flowspark.llm.hashing import Piece, Places, first_eight, mix, pieces, span_array, span_hashes
from flowspark.session import cut_lineage

#: Classes of the bigram: the boundary, the shared class, and the most frequent words.
CLASSES = 1024
BOUNDARY, SHARED = 0, 1
#: Quantisation: level q holds counts from LOG_BASE^(q-1) up to LOG_BASE^q.
LOG_BASE = 1.5
#: Weight of a class's own share against its counts after another class, in counts.
LOWER_ORDER = 500.0
HEAD_WORDS = 200_000
#: Word pairs in the broadcast filter at most (0: a model without word pairs), and the counts that every word leaves to the back-off.
HEAD_PAIRS = 1_000_000
BACK_OFF = 50.0
#: Pairs that a task holds before it folds equal ones.
FOLD_PAIRS = 1 << 20
#: Places that a task holds before it counts them, open places before it packs them, words of the corpus for which there is a
#: bucket, and numbers of words before in a row.
FOLD_PLACES, OPEN_PLACES, BUCKET_WORDS, KEPT_NUMBERS = 1 << 20, 1 << 19, 2 << 20, 1 << 14
SMOOTHING = 0.1
MAX_KEPT, SLOTS = 500_000, 1 << 20
OUTPUT = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept out of training; one without id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


def level(count: np.ndarray | float) -> np.ndarray:
    """Quantised level of counts of at least 1."""
    return 1 + np.floor(np.log(np.maximum(count, 1)) / math.log(LOG_BASE) + 1e-9).astype(np.int64)


def level_values(levels: int = 128) -> np.ndarray:
    """The count each level stands for, the mean of its whole numbers where it has any; level 0 is no count."""
    out = np.zeros(levels)
    for q in range(1, levels):
        low, high = LOG_BASE ** (q - 1), LOG_BASE**q
        first, last = math.ceil(low - 1e-9), math.ceil(high - 1e-9) - 1
        out[q] = (first + last) / 2 if last >= first else low
    return out


def word_item(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ np.uint64(0xA0761D6478BD642F))


def class_item(numbers: np.ndarray) -> np.ndarray:
    """Items of class pairs, numbered from 0, and of classes behind them."""
    return mix(numbers.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))


def pair_item(numbers: np.ndarray) -> np.ndarray:
    """Items of word pairs, numbered as in :func:`word_pair_counts`."""
    return mix(numbers.astype(np.uint64) + np.uint64(0x9FB21C651E98DF25))


def head_numbers(hashes: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Number of each word from 1 on among the sorted hashes of the frequent words, -1 for others; 0 is the boundary."""
    if not len(head):
        return np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(head, hashes), len(head) - 1)
    return np.where(head[at] == hashes, at + 1, -1)


def classes_of(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Class of each word, from the sorted hashes of the words with a class of their own."""
    if not len(known):
        return np.full(len(hashes), SHARED, np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 2, SHARED)


def previous_classes(classes: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """Class before each word of texts that lie one after the other."""
    out = np.empty_like(classes)
    out[1:] = classes[:-1]
    starts = word_at[:-1]
    out[starts[starts < len(out)]] = BOUNDARY
    return out


def last_classes(classes: np.ndarray, word_at: np.ndarray) -> np.ndarray:
    """Class before each text's end."""
    full = np.diff(word_at) > 0
    out = np.full(len(word_at) - 1, BOUNDARY, np.int64)
    out[full] = classes[word_at[1:][full] - 1]
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words in ``docs`` (text, held_out), counted in the texts that are not held out; words are bytes,
    A-Z lower-cased."""
    python_ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            learned = ~batch.column(1).to_numpy(zero_copy_only=False)
            for piece in pieces(batch.column(0), lower=True, size=1 << 21):
                hashes = piece.word_hashes()
                _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
                n = np.bincount(back[np.repeat(learned[piece.first : piece.first + piece.texts], piece.n_words)], minlength=len(first))
                words = span_array(piece.data, piece.word_start[first], piece.word_end[first])
                yield pa.RecordBatch.from_arrays([words.cast(pa.binary()), pa.array(n)], names=["word", "c"])

    return docs.select("text", "held_out").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _joined(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends) of a binary column."""
    words = words.cast(pa.large_binary())
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    body = words.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(1, np.uint8)
    return data, at[:-1], at[1:]


def _folded(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and their summed counts."""
    numbers = np.concatenate([p for p, _ in parts])
    order = np.argsort(numbers, kind="stable")
    numbers = numbers[order]
    first = np.flatnonzero(np.diff(numbers, prepend=-1))
    return numbers[first], np.add.reduceat(np.concatenate([n for _, n in parts])[order], first) if len(first) else numbers


def word_pair_counts(docs: DataFrame, head: np.ndarray) -> DataFrame:
    """(pair, c): neighbours that are both frequent words or the boundary, numbered first << 32 | second. A task
    folds equal pairs before it gives them away."""
    python_ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        give = lambda some: pa.RecordBatch.from_arrays([pa.array(x) for x in some], names=["pair", "c"])
        for batch in batches:
            for piece in pieces(batch.column(0), lower=True):
                own = head_numbers(piece.word_hashes(), head)
                first = np.concatenate([previous_classes(own, piece.word_at), last_classes(own, piece.word_at)])
                second = np.concatenate([own, np.zeros(piece.texts, np.int64)])
                both = (first >= 0) & (second >= 0)
                parts.append(np.unique(first[both] << 32 | second[both], return_counts=True))
                held += len(parts[-1][0])
                if held > FOLD_PAIRS:
                    parts = [_folded(parts)]
                    held = len(parts[0][0])
                    if held > FOLD_PAIRS // 2:
                        yield give(parts[0])
                        parts, held = [], 0
        if parts:
            yield give(_folded(parts))

    return docs.select("text").mapInArrow(count, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))


def word_keys(hashes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Key of each word in pairs: its number if it is frequent, else its hash below 0."""
    return np.where(numbers >= 0, numbers, (hashes | np.uint64(1 << 63)).view(np.int64))


def rare_pair_counts(docs: DataFrame, head: np.ndarray) -> DataFrame:
    """(first, second, c): neighbours of which one at least is not frequent, by their keys; 0 is the boundary."""
    python_ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(0), lower=True):
                hashes = np.maximum(piece.word_hashes(), np.uint64(1))
                own = word_keys(hashes, head_numbers(hashes, head))
                first = np.concatenate([previous_classes(own, piece.word_at), last_classes(own, piece.word_at)])
                second = np.concatenate([own, np.zeros(piece.texts, np.int64)])
                rare = (first < 0) | (second < 0)
                yield pa.RecordBatch.from_arrays([pa.array(first[rare]), pa.array(second[rare])], names=["first", "second"])

    return docs.select("text").mapInArrow(count, "first long, second long").groupBy("first", "second").agg(F.count("*").alias("c"))


def pair_value(c: Column) -> Column:
    """The count that the level of a count stands for, 0 for none."""
    q = (F.floor(F.log(c.cast("double")) / math.log(LOG_BASE) + 1e-9) + 2).cast("int")
    return F.when(c > 0, F.element_at(F.array(*[F.lit(float(x)) for x in level_values()]), q)).otherwise(F.lit(0.0))


def words_before(pairs: DataFrame, rare_pairs: DataFrame) -> DataFrame:
    """(first, kept, n) over all pairs: what the quantised counts after a word sum to, and the counts."""
    return pairs.select(F.shiftright("pair", 32).alias("first"), "c").unionByName(rare_pairs.select("first", "c")).groupBy("first").agg(
        F.sum(pair_value(F.col("c"))).alias("kept"), F.sum("c").alias("n")
    )


def pair_items(pairs: DataFrame) -> DataFrame:
    """(item, c) of word pairs."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = pair_item(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(item.view(np.int64)), batch.column(1)], names=["item", "c"])

    return pairs.select("pair", "c").mapInArrow(hashed, "item long, c long")


class PairModel(NamedTuple):
    """What the word pairs need beside the filter: the least level of a pair in it; and per number of a word
    before, the counts of its pairs in the filter and all of its counts, the back-off included."""

    least: int
    kept: np.ndarray
    total: np.ndarray


def pair_model(pairs: DataFrame, counts: np.ndarray) -> PairModel:
    """The model of stored frequent pairs (pair, c), with ``counts`` per number of a word before."""
    value = F.element_at(F.array(*[F.lit(float(x)) for x in level_values()]), F.col("q") + 1)
    by_first = leveled(pairs.withColumn("item", F.shiftright("pair", 32))).groupBy("item").agg(
        F.sum(value).alias("kept"), F.min("q").alias("least")
    ).toPandas()  # at most one row per frequent word
    kept = np.zeros(len(counts))
    kept[by_first["item"].to_numpy(np.int64)] = by_first["kept"].to_numpy(np.float64)
    return PairModel(int(by_first["least"].min()) if len(by_first) else 1, kept, np.maximum(counts, kept) + BACK_OFF)


def word_items(words: DataFrame) -> DataFrame:
    """``words`` (word, c) with item, the word's hash in the filters."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = word_item(span_hashes(*_joined(batch.column(0))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(item.view(np.int64))], names=["word", "c", "item"])

    return words.select("word", "c").mapInArrow(hashed, "word binary, c long, item long")


def rare_items(words: DataFrame) -> DataFrame:
    """(second, item, c) of rare words (word, c): their keys in pairs and their hashes in the filters."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = span_hashes(*_joined(batch.column(0)))
            keys = word_keys(np.maximum(hashes, np.uint64(1)), np.full(len(hashes), -1))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(word_item(hashes).view(np.int64)), batch.column(1)], names=["second", "item", "c"])

    return words.select("word", "c").mapInArrow(hashed, "second long, item long, c long")


def class_items(pairs: DataFrame) -> DataFrame:
    """(item, c) of class pairs and of the classes alone."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = class_item(batch.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(item.view(np.int64)), batch.column(1)], names=["item", "c"])

    own = pairs.groupBy((F.col("pair") % CLASSES + CLASSES * CLASSES).alias("pair")).agg(F.sum("c").alias("c"))
    return pairs.select("pair", "c").unionByName(own).mapInArrow(hashed, "item long, c long")


def leveled(items: DataFrame) -> DataFrame:
    """(item, q) of (item, c)."""
    q = (F.floor(F.log(F.col("c").cast("double")) / math.log(LOG_BASE) + 1e-9) + 1).cast("int")
    return items.select("item", q.alias("q"))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The rows of (word, c) above the least count at which they are at most ``limit``, counts taken in steps of 1/64 of
    their logarithm. A sort with a limit would send that many rows of every partition to the driver."""
    step = F.floor(F.log(F.col("c").cast("double")) * 64)
    # some thousand rows at most
    least = least_step(((r["step"], r["n"]) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), limit)
    return counts.filter(F.lit(False) if least is None else step >= least)


def least_step(steps: Iterable[tuple[int, int]], limit: int) -> int | None:
    """The least step from which on at most ``limit`` rows lie, of (step, rows); None if there is none."""
    total, least = 0, None
    for at, n in sorted(steps, reverse=True):
        total += n
        if total > limit:
            break
        least = at
    return least


def shared_class_log(count: np.ndarray, rare: int, unseen: float) -> np.ndarray:
    """log10 of a word's part of the shared class, which holds ``rare`` tokens; a count of 0 is the event of all unseen words."""
    return np.log10(np.where(count > 0, np.maximum(1e-300, 1 - unseen) * np.minimum(1, count / rare), unseen))


def unseen_share(rare: int, once: int) -> float:
    """Share of the shared class that is set aside for unseen words."""
    return min(1.0, (once + 1) / (rare + 1))


class WordScorer:
    """Probabilities of words, and what the table of frequent words says of them; keeps what it has seen."""

    def __init__(
        self, bits: Filter, head: tuple[np.ndarray, np.ndarray], known: np.ndarray, rare: int, once: int, pairs: PairModel
    ):
        self.filter, self.head, self.known, self.pairs = bits, head, known, pairs
        self.value = level_values()
        self.rare = max(1, rare)
        self.unseen = unseen_share(rare, once)
        self.pair_log = self._pairs()
        self._numbered = None
        self._forget()

    def _pairs(self) -> np.ndarray:
        """log10 of each class after each other one; rows sum to one."""
        used = len(self.known) + 2
        parts = np.array_split(np.arange(CLASSES * CLASSES), 16)
        c = np.concatenate([self.value[self.filter.levels(class_item(x))] for x in parts]).reshape(CLASSES, CLASSES)[:used, :used]
        own = self.value[self.filter.levels(class_item(CLASSES * CLASSES + np.arange(used)))] + 0.5
        p = c + LOWER_ORDER * own / own.sum()
        return np.log10(p / p.sum(axis=1, keepdims=True))

    def numbered(self) -> tuple[np.ndarray, np.ndarray]:
        """Class and log_p (within its class) of each number of a frequent word, those of the boundary first."""
        if self._numbered is None:
            keys = self.head[0]
            own = np.concatenate([[BOUNDARY], classes_of(keys, self.known)])
            c = np.concatenate([[0], self.value[self.filter.levels(word_item(keys))]])
            self._numbered = own, np.where(own == SHARED, shared_class_log(c, self.rare, self.unseen), 0.0)
        return self._numbered

    def _forget(self) -> None:
        self.words = None
        self.log_p, self.head_log = np.zeros(1 << 16), np.zeros(1 << 16)
        self.own, self.number = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.n_words = 0

    @staticmethod
    def _grown(array: np.ndarray, n: int) -> np.ndarray:
        while len(array) < n:
            array = np.concatenate([array, np.zeros_like(array)])
        return array

    def places(self, piece: Piece) -> np.ndarray:
        """Place of each word of a piece in ``own`` (class), ``number`` (as a frequent word), ``log_p`` (within its class)
        and ``head_log``."""
        if self.words and self.words.kept > MAX_KEPT:
            self._forget()
        self.words = self.words or Places(SLOTS)
        hashes = np.maximum(piece.word_hashes(), np.uint64(1))
        size = (piece.word_end - piece.word_start).astype(np.uint64)
        check = first_eight(piece.data, piece.word_start, piece.word_end) + size * np.uint64(0x9E3779B97F4A7C15)
        place = self.words.find(hashes, check)
        new = np.flatnonzero(place < 0)
        if len(new):
            _, first, back = np.unique(mix(hashes[new] ^ mix(check[new])), return_index=True, return_inverse=True)
            first = new[first]
            last = self.n_words + len(first)
            here = slice(self.n_words, last)
            self.log_p, self.head_log, self.own, self.number = (
                self._grown(x, last) for x in (self.log_p, self.head_log, self.own, self.number)
            )
            self.own[here] = classes_of(hashes[first], self.known)
            c = self.value[self.filter.levels(word_item(hashes[first]))]
            self.log_p[here] = np.where(self.own[here] == SHARED, shared_class_log(c, self.rare, self.unseen), 0.0)
            keys, counts = self.head
            self.number[here] = at = head_numbers(hashes[first], keys)
            self.head_log[here] = np.where(at > 0, np.log10(np.append(np.nan, counts)[np.maximum(at, 0)] + SMOOTHING), np.nan)
            places = np.arange(self.n_words, last, dtype=np.int32)
            self.words.insert(hashes[first], check[first], places)
            place[new] = places[back]
            self.n_words = last
        return place

    def counted(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of pairs (numbers) as the filter has them."""
        out = np.zeros(len(first))
        pair = np.flatnonzero((first >= 0) & (second >= 0))
        asked, where = np.unique(first[pair] << 32 | second[pair], return_inverse=True)
        out[pair] = self.value[self.filter.levels(pair_item(asked), self.pairs.least)][where]
        return out

    def after(self, first: np.ndarray, second: np.ndarray, back: np.ndarray, counted: np.ndarray | None = None) -> np.ndarray:
        """log10 of words ``second`` after ``first`` (numbers), given that of the back-off. For a word that is not frequent,
        ``back`` may lack a factor: it then stays to be multiplied."""
        held = np.flatnonzero(first >= 0)
        at = first[held]
        counted = (self.counted(first, second) if counted is None else counted)[held]
        total = self.pairs.total[at]
        rest = total - self.pairs.kept[at]
        out = back.copy()
        out[held] = np.log10((counted + rest * 10.0 ** back[held]) / total)
        return out


_scorers: dict[str, WordScorer] = {}


def _scorer(name: str, make) -> WordScorer:
    """One scorer per model and Python worker."""
    if name not in _scorers:
        _scorers.clear()
        _scorers[name] = make()
    return _scorers[name]


def neighbours(own: np.ndarray, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of every place's word before and own word; words come first, then the texts' ends. 0 is the boundary."""
    first = np.concatenate([previous_classes(own, piece.word_at), last_classes(own, piece.word_at)])
    return first, np.concatenate([own, np.zeros(piece.texts, np.int64)])


def pack(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers as bytes, ``ascending`` ones by their steps. Bytes of one weight lie together, so that small numbers take little room."""
    numbers = np.diff(numbers.astype(np.int64), prepend=0) if ascending else numbers.astype(np.int64)
    return pa.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int, ascending: bool = False) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    numbers = np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).ravel()
    return np.cumsum(numbers) if ascending else numbers


def _dealt(by: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts places into their buckets, each by ascending ``by``, and where each bucket begins in it."""
    order = np.argsort(by)
    bucket = (mix(by[order].view(np.uint64)) % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    again = np.argsort(bucket, kind="stable")
    return order[again], np.searchsorted(bucket[again], np.arange(buckets + 1))


def _groups(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


#: Rows of packed pair counts: pairs of frequent words, pairs with a frequent word before a rare one, class pairs, per number of
#: a word before what the quantised counts after it sum to, and how many pairs have which step of count (as in most_frequent).
PAIRS, RARE_AFTER, CLASS_PAIRS, KEPT, STEPS = range(5)
TABLE = "bucket int, kind int, n int, a binary, b binary"


def packed_pairs(docs: DataFrame, head: np.ndarray, own: np.ndarray, buckets: int) -> DataFrame:
    """Counts of neighbours, packed in rows of ``TABLE``: all pairs of frequent words and all class pairs with their counts, and sums
    over all pairs with a frequent word before. ``own`` has the class of each number of a word, the shared one last.

    Equal pairs are folded by the task that meets them and again in their bucket; a bucket holds about as many at any size of input.
    """
    python_ready(docs.sparkSession)
    room = 63 - len(head).bit_length()  # bits for a rare word's hash beside a frequent word's number
    value = level_values()

    def rows(kind: int, keys: np.ndarray, n: np.ndarray | None = None) -> Iterator[tuple]:
        order, at = _dealt(keys, buckets)
        keys = keys[order]
        first = _groups(keys)
        n = np.diff(first, append=len(keys)) if n is None else n[order]
        at, keys = np.searchsorted(first, at), keys[first]
        for k in np.flatnonzero(np.diff(at)):
            here = slice(at[k], at[k + 1])
            yield int(k), kind, int(at[k + 1] - at[k]), pack(keys[here], True), pack(n[here])

    def batch_of(some: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        if some := list(some):
            types = pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*some), types)], names=["bucket", "kind", "n", "a", "b"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, classes = {PAIRS: [], RARE_AFTER: []}, 0, np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0), lower=True, size=1 << 20):
                hashes = np.maximum(piece.word_hashes(), np.uint64(1))
                number = head_numbers(hashes, head)
                first, second = neighbours(number, piece)
                hashes = np.concatenate([hashes, np.zeros(piece.texts, np.uint64)])
                classes += np.bincount(own[first] * CLASSES + own[second], minlength=CLASSES * CLASSES)
                both, after = (first >= 0) & (second >= 0), (first >= 0) & (second < 0)
                parts[PAIRS].append(first[both] << 32 | second[both])
                parts[RARE_AFTER].append(first[after] << room | (hashes[after] & np.uint64((1 << room) - 1)).view(np.int64))
                held += len(first)
                if held > FOLD_PLACES:
                    for kind in parts:
                        yield from batch_of(rows(kind, np.concatenate(parts[kind])))
                    parts, held = {PAIRS: [], RARE_AFTER: []}, 0
        for kind in parts:
            if parts[kind]:
                yield from batch_of(rows(kind, np.concatenate(parts[kind])))
        seen = np.flatnonzero(classes)
        yield from batch_of(rows(CLASS_PAIRS, seen, classes[seen]))

    def folded(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        kept, out = np.zeros(len(head) + 1), []
        for kind, part in some.groupby("kind"):
            keys, n = _folded([(unpack(a, k, True), unpack(b, k)) for k, a, b in zip(part["n"], part["a"], part["b"])])
            if kind != RARE_AFTER:
                out.append((key[0], kind, len(keys), pack(keys, True), pack(n)))
            if kind != CLASS_PAIRS:
                kept += np.bincount(keys >> (32 if kind == PAIRS else room), value[level(n)], minlength=len(kept))
            if kind == PAIRS:
                steps, times = np.unique(_steps(n), return_counts=True)
                out.append((key[0], STEPS, len(steps), pack(steps), pack(times)))
        for k in range(0, len(kept), KEPT_NUMBERS):
            part = kept[k : k + KEPT_NUMBERS]
            out.append((k // KEPT_NUMBERS, KEPT, len(part), b"", pack(part.view(np.int64))))
        return pd.DataFrame(out, columns=["bucket", "kind", "n", "a", "b"])

    return docs.select("text").mapInArrow(count, TABLE).groupBy("bucket").applyInPandas(folded, TABLE)


def _steps(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) * 64).astype(np.int64)


def unpacked(table: DataFrame, kind: int, least: int = 0) -> DataFrame:
    """(pair, c) of packed pair counts, from the step ``least`` on."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, a, b in zip(*(x.to_pylist() for x in batch.columns)):
                keys, c = unpack(a, n, True), unpack(b, n)
                there = _steps(c) >= least
                yield pa.RecordBatch.from_arrays([pa.array(keys[there]), pa.array(c[there])], names=["pair", "c"])

    return table.filter(F.col("kind") == kind).select("n", "a", "b").mapInArrow(spread, "pair long, c long")


def kept_after(table: DataFrame, words: int) -> np.ndarray:
    """Per number of a word before, the sum of the quantised counts of all its pairs."""

    def summed(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        kept = np.sum([unpack(b, n).view(np.float64) for n, b in zip(some["n"], some["b"])], axis=0)
        return pd.DataFrame({"bucket": [key[0]], "n": [len(kept)], "b": [pack(kept.view(np.int64))]})

    out = np.zeros(words + 1)
    # as many numbers as frequent words at most
    for row in table.filter(F.col("kind") == KEPT).groupBy("bucket").applyInPandas(summed, "bucket int, n int, b binary").collect():
        at = row["bucket"] * KEPT_NUMBERS
        out[at : at + row["n"]] = unpack(bytes(row["b"]), row["n"]).view(np.float64)
    return out


def frequent_pairs(table: DataFrame, limit: int) -> DataFrame:
    """(pair, c): the most frequent pairs of frequent words, at most ``limit``, as :func:`most_frequent` takes them."""
    steps = Counter()
    for row in table.filter(F.col("kind") == STEPS).select("n", "a", "b").toLocalIterator():  # some hundred numbers a bucket
        steps.update(dict(zip(unpack(bytes(row["a"]), row["n"]).tolist(), unpack(bytes(row["b"]), row["n"]).tolist())))
    least = least_step(steps.items(), limit)
    return unpacked(table.limit(0) if least is None else table, PAIRS, least or 0)


#: Rows of packed places: of two frequent words; of a rare word after a frequent one; of any word after a rare one; and, beside
#: them, rare words with their count and its level. Places lie in the bucket of their pair, second word or first word.
BOTH, SECOND, FIRST, WORDS = range(4)
LOGS = "__base long, n int, at binary, log binary, base binary, known binary, __row long, second long, plain double, share double"
PLACES = "__bucket int, __kind int, __base long, __n int, __a binary, __b binary, __at binary"


class OpenPlaces:
    """Open places of texts in a row, until they are given away as rows of ``PLACES``. A place has the row of its text."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.forget()

    def forget(self) -> None:
        self.parts = {k: [] for k in (BOTH, SECOND, FIRST)}
        self.base, self.held = None, 0

    def add(self, first: np.ndarray, second: np.ndarray, row: np.ndarray, held_out: np.ndarray) -> None:
        """Places by their keys in pairs."""
        self.base = int(row[0]) if self.base is None and len(row) else self.base
        at = (row - (self.base or 0)) << 1 | held_out
        for kind, here, by, other in (
            (BOTH, (first >= 0) & (second >= 0), first << 32 | second, None),
            (SECOND, (first >= 0) & (second < 0), second, first),
            (FIRST, first < 0, first, second),
        ):
            here = np.flatnonzero(here)
            self.parts[kind].append((by[here], at[here], None if other is None else other[here]))
        self.held += len(first)

    def rows(self) -> Iterator[tuple]:
        for kind, parts in self.parts.items():
            if not any(len(x[0]) for x in parts):
                continue
            by, at = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
            other = None if kind == BOTH else np.concatenate([x[2] for x in parts])
            yield from placed(kind, self.base, self.buckets, by, other, at)
        self.forget()


def placed(kind: int, base: int, buckets: int, by: np.ndarray, other: np.ndarray | None, at: np.ndarray | None) -> Iterator[tuple]:
    """Rows of ``PLACES``, one per bucket."""
    order, begin = _dealt(by, buckets)
    by, other, at = (None if x is None else x[order] for x in (by, other, at))
    for k in np.flatnonzero(np.diff(begin)):
        here = slice(begin[k], begin[k + 1])
        yield (
            int(k), kind, base, int(begin[k + 1] - begin[k]), pack(by[here], True),
            b"" if other is None else pack(other[here]), b"" if at is None else pack(at[here]),
        )


def _columns(rows: list[tuple]) -> list[pa.Array]:
    types = pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()
    return [pa.array(x, t) for x, t in zip(zip(*rows), types)]


def packed_words(words: DataFrame, buckets: int) -> DataFrame:
    """(second, c, q) as rows of ``PLACES``."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, names = [], ["__bucket", "__kind", "__base", "__n", "__a", "__b", "__at"]

        def give() -> Iterator[pa.RecordBatch]:
            key, c, q = (np.concatenate(x) for x in zip(*held))
            yield pa.RecordBatch.from_arrays(_columns(list(placed(WORDS, 0, buckets, key, c << 8 | q, None))), names=names)

        for batch in batches:
            if batch.num_rows:
                held.append(tuple(x.to_numpy().astype(np.int64) for x in batch.columns))
            if sum(len(x[0]) for x in held) > OPEN_PLACES:
                yield from give()
                held = []
        if held:
            yield from give()

    return words.select("second", "c", "q").mapInArrow(packed, PLACES)


def _of_kind(rows: pd.DataFrame, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The places of a bucket by ascending keys: both keys, the row of the text, and whether it is learned from."""
    rows = rows[rows["__kind"] == kind]
    if not len(rows):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
    a = np.concatenate([unpack(x, n, True) for x, n in zip(rows["__a"], rows["__n"])])
    at = np.concatenate([unpack(x, n) for x, n in zip(rows["__at"], rows["__n"])])
    row = np.repeat(rows["__base"].to_numpy(), rows["__n"].to_numpy()) + (at >> 1)
    if kind == BOTH:
        order = np.argsort(a)
        b = a & np.int64(0xFFFFFFFF)
    else:
        b = np.concatenate([unpack(x, n) for x, n in zip(rows["__b"], rows["__n"])])
        order = np.lexsort((b, a))
    return a[order], b[order], row[order], (at[order] & 1) == 0


def _counts(learned: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(learned.astype(np.int64), first) if len(first) else first


def place_logs(rows: pd.DataFrame, scorer: WordScorer, learn: bool) -> pd.DataFrame:
    """Rows of ``LOGS`` from a bucket's places: per text, packed, the sums of their log10 and of what rare second words add to the plain
    score and to n_known; and for each place of two rare words what its probability has besides its second word's count: plain +
    share * (the word's part of its class)."""
    scorer._forget()  # the words that it has seen are no longer asked for
    own, word_log = scorer.numbered()
    value, total, kept = scorer.value, scorer.pairs.total, scorer.pairs.kept
    amount = lambda c: np.where(c > 0, value[level(c)], 0.0) if learn else np.zeros(len(c))
    found = []

    pair, second, row, learned = _of_kind(rows, BOTH)
    at = _groups(pair)
    first, second = pair[at] >> 32, second[at]
    back = scorer.pair_log[own[first], own[second]] + word_log[second]
    log = np.log10((amount(_counts(learned, at)) + (total[first] - kept[first]) * 10.0**back) / total[first])
    zeros = np.zeros(len(row))
    found.append((row, np.repeat(log, np.diff(at, append=len(pair))), zeros, zeros))

    second, first, row, learned = _of_kind(rows, SECOND)
    if len(second):
        at = _groups(second, first)
        words = rows[rows["__kind"] == WORDS]
        key = np.concatenate([unpack(x, n, True) for x, n in zip(words["__a"], words["__n"])])
        told = np.concatenate([unpack(x, n) for x, n in zip(words["__b"], words["__n"])])
        order = np.argsort(key, kind="stable")
        by_level = shared_class_log(value, scorer.rare, scorer.unseen)
        pairs = np.diff(at, append=len(second))
        c, second, first = _counts(learned, at), second[at], first[at]
        told = told[order][np.searchsorted(key[order], second)]
        back = scorer.pair_log[own[first], SHARED] + by_level[told & 255]
        log = np.log10((amount(c) + (total[first] - kept[first]) * 10.0**back) / total[first])
        of_word = told >> 8
        found.append((row, *(np.repeat(x, pairs) for x in (log, np.log10(of_word + SMOOTHING), (of_word > 0).astype(float)))))

    first, second, row, learned = _of_kind(rows, FIRST)
    at = _groups(first, second)
    pairs = np.diff(at, append=len(first))
    c = _counts(learned, at) if learn else np.zeros(len(at), np.int64)
    word = _groups(first[at])
    words = np.diff(word, append=len(at))
    held = np.add.reduceat(amount(c), word) if len(word) else np.zeros(0)
    every = np.maximum(held, np.add.reduceat(c, word) if len(word) else held) + BACK_OFF
    plain, share = amount(c) / np.repeat(every, words), np.repeat(1 - held / every, words)
    second = second[at]
    known = second >= 0
    after = np.maximum(second, 0)
    share = share * 10.0 ** np.where(known, scorer.pair_log[SHARED, own[after]] + word_log[after], scorer.pair_log[SHARED, SHARED])
    there = np.repeat(known, pairs)
    zeros = np.zeros(np.count_nonzero(there))
    found.append((row[there], np.repeat(np.log10(plain + share)[known], pairs[known]), zeros, zeros))

    row_of, *sums = (np.concatenate(x) for x in zip(*found))
    texts, back = np.unique(row_of, return_inverse=True)
    log, base, seen = (np.bincount(back, x, minlength=len(texts)).astype(np.float64) for x in sums)
    bases = np.unique(rows["__base"][rows["__kind"] != WORDS])
    begin = np.append(np.searchsorted(texts, bases), len(texts))
    done = []
    for k in np.flatnonzero(np.diff(begin)):
        here = slice(begin[k], begin[k + 1])
        numbers = (x[here].view(np.int64) for x in (log, base))
        done.append((bases[k], len(texts[here]), pack(texts[here] - bases[k], True), *map(pack, numbers), pack(np.rint(seen[here]))))
    done = pd.DataFrame(done, columns=["__base", "n", "at", "log", "base", "known"]).astype({"__base": "Int64", "n": "Int32"})
    spread = lambda x: np.repeat(x, pairs)[~there]
    left = pd.DataFrame({"__row": row[~there], "second": spread(second), "plain": spread(plain), "share": spread(share)})
    return pd.concat([done, left.astype({"__row": "Int64", "second": "Int64"})])[[x.split()[0] for x in LOGS.split(", ")]]


def text_sums(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
    """(__row, log, base, known) of the texts whose places were given away together, from the sums that their buckets made."""
    at = np.concatenate([unpack(x, n, True) for x, n in zip(some["at"], some["n"])])
    log, base = (np.concatenate([unpack(x, n) for x, n in zip(some[c], some["n"])]).view(np.float64) for c in ("log", "base"))
    known = np.concatenate([unpack(x, n) for x, n in zip(some["known"], some["n"])])
    texts, back = np.unique(at, return_inverse=True)
    sums = {name: np.bincount(back, x, minlength=len(texts)) for name, x in (("log", log), ("base", base), ("known", known))}
    return pd.DataFrame({"__row": key[0] + texts} | sums).astype({"known": np.int64})


def score(docs: DataFrame, head_words: int = HEAD_WORDS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the words and one end per document. base_score sums log10 of add-0.1
    smoothed exact relative counts, score is the log10 probability under the model;
    both learn from the documents that are not held out. A null text is an empty one: just the
    end. Documents without id are training documents; repeated rows count and are scored
    each. An empty table gives an empty result. Columns named as the results are replaced.
    """
    docs = without(docs, OUTPUT)
    spark = docs.sparkSession
    python_ready(spark)
    flagged = docs.withColumn("held_out", held_out())
    training = flagged.filter(~F.col("held_out"))
    all_counts = cut_lineage(word_counts(flagged))
    counts = all_counts.filter("c > 0")
    ends = training.count()
    # at most ``head_words`` rows
    top = most_frequent(counts, max(head_words, CLASSES - 2)).toPandas().sort_values(["c", "word"], ascending=[False, True], ignore_index=True)
    keys = span_hashes(*_joined(pa.array(top["word"].map(bytes), pa.binary()))) if len(top) else np.zeros(0, np.uint64)
    known = np.sort(keys[: CLASSES - 2])
    words, types, once = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("c") == 1, 1)), F.lit(0))).first()
    tokens, distinct = words + ends, types + (ends > 0)
    rare_tokens = words - int(top["c"][: CLASSES - 2].sum())
    once = min(once, rare_tokens)
    buckets = max(1, math.ceil(tokens / BUCKET_WORDS))
    order = np.argsort(keys)
    head_keys, head_counts = keys[order], top["c"].to_numpy(np.float64)[order]
    own_class = np.concatenate([[BOUNDARY], classes_of(head_keys, known), [SHARED]])
    table = cut_lineage(packed_pairs(training, head_keys, own_class, buckets))
    pairs = cut_lineage(unpacked(table, CLASS_PAIRS))
    learn = HEAD_PAIRS > 0
    kept_pairs = cut_lineage(frequent_pairs(table, HEAD_PAIRS))
    before = np.append(float(ends), head_counts)
    model = pair_model(kept_pairs, before)
    kept = kept_after(table, len(head_keys)) if learn else np.zeros(len(before))
    model = model._replace(kept=kept, total=np.maximum(before, kept) + BACK_OFF)
    # at most ``head_words`` rows, HEAD_PAIRS word pairs and (CLASSES + 1) * CLASSES class items
    head = F.broadcast(spark.createDataFrame([(bytes(w),) for w in top["word"]], "word binary"))
    frequent = word_items(counts.join(head, "word", "left_semi")).drop("word")
    bits = build_filter(cut_lineage(leveled(frequent.unionByName(class_items(pairs)).unionByName(pair_items(kept_pairs)))))
    tail = cut_lineage(rare_items(all_counts.join(head, "word", "left_anti")))
    tail_bits, tail_segments = filter_table(cut_lineage(leveled(tail.filter("c > 0"))))
    found = cut_lineage(probe(tail, cut_lineage(tail_bits), tail_segments).drop("item"))
    shared = spark.sparkContext.broadcast((bits.bits, bits.segments, head_keys, head_counts, known, tuple(model)))
    name = uuid.uuid4().hex

    keep = list(keep or docs.columns)
    results = "n_tokens long, __head_sum double, __head_known long, score double, __row long"

    def make() -> WordScorer:
        filter_bits, segments, frequent_keys, frequent_counts, known_words, pairs_of = shared.value
        return WordScorer(Filter(filter_bits, segments), (frequent_keys, frequent_counts), known_words, rare_tokens, once, PairModel(*pairs_of))

    def work(scorer: WordScorer, piece: Piece, row: np.ndarray, held: np.ndarray, places: OpenPlaces) -> list:
        place = scorer.places(piece)
        text = piece.text_of_word()
        head, own, number = scorer.head_log[place], scorer.own[place], scorer.number[place]
        rare = np.isnan(head)
        first, second = neighbours(number, piece)
        counted = scorer.counted(first, second)
        # what is not in the filter is told to its bucket
        closed, open_ = np.flatnonzero(counted), np.flatnonzero(counted == 0)
        before, after = neighbours(own, piece)
        back = scorer.pair_log[before[closed], after[closed]] + np.append(scorer.log_p[place], np.zeros(piece.texts))[closed]
        log_p = scorer.after(first[closed], second[closed], back, counted[closed])
        texts = np.concatenate([text, np.arange(piece.texts)])
        key_first, key_second = neighbours(word_keys(np.maximum(piece.word_hashes(), np.uint64(1)), number), piece)
        places.add(key_first[open_], key_second[open_], row[texts[open_]], held[texts[open_]])
        per_text = lambda of, w: np.bincount(of, w, minlength=piece.texts).astype(np.float64)
        return [
            piece.n_words + 1, per_text(text, np.where(rare, 0.0, head)), per_text(text, ~rare).astype(np.int64),
            per_text(texts[closed], log_p), row,
        ]

    source = flagged.select(F.col("text").alias("__text"), *[F.col(f"`{c}`") for c in [*keep, "held_out"]])
    schema = StructType([
        *(StructField(f.name, f.dataType) for f in source.schema.fields[1:]), *_parse_datatype_string(f"{results}, {PLACES}").fields
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.default_memory_pool().release_unused()
        scorer, row, places = _scorer(name, make), TaskContext.get().partitionId() << 33, OpenPlaces(buckets)
        types, of_text = [], []

        def give() -> Iterator[pa.RecordBatch]:
            if rows := list(places.rows()):
                columns = _columns(rows)
                yield pa.RecordBatch.from_arrays([*(pa.nulls(len(rows), t) for t in of_text), *columns], names=schema.names)

        for batch in batches:
            types = [batch.schema.field(k).type for k in range(1, batch.num_columns)]
            for piece in pieces(batch.column(0), lower=True):
                texts = batch.slice(piece.first, piece.texts)
                held = texts.columns[-1].to_numpy(zero_copy_only=False).astype(np.int64)
                found = [pa.array(x) for x in work(scorer, piece, row + np.arange(piece.texts), held, places)]
                row += piece.texts
                of_text = [*types, *(x.type for x in found)]
                none = [pa.nulls(piece.texts, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())]
                yield pa.RecordBatch.from_arrays([*texts.columns[1:], *found, *none], names=schema.names)
                if places.held > OPEN_PLACES:
                    yield from give()
        yield from give()

    def logs_of(rows: pd.DataFrame) -> pd.DataFrame:
        return place_logs(rows, _scorer(name, make), learn)

    stored = cut_lineage(source.mapInArrow(run, schema))
    scored = stored.filter("__bucket IS NULL").drop(*(x.split()[0] for x in PLACES.split(", ")))
    places = stored.filter("__bucket IS NOT NULL").select(*(x.split()[0] for x in PLACES.split(", ")))
    by_level = shared_class_log(level_values(), max(1, rare_tokens), unseen_share(rare_tokens, once))
    log_p = F.element_at(F.array(*[F.lit(float(x)) for x in by_level]), F.col("q") + 1)
    opened = cut_lineage(places.unionByName(packed_words(found, buckets)).groupBy("__bucket").applyInPandas(logs_of, LOGS))
    words_of = found.groupBy("second").agg(F.first("q").alias("q"), F.first("c").alias("c"))
    two_rare = opened.filter("second IS NOT NULL").select("__row", "second", "plain", "share").join(words_of, "second").select(
        "__row", F.log10(F.col("plain") + F.col("share") * F.pow(F.lit(10.0), log_p)).alias("log"),
        F.log10(F.col("c") + SMOOTHING).alias("base"), (F.col("c") > 0).cast("long").alias("known"),
    )
    of_buckets = opened.filter("second IS NULL").select("__base", "n", "at", "log", "base", "known").groupBy("__base").applyInPandas(
        text_sums, "__row long, log double, base double, known long"
    )
    sums = of_buckets.unionByName(two_rare).groupBy("__row").agg(
        F.sum("log").alias("__pair_log"), F.sum("base").alias("__rare_sum"), F.sum("known").alias("__rare_known")
    )
    total = math.log10(tokens + SMOOTHING * (distinct + 1))
    base = F.col("__head_sum") + F.coalesce("__rare_sum", F.lit(0.0)) + math.log10(ends + SMOOTHING) - F.col("n_tokens") * total
    known = F.col("__head_known") + F.coalesce("__rare_known", F.lit(0)) + int(ends > 0)
    return scored.join(sums, "__row", "left").select(
        *[F.col(f"`{x}`") for x in keep], "held_out", "n_tokens", known.cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + F.coalesce("__pair_log", F.lit(0.0))).alias("score"),
    )
