"""Words of many texts at once, as 64-bit hashes in numpy.

A batch of texts is one byte array. Word limits are found by looking at bytes
(only ASCII white space parts words, and no byte of a longer UTF-8 character looks
like it), and all words are hashed together. Texts are taken in pieces of about
``PIECE`` bytes, so memory is bounded by a piece or by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 19
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)
#: Low bytes of a word of eight to keep, by their number.
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
LONG = 256


def powers(n: int) -> np.ndarray:
    """1, b, b^2, ... modulo 2^64, at least ``n`` of them."""
    global _powers
    if len(_powers) < n:
        out = np.full(max(n, 2 * len(_powers), 4096), _BASE, np.uint64)
        out[0] = 1
        _powers = np.multiply.accumulate(out)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a 64-bit value over all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def join_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a pair, in order."""
    return mix(a * np.uint64(0x9DDFEA08EB382D69) + (b ^ (b >> np.uint64(29))))


@dataclass
class Piece:
    """Texts ``first``.. of a batch: their bytes, and where texts and words lie in them."""

    first: int
    data: np.ndarray
    text_at: np.ndarray  # texts + 1 offsets into data
    word_start: np.ndarray
    word_end: np.ndarray
    word_at: np.ndarray  # texts + 1 offsets into words
    is_word: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.text_at) - 1

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_at)

    def word_hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.word_start, self.word_end)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.texts), self.n_words)


def _eights(data: np.ndarray) -> np.ndarray:
    """At each byte, the eight bytes from it on."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def first_eight(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span as one number."""
    return _eights(data)[start] & _KEEP[np.minimum(end - start, 8)]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, long: int = LONG) -> np.ndarray:
    """Hashes of byte spans that are in order and don't overlap.

    Spans up to ``long`` bytes are taken eight bytes at a time; longer ones, which
    are rare, by a polynomial over their bytes.
    """
    size = end - start
    out = size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    if not len(start):
        return out
    eight = _eights(data)
    short = size <= long
    alive = np.flatnonzero(short & (size > 0))
    k = 0
    while len(alive):
        left = size[alive] - k
        block = eight[start[alive] + k] & _KEEP[np.minimum(left, 8)]
        h = (out[alive] ^ block) * np.uint64(0x9DDFEA08EB382D69)
        out[alive] = h ^ (h >> np.uint64(32))
        k += 8
        alive = alive[left > 8]
    if not short.all():
        rest = np.flatnonzero(~short)
        out[rest] += _polynomial(data, start[rest], end[rest])
    return mix(out)


def _polynomial(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    size = end - start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    inside = np.arange(at[-1]) - np.repeat(at[:-1], size)
    value = (data[np.repeat(start, size) + inside].astype(np.uint64) + np.uint64(1)) * powers(int(size.max()) + 1)[inside]
    return np.add.reduceat(value, at[:-1])


def pieces(texts: pa.Array, lower: bool = False, size: int = PIECE) -> Iterator[Piece]:
    """Texts (nulls count as empty) of an Arrow string column in pieces."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    everything = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        data = everything[at[first] : at[last]]
        yield _piece(first, LOWER[data] if lower else data, at[first : last + 1] - at[first])
        first = last


def _piece(first: int, data: np.ndarray, text_at: np.ndarray) -> Piece:
    word = ~_SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[text_at] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | begins[1:-1]
    end = word.copy()
    end[:-1] &= ~word[1:] | begins[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Piece(first, data, text_at, starts, ends, np.searchsorted(starts, text_at), word)


def ngrams(hashes: np.ndarray, word_at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every n-word window that lies within one text, in order."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = hashes[: len(hashes) - n + 1]
    for k in range(1, n):
        out = join_hashes(out, hashes[k : len(hashes) - n + 1 + k])
    text = np.repeat(np.arange(len(word_at) - 1), np.diff(word_at))
    inside = text[: len(out)] == text[n - 1 :]
    return out[inside], text[: len(out)][inside]


def span_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte spans as an Arrow binary column."""
    size = end - start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    inside = np.arange(at[-1]) - np.repeat(at[:-1], size)
    body = data[np.repeat(start, size) + inside]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(body)])


class Places:
    """A hash table of numpy arrays from (key, check) to a number; key and check are 64 bits, key not 0."""

    def __init__(self, slots: int):
        self.slots = slots
        self.key, self.check = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.at = np.zeros(slots, np.int32)
        self.kept = 0

    def find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """The numbers, -1 for those not held."""
        place = np.full(len(key), -1, np.int32)
        left, step = np.arange(len(key)), 0
        while len(left):
            slot = ((key[left] + np.uint64(step)) & np.uint64(self.slots - 1)).astype(np.int64)
            there = self.key[slot]
            hit = (there == key[left]) & (self.check[slot] == check[left])
            place[left[hit]] = self.at[slot[hit]]
            left = left[~hit & (there != 0)]
            step += 1
        return place

    def insert(self, key: np.ndarray, check: np.ndarray, place: np.ndarray) -> None:
        """Hold distinct new ones, with distinct numbers."""
        left, step = np.arange(len(key)), 0
        self.kept += len(key)
        while len(left):
            slot = ((key[left] + np.uint64(step)) & np.uint64(self.slots - 1)).astype(np.int64)
            free = np.flatnonzero(self.key[slot] == 0)
            slot, taking = slot[free], left[free]
            self.at[slot] = place[taking]  # the last of those that want a slot gets it
            mine = self.at[slot] == place[taking]
            won = taking[mine]
            self.key[slot[mine]], self.check[slot[mine]] = key[won], check[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            step += 1
