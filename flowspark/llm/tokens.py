"""Whole texts to token ids with a word-level BPE file, remembering what words become.

The file's normaliser and splitter never look across ASCII white space, so the ids
of a text are those of its chunks one after the other; tests hold this against
encoding whole texts. A chunk of ASCII and Latin letters and ASCII marks, which is
what nearly all chunks are, parts into runs of letters and runs of marks, which the
BPE model takes as they are; all other chunks go through the whole tokenizer.

A worker keeps the runs and chunks it has seen in a hash table of numpy arrays, up to
a bound, after which it starts anew; looking up a batch is then a few array
operations. One counts as seen where its 64-bit hash, its first eight bytes and its
length agree.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from flowspark.llm.hashing import LOWER, Piece, Places, first_eight, mix, pieces, span_hashes

MAX_KEPT = 600_000
SLOTS = 1 << 21
LONGEST_KEPT = 64
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = True
# bytes that send a chunk to the tokenizer: digits, apostrophe, control characters, and
# everything beyond the two-byte characters U+00C0 to U+017F
_ODD = np.zeros(256, bool)
_ODD[[*range(0x30, 0x3A), 0x27, *range(0x20), 0x7F, 0xC0, 0xC1, 0xC2, *range(0xC6, 0x100)]] = True
# pairs of bytes that do so: multiplication and division signs, dotted I, n with apostrophe, and
# the opening of a special token
_ODD_PAIRS = ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0), (0xC5, 0x89), (0x3C, 0x7C))

# byte-level BPE writes a byte as the character of its number where that can be seen, and else
# as the next free character from 256 on
_HIDDEN = [*range(33), *range(127, 161), 173]
_BYTE_CHARS = {byte: 256 + n for n, byte in enumerate(_HIDDEN)}


class ChunkEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.places = Places(SLOTS)
        self.ids = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = self.count = 0

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def run_ids(self, run: str) -> list[int]:
        """Ids of a run of letters or of marks."""
        run = run.lower()
        if not run.isascii():
            run = run.encode("utf-8").decode("latin-1").translate(_BYTE_CHARS)
        return [t.id for t in self.model.tokenize(run)]

    def _add(self, found: list[list[int]]) -> int:
        """Keep the ids; the place of the first, the others follow."""
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.count + len(found) > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        first, last = self.count, self.count + len(found)
        self.ids[self.used : self.used + len(flat)] = flat
        self.size[first:last] = sizes
        self.start[first:last] = self.used + np.cumsum(sizes) - sizes
        self.used, self.count = self.used + len(flat), last
        return first

    def _runs(self, piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, whether the tokenizer must take it) of what the ids of a piece are made of."""
        data, start, end = piece.data, piece.word_start, piece.word_end
        odd = _ODD[data]
        for a, b in _ODD_PAIRS:
            odd[:-1] |= (data[:-1] == a) & (data[1:] == b)
        upto = np.zeros(len(data) + 1, np.int64)
        np.cumsum(odd & piece.is_word, out=upto[1:])
        odd_word = upto[end] > upto[start]
        mark = _MARK[data]
        change = np.flatnonzero(piece.is_word[1:] & piece.is_word[:-1] & (mark[1:] != mark[:-1])) + 1
        change = change[~odd_word[np.searchsorted(start, change, "right") - 1]]
        first = np.sort(np.concatenate([start, change]))
        word = np.searchsorted(start, first, "right") - 1
        last = np.minimum(np.append(first[1:], len(data)), end[word]) if len(first) else first
        return first, last, odd_word[word]

    def _places(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """(places of the runs of a piece, number of runs before each text)."""
        if self.places.kept > MAX_KEPT or self.count > 2 * MAX_KEPT:
            self._forget()
        start, end, odd = self._runs(piece)
        lowered = LOWER[piece.data]
        key, check = span_hashes(lowered, start, end), first_eight(lowered, start, end)
        if odd.any():
            key[odd] = ~span_hashes(piece.data, start[odd], end[odd])
            check[odd] = first_eight(piece.data, start[odd], end[odd])
        key = np.maximum(key, np.uint64(1))
        check += (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        place = self.places.find(key, check)
        new = np.flatnonzero(place < 0)
        if len(new):
            _, first, back = np.unique(mix(key[new] ^ mix(check[new])), return_index=True, return_inverse=True)
            first = new[first]
            data = piece.data.tobytes()
            found = []
            for a, b, whole in zip(start[first].tolist(), end[first].tolist(), odd[first].tolist()):
                text = data[a:b].decode("utf-8", "replace")
                found.append(self.whole(text) if whole else self.run_ids(text))
            places = self._add(found) + np.arange(len(first), dtype=np.int32)
            place[new] = places[back.ravel()]
            keep = end[first] - start[first] <= LONGEST_KEPT
            self.places.insert(key[first][keep], check[first][keep], places[keep])
        return place, np.searchsorted(start, piece.text_at)

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text); nulls count as empty."""
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for piece in pieces(texts):
            place, text_at = self._places(piece)
            size = self.size[place]
            ends = np.zeros(len(place) + 1, np.int64)
            np.cumsum(size, out=ends[1:])
            ids.append(self.ids[np.repeat(self.start[place] - ends[:-1], size) + np.arange(ends[-1])])
            sizes.append(np.diff(ends[text_at]))
        return np.concatenate(ids), np.concatenate(sizes)


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder for each file and Python worker."""
    return ChunkEncoder(path)
