"""Quality rules with line labels: a linear-chain CRF marks content and boilerplate.

Lines with a word are the elements of a document's chain. The model is log-linear in
a few shares and lengths of a line, with weights for neighbouring labels; it is fitted
here on a bounded sample of labelled documents (lines of good ones count as content,
lines of bad ones as boilerplate). Viterbi decoding labels the lines of every
document, and the share of words in content lines decides, after plain rules on the
whole text.

Counting and decoding are array operations over pieces of a batch; a long text is a
longer chain, nothing is cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowspark.llm.hashing import Piece, join_hashes, ngrams, span_hashes
from flowspark.llm.texts import map_texts

CONTENT, BOILERPLATE = 0, 1
#: Labelled documents of each kind, and lines of each, that the model is fitted on.
TRAIN_DOCS, TRAIN_LINES = 1000, 40
MIN_WORDS, MIN_CONTENT = 50, 0.5
_RESULTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_words long, base_failed boolean, kept boolean"
)
OUTPUT = [x.split()[0] for x in _RESULTS.split(", ")]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_FINAL = np.zeros(256, bool)
_FINAL[list(b".?")] = True
FEATURES = [
    "bias", "upper_share", "symbols_per_word", "marks_per_word", "length", "repeated_line", "repeated_words",
    "word_length", "short", "ends_as_sentence", "digit_share",
]


@dataclass
class Model:
    """Weights of features by label, of label pairs, and of the first label."""

    weight: np.ndarray
    pair: np.ndarray
    first: np.ndarray


@dataclass
class Lines:
    """Lines with a word of a piece: their text, words, features, and per-word repeats."""

    text_at: np.ndarray  # texts + 1 offsets into lines
    words: np.ndarray
    features: np.ndarray
    repeated: np.ndarray  # whether the line equals an earlier one of its text
    in_repeat: np.ndarray  # per word: in a three-word window found twice or more in its text


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def repeated_words(piece: Piece) -> np.ndarray:
    """Per word whether it lies in a three-word window that its text holds twice or more."""
    grams, text = ngrams(piece.word_hashes(), piece.word_at, 3)
    out = np.zeros(len(piece.word_start), bool)
    if len(grams):
        own = join_hashes(grams, text.astype(np.uint64))
        order = np.argsort(own)
        sorted_ = own[order]
        same = np.zeros(len(own), bool)
        twin = sorted_[1:] == sorted_[:-1]
        same[order[1:][twin]] = True
        same[order[:-1][twin]] = True
        window = np.flatnonzero(same)
        first = piece.word_at[text[window]] + (window - np.searchsorted(text, text[window]))
        for k in range(3):
            out[first + k] = True
    return out


def lines_of(piece: Piece) -> Lines:
    data = piece.data
    text = piece.text_of_word()
    breaks = np.flatnonzero(data == 10)
    at = np.searchsorted(breaks, piece.word_start)
    new = np.ones(len(text), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    words = np.diff(np.append(first, len(text)))
    of = text[first]
    k = at[first]
    # a line runs from the line break before its first word to the next one, within its text
    before = np.where(k > 0, breaks[np.maximum(k - 1, 0)] + 1 if len(breaks) else 0, 0)
    after = np.where(k < len(breaks), breaks[np.minimum(k, len(breaks) - 1)] if len(breaks) else len(data), len(data))
    start, end = np.maximum(before, piece.text_at[of]), np.minimum(after, piece.text_at[of + 1])
    keys = join_hashes(span_hashes(data, start, end, long=1024), of.astype(np.uint64))
    repeated = np.ones(len(first), bool)
    repeated[np.unique(keys, return_index=True)[1]] = False

    in_repeat = repeated_words(piece)
    span = lambda flags: (lambda s: s[end] - s[start])(_sums(flags))
    n = np.maximum(words, 1)
    letters = np.maximum(span(_LETTER[data]), 1)
    in_words = np.maximum(span(piece.is_word), 1)
    last = data[piece.word_end[first + words - 1] - 1] if len(first) else np.zeros(0, np.uint8)
    covered = _sums(in_repeat)
    features = np.stack([
        np.ones(len(first)), span(_UPPER[data]) / letters, np.minimum(span(_SYMBOL[data]) / n, 3), np.minimum(span(data == 33) / n, 3),
        np.log1p(words) / 4, repeated, (covered[first + words] - covered[first]) / n, np.minimum(in_words / n, 40) / 10,
        words < 3, _FINAL[last], span(_DIGIT[data]) / in_words,
    ], axis=1).astype(np.float64) if len(first) else np.zeros((0, len(FEATURES)))
    return Lines(np.searchsorted(of, np.arange(piece.texts + 1)), words, features, repeated, in_repeat)


def viterbi(scores: np.ndarray, at: np.ndarray, model: Model) -> np.ndarray:
    """Best labels of chains that lie one after the other, ``at`` their offsets; all chains step together."""
    size = np.diff(at)
    order = np.argsort(-size, kind="stable")
    size, start = size[order], at[:-1][order]
    best = scores.copy()
    back = np.zeros(scores.shape, np.int8)
    alive = int(np.count_nonzero(size > 0))
    best[start[:alive]] += model.first
    for t in range(1, int(size.max(initial=0))):
        alive = int(np.searchsorted(-size, -t))
        here = start[:alive] + t
        ways = best[here - 1][:, :, None] + model.pair
        back[here] = ways.argmax(axis=1)
        best[here] += ways.max(axis=1)
    label = np.zeros(len(scores), np.int8)
    full = size > 0
    label[(start + size - 1)[full]] = best[(start + size - 1)[full]].argmax(axis=1)
    for t in range(int(size.max(initial=0)) - 1, 0, -1):
        alive = int(np.searchsorted(-size, -t))
        here = start[:alive] + t
        label[here - 1] = back[here, label[here]]
    return label


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(chains: Sequence[np.ndarray], labels: Sequence[int], rounds: int = 150, penalty: float = 1e-3) -> Model:
    """Maximum likelihood with an L2 penalty, by gradient ascent with adaptive steps.

    ``chains`` are feature rows of documents, ``labels`` the label of all lines of each.
    Gradients are observed less expected counts by forward and backward sums, over all
    chains at once.
    """
    longest, width = max(map(len, chains)), chains[0].shape[1]
    x = np.zeros((len(chains), longest, width))
    there = np.zeros((len(chains), longest), bool)
    for k, c in enumerate(chains):
        x[k, : len(c)], there[k, : len(c)] = c, True
    y = np.asarray(labels)
    gold = np.zeros((len(chains), longest, 2))
    gold[np.arange(len(chains)), :, y] = 1
    gold *= there[:, :, None]
    # both kinds of documents weigh the same
    share = np.where(y == CONTENT, 0.5 / max(1, (y == CONTENT).sum()), 0.5 / max(1, (y == BOILERPLATE).sum()))
    steps = there[:, 1:]
    theta = np.zeros(2 * width + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(len(chains))
    last = there.sum(axis=1) - 1
    for turn in range(1, rounds + 1):
        w, pair, first = theta[: 2 * width].reshape(width, 2), theta[2 * width : 2 * width + 4].reshape(2, 2), theta[-2:]
        s = x @ w
        forward, backward = np.zeros_like(s), np.zeros_like(s)
        forward[:, 0] = s[:, 0] + first
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1][:, :, None] + pair, 1) + s[:, t]
            forward[:, t] = np.where(there[:, t][:, None], step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = _log_sum(pair + (s[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(there[:, t + 1][:, None], step, 0)
        total = _log_sum(forward[rows, last], 1)
        node = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
        edge = np.exp(
            forward[:, :-1, :, None] + pair + (s[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        ) * steps[:, :, None, None]
        seen = gold[:, :-1, :, None] * gold[:, 1:, None, :] * steps[:, :, None, None]
        per_line = share / np.maximum(1, last + 1)
        grad = np.concatenate([
            np.einsum("dtf,dts,d->fs", x, gold - node, per_line).ravel(),
            np.einsum("dtab,d->ab", seen - edge, per_line).ravel(), ((gold - node)[:, 0] * per_line[:, None]).sum(axis=0),
        ]) - penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + 0.2 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-9)
    return Model(theta[: 2 * width].reshape(width, 2), theta[2 * width : 2 * width + 4].reshape(2, 2), theta[-2:])


def run_of_lines(features: np.ndarray, lines: int) -> np.ndarray:
    """At most ``lines`` lines on end, from a place that a hash of the document's features gives."""
    spare = len(features) - lines
    if spare <= 0:
        return features
    at = zlib.crc32(features.astype("<f4").tobytes()) % (spare + 1)
    return features[at : at + lines]


def train(docs: DataFrame, labels: DataFrame, per_kind: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> Model | None:
    """A model from ``labels`` (doc_id, good), or None where only one kind of document is labelled.

    The sample is the ``per_kind`` labelled documents of either kind with the least hash
    and ``lines`` lines on end of each, at a hashed place of longer ones; nothing else of the corpus comes to the driver.
    """
    from functools import reduce

    known = labels.filter("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.bool_and("good").alias("good"))
    sample = reduce(DataFrame.unionByName, [
        known.filter("good" if good else "NOT good").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_kind) for good in (True, False)
    ])
    # at most 2 * per_kind rows
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def work(piece: Piece) -> list:
        found = lines_of(piece)
        rows = [run_of_lines(found.features[a:b], lines).astype("<f4").tobytes() for a, b in zip(found.text_at[:-1], found.text_at[1:])]
        return [rows]

    rows = map_texts(chosen, ["doc_id", "good"], "features binary", work).filter("length(features) > 0").collect()
    rows.sort(key=lambda r: (r["good"], r["doc_id"], bytes(r["features"])))
    chains = [np.frombuffer(bytes(r["features"]), "<f4").reshape(-1, len(FEATURES)).astype(float) for r in rows]
    kinds = [CONTENT if r["good"] else BOILERPLATE for r in rows]
    return fit(chains, kinds) if len(set(kinds)) == 2 else None


def judge(docs: DataFrame, model: Model | None, keep: Sequence[str] = ("doc_id",), min_content: float = MIN_CONTENT) -> DataFrame:
    """The columns ``keep`` with the counts of every text and whether it is kept.

    A text fails the base rules with fewer than 50 words or with more than half of its
    words in repeated three-word windows; others are kept if at least ``min_content`` of their
    words lie in content lines. Null texts count as empty and fail. Without a
    model every line is content. Repeated rows are judged each; ties of labels go to
    content. Kept columns named as results are replaced.
    """

    def work(piece: Piece) -> list:
        found = lines_of(piece)
        n_words = piece.n_words
        chars = _sums(piece.is_word & ((piece.data & 0xC0) != 0x80))[piece.text_at]
        symbols = _sums(_SYMBOL[piece.data])[piece.text_at]
        repeats = _sums(found.in_repeat)[piece.word_at]
        again = _sums(found.repeated)[found.text_at]
        if model is None:
            content = n_words
        else:
            label = viterbi(found.features @ model.weight, found.text_at, model)
            content = np.diff(_sums(np.where(label == CONTENT, found.words, 0))[found.text_at])
        failed = (n_words < MIN_WORDS) | (100 * np.diff(repeats) > 50 * n_words)
        return [n_words, np.diff(chars), np.diff(symbols), np.diff(again), np.diff(repeats), content, failed, ~failed & (content >= min_content * n_words)]

    return map_texts(docs, keep, _RESULTS, work)
