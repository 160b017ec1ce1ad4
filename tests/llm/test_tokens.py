import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flowspark.llm import packing, simple8b
from flowspark.llm.tokens import ChunkEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ENCODER = ChunkEncoder(PATH)


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


HARD = [
    "", None, "Ça ÉTÉ l'été don't IT'S x\u3000y e\u0301e \u0301 ǅx ΑΣ ΣΑΣ.Σ 123abc__", "<|endoftext|>x <|startoftext|> <|STARTOFTEXT|> a<|b",
    "İi ŉa ﬁ × ÷ µ ſt", "a" * 5000, "\u200b \ud7ff ...!!! ##a%%b", "x\x00y \x7f\x1c z", "日本語 text, мир! naïve—dash…", "\t\r\n \x0b\x0c", "a.b,c;d:e!f?g",
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert ENCODER.encode_many(pa.array([text], pa.string()))[0].tolist() == whole(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", max_codepoint=0x2FF) | st.characters(codec="utf-8"), max_size=40), max_size=5))
def test_any_text(texts):
    ids, sizes = ENCODER.encode_many(pa.array(texts, pa.string()))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in texts] if texts else not len(ids)


def test_whole_documents(docs):
    texts = [r["text"] for r in docs.select("text").collect()]
    ids, sizes = ENCODER.encode_many(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in texts]


def test_a_full_table_starts_anew(monkeypatch):
    from flowspark.llm import tokens

    monkeypatch.setattr(tokens, "MAX_KEPT", 5)
    small = ChunkEncoder(PATH)
    for text in ["a b c d", "e f g h i", "a e i o u", "k l m"]:
        assert small.encode_many(pa.array([text]))[0].tolist() == whole(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**64 - 1), st.integers(0, 3), st.integers(0, 50_000)), max_size=400))
def test_simple8b_round_trip(ids):
    words, escapes = simple8b.encode_block(np.array(ids, np.uint64))
    assert simple8b.decode_block(words, escapes).tolist() == ids


def test_simple8b_packs_densely():
    assert len(simple8b.encode_block(np.zeros(600, np.uint64))[0]) == 10
    assert len(simple8b.encode_block(np.full(600, 4095, np.uint64))[0]) == 120


def expected_starts(rows):
    at, out = 0, []
    for doc_id, text in rows:
        ids = whole(text) + [2]
        out.append((doc_id, at, len(ids), digest(ids)))
        at += len(ids)
    return out


def test_token_files(docs, spark, folder):
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    found = simple8b.token_digests(docs.repartition(4), PATH).collect()
    assert sorted(map(tuple, found)) == expected_starts(rows)
    simple8b.write_tokens(docs, f"{folder}/t", PATH)
    ids = {r["doc_id"]: r["ids"] for r in simple8b.read_tokens(spark, f"{folder}/t").collect()}
    assert ids == {d: whole(t) + [2] for d, t in rows}


def test_token_files_of_odd_rows(odd_docs, no_docs):
    found = simple8b.token_digests(odd_docs, PATH).collect()
    sizes = sorted((r["start"], r["n_tokens"]) for r in found)
    assert [s for s, _ in sizes] == [sum(n for _, n in sizes[:k]) for k in range(len(sizes))]
    assert sizes[0][0] == 0 and found[0]["n_tokens"] > 0
    texts = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    assert {(r["doc_id"], r["ids_crc32"]) for r in found} == {(d, digest(whole(t) + [2])) for d, t in texts}
    order = [r["doc_id"] for r in sorted(found, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda d: (d is not None, d))
    assert simple8b.token_digests(no_docs, PATH).count() == 0


def check_packed(rows, docs, capacity):
    texts = {}
    for r in docs:
        texts.setdefault(r["doc_id"], []).append(r["text"])
    pieces = sorted(
        (d is not None, d or 0, k // capacity, k, len(ids[k : k + capacity]), digest(ids[k : k + capacity]))
        for d, found in texts.items() for ids in [whole(t) + [0] for t in found] for k in range(0, len(ids), capacity)
    )
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == pieces
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(docs):
    rows = packing.pack_documents(docs, PATH).collect()
    used = check_packed(rows, docs.collect(), 2048)
    assert used <= -(-sum(r["length"] for r in rows) // 2048) + 1


def test_packing_of_odd_rows(odd_docs, no_docs):
    check_packed(packing.pack_documents(odd_docs, PATH, capacity=64).collect(), odd_docs.collect(), 64)
    assert packing.pack_documents(no_docs, PATH).count() == 0


def test_groups_are_bounded(spark):
    pieces = spark.range(3000).selectExpr("id AS doc_id", "id % 90 + 1 AS length", "id AS row")
    rows = packing.pack(pieces, capacity=100, group_pieces=200).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["sequence_id"] >> 32, []).append(r)
    assert len(rows) == 3000 and len(groups) > 10 and max(map(len, groups.values())) < 400


def _arrival(lengths, capacity):
    """A poor start: next fit in the order of arrival."""
    bins, b = packing.Bins(capacity), None
    for k, n in enumerate(lengths):
        if b is None or bins.fill[b] + n > capacity:
            b = bins.new()
        bins.put(b, (n, k))
    return bins


@pytest.mark.parametrize("low,high", [(1, 100), (20, 60), (30, 70)])
def test_search_empties_bins(low, high):
    lengths = np.random.default_rng(3).integers(low, high, 400).tolist()
    bins = _arrival(lengths, 100)
    squares, before = sum(f * f for f in bins.fill), len(bins.fill)
    packing.improve(bins)
    assert sorted(p for items in bins.items for _, p in items) == list(range(400))
    assert all(sum(n for n, _ in items) == fill <= 100 for items, fill in zip(bins.items, bins.fill))
    assert sum(f * f for f in bins.fill) > squares and sum(map(bool, bins.items)) < before


def test_exchanges():
    bins = packing.Bins(10)
    for items in ([6, 2], [5, 4], [7, 1, 1]):
        b = bins.new()
        for n in items:
            bins.put(b, (n, len(bins.items) * 10 + n))
    # one for one: 5 takes 6's place only where room allows; two for one: 3 for 1 and 1
    assert packing._exchange(bins, 1, (5, 25), 0) is False
    bins.put(1, (1, 99))
    assert bins.fill == [8, 10, 9] and packing._exchange(bins, 0, (2, 12), 2)
    assert sorted(n for n, _ in bins.items[2]) == [1, 2, 7] and bins.fill == [7, 10, 10]




def test_search_finds_exchanges_between_unlike_sequences():
    lengths = [1100] * 2000 + [600] * 3000 + [500] * 2500 + [348] * 3000
    sequence, _ = packing.pack_lengths(lengths, 2048)
    # 2,000 of 1100 + 600 + 348, 1,000 of 600 + 500 + 500 + 348 and 125 of 4 x 500
    assert len(set(sequence.tolist())) <= 3125 and np.bincount(sequence, lengths).max() <= 2048


def test_partners_are_those_of_a_full_look():
    """The files agree with a look at every sequence, before and after steps; a search ends only when none is left."""
    r = np.random.default_rng(3)
    for turn in range(30):
        capacity = int(r.integers(12, 60))
        bins = packing.best_fit(r.integers(1, capacity, int(r.integers(2, 40))).tolist(), capacity)
        bins.file()

        def looked(a, length, two):
            for b, held in enumerate(bins.items):
                gap = capacity - bins.fill[b]
                if b == a or not held or gap == 0 or bins.fill[b] < bins.fill[a]:
                    continue
                sums = [x for x, _ in held]
                if two:
                    sums += [x[0] + y[0] for k, x in enumerate(held) for y in held[k + 1 :]]
                if any(length - gap <= s < length for s in sums):
                    return True
            return False

        for a in range(len(bins.items)):
            for length in range(1, capacity):
                for two in (True, False):
                    b = bins.partner(a, length, two)
                    assert (b is not None) == looked(a, length, two) and b != a
        before = sum(f * f for f in bins.fill)
        pieces = sorted(x for held in bins.items for x in held)
        for a in range(len(bins.items)):
            if bins.items[a] and packing._step(bins, a):
                now = sum(f * f for f in bins.fill)
                assert now > before
                before = now
        assert sorted(x for held in bins.items for x in held) == pieces
        assert all(f == sum(x for x, _ in held) <= capacity for f, held in zip(bins.fill, bins.items))
        packing.improve(bins)
        fewest = -(-sum(bins.fill) // capacity)
        assert sum(map(bool, bins.items)) == fewest or not any(packing._step(bins, a) for a in range(len(bins.items)) if bins.items[a])
