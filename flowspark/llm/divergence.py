"""How far the sources of a language differ in their words: stripes folded inside the mappers.

A map task folds whole documents into stripes: for each term of a language its document
frequency and its counts by source. When the stripes outgrow ``CELLS`` they are spilled as
rows and folding starts again, so a task's memory doesn't follow its input, and a term
leaves a task once per spill however often it occurs. Spilled stripes are dealt by (language,
term), sorted, and merged as a stream.

The merged stripes give the divergences directly. Terms are dealt into blocks of about
``BLOCK_TERMS``; a block meets the totals of its language's sources and gives the pairs'
partial sums and its own best terms. A block holds its terms by the sources of one
language, and one number for each pair of them, which the result has as rows anyway.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import python_ready
from flowspark.session import cut_lineage

#: Fixed value: a term is a run of letters and of bytes from 128 on; A-Z are lower-cased, all other bytes part terms.
_TO_TERMS = bytes(b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
SLICE = 1 << 20
#: Counts and document frequencies that a map task holds before it spills, at some 150 bytes each.
CELLS = 1_000_000
BLOCK_TERMS = 2048
BATCH = 8192
SCALE = 1_000_000_000

STRIPES = "lang string, term string, df long, sources array<string>, counts array<long>"
_STRIPES = pa.schema([
    ("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
])
FOUND = "lang string, source string, part string, item string, value long"
_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def terms_of(body: bytes) -> Iterator[list[bytes]]:
    """Terms of a text; those of long texts come slice by slice, cut between terms."""
    body, at = body.translate(_TO_TERMS), 0
    while at < len(body):
        stop = body.find(b" ", at + SLICE)
        stop = len(body) if stop < 0 else stop
        yield body[at:stop].split()
        at = stop


class Stripes:
    """Counts by (language, source) and document frequencies by language, which together are the stripes."""

    def __init__(self):
        self.counts: dict[tuple[str, str], Counter] = {}
        self.df: dict[str, Counter] = {}
        self.cells = 0

    def add(self, lang: str, source: str, body: bytes) -> None:
        counts, df = self.counts.setdefault((lang, source), Counter()), self.df.setdefault(lang, Counter())
        before, seen = len(counts) + len(df), set()
        for terms in terms_of(body):
            counts.update(terms)
            seen.update(terms)
        df.update(seen)
        self.cells += len(counts) + len(df) - before

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, df in self.df.items():
            parts = [(source, by) for (of, source), by in self.counts.items() if of == lang and by]
            if not parts:
                continue
            terms = pa.chunked_array([pa.array(by.keys(), pa.binary()) for _, by in parts]).combine_chunks().dictionary_encode()
            count = np.concatenate([np.fromiter(by.values(), np.int64, len(by)) for _, by in parts])
            source = np.repeat(np.arange(len(parts)), [len(by) for _, by in parts])
            yield from _rows(
                pa.array([lang] * len(terms.dictionary), pa.string()), terms.dictionary.cast(pa.string()),
                np.array([df[t] for t in terms.dictionary.to_pylist()], np.int64), terms.indices.to_numpy(),
                source, pa.array([name for name, _ in parts], pa.string()), count,
            )
        self.counts, self.df, self.cells = {}, {}, 0


def _rows(
    lang: pa.Array, term: pa.Array, df: np.ndarray, row: np.ndarray, source: np.ndarray, names: pa.Array, count: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Stripes as batches; ``row``, ``source`` and ``count`` are their cells, no two alike in row and source."""
    order = np.argsort(row, kind="stable")
    at = np.zeros(len(term) + 1, np.int32)
    np.cumsum(np.bincount(row, minlength=len(term)), out=at[1:])
    sources = pa.ListArray.from_arrays(pa.array(at), names.take(pa.array(source[order])))
    counts = pa.ListArray.from_arrays(pa.array(at), pa.array(count[order]))
    yield from pa.Table.from_arrays([lang, term, pa.array(df), sources, counts], schema=_STRIPES).to_batches(BATCH)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes = Stripes()
    for batch in batches:
        for lang, source, body in zip(*[c.to_pylist() for c in batch.columns]):
            stripes.add(lang, source, body)
            if stripes.cells >= CELLS:
                yield from stripes.spill()
    yield from stripes.spill()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted stripes: neighbours of one key become one. The last key of a batch waits for the next batch."""
    waiting = None
    for batch in batches:
        table = pa.Table.from_batches([batch], _STRIPES)
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        merged = _merged(table)
        waiting = merged.slice(len(merged) - 1) if len(merged) else None
        yield from merged.slice(0, max(len(merged) - 1, 0)).to_batches(BATCH)
    if waiting is not None:
        yield from waiting.to_batches()


def _merged(table: pa.Table) -> pa.Table:
    if not len(table):
        return table
    lang, term = (table[c].combine_chunks() for c in ("lang", "term"))
    new = np.ones(len(table), bool)
    for column in (lang, term):
        changed = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        new[1:] = changed if column is lang else new[1:] | changed
    key = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    sources, counts = table["sources"].combine_chunks(), table["counts"].combine_chunks()
    row = np.repeat(key, pc.list_value_length(sources).to_numpy())
    names = sources.flatten().dictionary_encode()
    cell, place = np.unique(row * len(names.dictionary) + names.indices.to_numpy(), return_inverse=True)
    count = np.zeros(len(cell), np.int64)
    np.add.at(count, place, counts.flatten().to_numpy())
    width = max(len(names.dictionary), 1)
    return pa.Table.from_batches(_rows(
        lang.take(pa.array(starts)), term.take(pa.array(starts)), np.add.reduceat(table["df"].to_numpy(), starts),
        cell // width, cell % width, names.dictionary, count,
    ), _STRIPES)


def stripes_of(docs: DataFrame) -> DataFrame:
    """Merged stripes of ``docs`` (lang, source and text, nulls as empty): one row per language and term."""
    python_ready(docs.sparkSession)
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    ready = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")], body.alias("body"))
    spilled = ready.mapInArrow(_fold, STRIPES)
    return spilled.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merge, STRIPES)


def shares(count: np.ndarray, total: np.ndarray | int, terms: int, smoothing: int) -> np.ndarray:
    """1 + floor(10^9 * (count + s) / (total + s * terms)), by long division in whole numbers (totals below 9 * 10^15)."""
    below = np.asarray(total, np.int64) + smoothing * terms
    whole, rest = np.divmod(np.asarray(count, np.int64) + smoothing, below)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, below)
        whole = whole * 1000 + step
    return whole + 1


def _diverge(smoothing: int, top: int):
    """For a block of stripes and its language's groups: partial sums of pairs and the block's best terms of each group."""

    def work(stripes: pa.Table, groups: pa.Table) -> pa.Table:
        sources = groups["source"].to_pylist()
        if not sources:
            return _FOUND.empty_table()
        lang, place = groups["lang"][0].as_py(), {s: k for k, s in enumerate(sources)}
        totals, n_all, v = groups["n"].to_numpy(), groups["n_all"][0].as_py(), groups["v"][0].as_py()
        terms, width = stripes["term"].to_pylist(), len(sources)
        order = sorted(range(len(terms)), key=lambda k: terms[k].encode())
        names, counts = stripes["sources"].to_pylist(), stripes["counts"].to_pylist()
        sums = np.zeros((width, width), np.int64)
        best: list[list[tuple]] = [[] for _ in sources]
        step = max(1, (1 << 21) // width)
        for first in range(0, len(order), step):
            some = order[first : first + step]
            count = np.zeros((len(some), width), np.int64)
            for row, k in enumerate(some):
                count[row, [place[s] for s in names[k]]] = counts[k]
            p = shares(count, totals, v, smoothing)
            over = p - shares(count.sum(1), n_all, v, smoothing)[:, None]
            for s in range(width):
                sums[s] += np.abs(p - p[:, s : s + 1]).sum(0)
                there = np.flatnonzero((count[:, s] > 0) & (over[:, s] > 0))
                there = there[np.argsort(-over[there, s], kind="stable")[:top]]
                best[s] += [(-int(over[k, s]), first + int(k)) for k in there]
        mine, other = np.nonzero(~np.eye(width, dtype=bool))
        source = [sources[k] for k in mine] + [s for s, b in zip(sources, best) for _ in sorted(b)[:top]]
        chosen = [x for b in best for x in sorted(b)[:top]]
        return pa.table([
            pa.array([lang] * len(source), pa.string()), pa.array(source, pa.string()),
            pa.array(["pair"] * len(mine) + ["term"] * len(chosen), pa.string()),
            pa.array([sources[k] for k in other] + [terms[order[k]] for _, k in chosen], pa.string()),
            pa.array(sums[mine, other].tolist() + [-f for f, _ in chosen], pa.int64()),
        ], schema=_FOUND)

    return work


def audit(docs: DataFrame, min_docs: int = 30, smoothing: int = 5, top: int = 50) -> DataFrame:
    """lang, source, part, item, value, rank: how each (lang, source) group differs.

    Null text, lang and source count as ''; other columns are left out, repeated rows count
    as often as they are there. A language keeps the terms of at least ``min_docs`` of its
    documents. Part ``pair``: every other source of the language with the sum of absolute
    differences of smoothed shares (billionths) over all kept terms, 0 where there are none.
    Part ``term``: the ``top`` terms that a group uses more than its language. Ranks go by
    value from the greatest, equal ones by item. No documents give no rows.
    """
    kept = cut_lineage(stripes_of(docs).filter(F.col("df") >= min_docs))
    counts = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    used = counts.groupBy("lang", F.col("c.sources").alias("source")).agg(F.sum("c.counts").alias("n"))
    words = kept.groupBy("lang").agg(
        F.count("*").alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b)).alias("n_all")
    )
    there = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    zero = F.lit(0).cast("long")
    groups = there.join(used, ["lang", "source"], "left").join(words, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n", "n_all", "v")]
    )
    blocks = max(1, -(-kept.count() // BLOCK_TERMS))
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks)))
    beside = groups.withColumn("block", F.explode(F.sequence(zero, F.lit(blocks - 1).cast("long"))))
    found = dealt.groupBy("lang", "block").cogroup(beside.groupBy("lang", "block")).applyInArrow(_diverge(smoothing, top), FOUND)
    values = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    ranked = values.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    )
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
