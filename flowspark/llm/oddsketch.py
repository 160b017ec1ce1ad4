"""Near-duplicates by banded MinHash, verified by odd sketches and then on full sets.

A document's MinHash samples serve twice. Cut into bands they are bucket keys: two
documents that share one are candidates. Folded into a bitmap by parity (an odd
sketch) they tell how far two documents differ from the number of bits in which
their bitmaps do; at high similarity that is much more exact than the samples'
overlap itself. Candidates whose bitmaps say "far" by five standard deviations are
dropped, all others are decided on their full shingle sets.

No pairs within a group are written out. Documents of equal sets are one class from
the start. Every class of a shared bucket joins one block of about ``BLOCK`` others of
its largest bucket, and the full sets of a block meet in one task, which joins them to
components; buckets whose members are in one component are done. What is then still
apart is compared across components only, each pair of larger blocks in one task,
where bitmaps leave few pairs to the full sets. A hot bucket is many blocks, only links
that join components are written, and none come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from flowspark.llm.bloom import Filter, build_filter
from flowspark.llm.common import python_ready, without
from flowspark.llm.hashing import join_hashes, mix, ngrams, pieces
from flowspark.session import cut_lineage

#: Two documents at a similarity of 0.8 share no band with probability (1 - 0.8^6)^40 = 5e-6.
BANDS, ROWS = 40, 6
#: Samples of the sketch; the bands are made of the first ones.
SAMPLES = 480
SKETCH_BITS = 1024
SKETCH_WORDS = SKETCH_BITS // 64
SIGMAS = 5.0
#: Classes of a block of a bucket, and of one in the comparison across components.
BLOCK, WIDE_BLOCK = 64, 512
OUTPUT = ["n_shingles", "component_id", "kept"]

_rng = np.random.Generator(np.random.PCG64(2718281828))
_SALT = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
_FACTOR = (_rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def farthest(similarity: float, samples: int = SAMPLES, bits: int = SKETCH_BITS, sigmas: float = SIGMAS) -> int:
    """Most differing bits that two documents of at least this similarity show.

    Of ``samples`` pairs, a share of 1 - similarity differs and puts two elements each
    into the symmetric difference; m elements thrown into ``bits`` cells leave
    bits / 2 (1 - exp(-2 m / bits)) odd ones.
    """
    m = 2 * samples * (1 - similarity)
    mean = bits / 2 * (1 - math.exp(-2 * m / bits))
    thrown = bits / 4 * (1 - math.exp(-4 * m / bits))
    drawn = math.exp(-4 * m / bits) * 4 * samples * similarity * (1 - similarity)
    return math.ceil(mean + sigmas * math.sqrt(thrown + drawn))


def _sorted_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, distinct shingles in order of text and hash, offsets of the texts) by pieces."""
    for piece in pieces(texts, lower=True):
        words, n = piece.word_hashes(), piece.n_words
        grams, text = ngrams(words, piece.word_at, width)
        short = np.flatnonzero((n > 0) & (n < width))
        if len(short):
            whole = words[piece.word_at[short]]
            for k in range(1, width - 1):
                more = n[short] > k
                whole[more] = join_hashes(whole[more], words[piece.word_at[short[more]] + k])
            grams = np.concatenate([grams, mix(whole + n[short].astype(np.uint64))])
            text = np.concatenate([text, short])
            order = np.argsort(text, kind="stable")
            grams, text = grams[order], text[order]
        at = np.searchsorted(text, np.arange(piece.texts + 1))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            grams[a:b].sort()
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        upto = np.zeros(len(grams) + 1, np.int64)
        np.cumsum(new, out=upto[1:])
        yield piece.first, grams[new], upto[at]


def _signatures(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """(key 1, key 2, bands, sketch) of the sets that aren't empty."""
    start = at[:-1][np.diff(at) > 0]
    low = (grams & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    samples = np.empty((SAMPLES, len(start)), np.uint32)
    h, t = np.empty_like(low), np.empty_like(low)
    for k in range(SAMPLES):
        np.bitwise_xor(low, _SALT[k], out=h)
        np.multiply(h, _FACTOR[k], out=h)
        np.right_shift(h, 15, out=t)
        np.bitwise_xor(h, t, out=h)
        samples[k] = np.minimum.reduceat(h, start)
    wide = samples.astype(np.uint64)
    bands = np.empty((BANDS, len(start)), np.uint64)
    for b in range(BANDS):
        key = np.full(len(start), b + 1, np.uint64)
        for r in range(ROWS):
            key = join_hashes(key, wide[b * ROWS + r])
        bands[b] = key
    cell = mix(wide + (np.arange(1, SAMPLES + 1, dtype=np.uint64) << np.uint64(32))[:, None]) % np.uint64(SKETCH_BITS)
    flat = cell.astype(np.int64) + np.arange(len(start)) * SKETCH_BITS
    odd = np.bincount(flat.ravel(), minlength=len(start) * SKETCH_BITS) & 1
    sketch = np.packbits(odd.astype(np.uint8).reshape(len(start), SKETCH_BITS), axis=1).view("<i8")
    spread = mix(grams)
    key1 = np.add.reduceat(spread, start)
    key2 = np.bitwise_xor.reduceat(mix(spread + np.uint64(0x5851F42D4C957F2D)), start)
    return key1, key2, bands.T, sketch


def _list_column(rows: np.ndarray, full: np.ndarray, width: int) -> pa.Array:
    """Rows of numbers as a list column, null where ``full`` is false."""
    at = np.concatenate([[0], np.cumsum(full) * width]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.ascontiguousarray(rows).view(np.int64).ravel()))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, key1, key2, bands (array<long>), sketch (array<long>) of each row; no bands without words."""
    python_ready(docs.sparkSession)
    key = docs.schema["doc_id"].dataType

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, grams, at in _sorted_sets(batch.column(1), width):
                n = np.diff(at)
                full = n > 0
                k1, k2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                bands, sketch = np.zeros((0, BANDS), np.int64), np.zeros((0, SKETCH_WORDS), np.int64)
                if full.any():
                    k1[full], k2[full], bands, sketch = _signatures(grams, at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(n)), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                    _list_column(bands, full, BANDS), _list_column(sketch, full, SKETCH_WORDS),
                ], names=["doc_id", "n_shingles", "key1", "key2", "bands", "sketch"])

    schema = f"doc_id {key.simpleString()}, n_shingles long, key1 long, key2 long, bands array<long>, sketch array<long>"
    return docs.select("doc_id", "text").mapInArrow(sign, schema)


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """doc_id and set (array<long>) of the rows whose doc_id is in ``wanted``, and of few others.

    A Bloom filter of the wanted ids, of bounded size, goes to the workers, so that texts
    are not shuffled.
    """
    spark = docs.sparkSession
    python_ready(spark)
    key = docs.schema["doc_id"].dataType
    built = build_filter(cut_lineage(wanted.select(F.xxhash64("doc_id").alias("item"), F.lit(1).alias("q"))))
    shared = spark.sparkContext.broadcast((built.bits, built.segments))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Filter(*shared.value)
        for batch in batches:
            batch = batch.filter(pa.array(chosen.levels(batch.column(2).to_numpy().view(np.uint64)) > 0))
            for first, grams, at in _sorted_sets(batch.column(1), width):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(at) - 1).cast(to_arrow_type(key)),
                    pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(grams.view(np.int64))),
                ], names=["doc_id", "set"])

    hashed = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("item"))
    return hashed.mapInArrow(gather, f"doc_id {key.simpleString()}, set array<long>")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); component is its least reachable node.

    A round takes the least label around each node and then the label of that label,
    so long chains halve. Rounds are stored, and only a count of changes comes to the driver.
    """
    both = cut_lineage(
        links.filter("a <> b").select("a", "b").union(links.filter("a <> b").select("b", "a")).distinct()
    )
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    while True:
        around = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        nearer = labels.join(around, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        stepped = cut_lineage(
            nearer.join(jump, "next", "left").select(
                "node", F.least("next", F.coalesce("beyond", "next")).alias("component"),
                (F.col("component") > F.least("next", F.coalesce("beyond", "next"))).alias("changed"),
            )
        )
        labels = stepped.select("node", "component")
        if stepped.filter("changed").isEmpty():
            return labels


def block_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(first, other) for every set that is linked, directly or through others, with the first one of its group."""
    size = np.array([len(s) for s in sets])
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    seen = np.bincount(column, minlength=len(values))
    keep = seen[column] > 1  # values of one set alone are in no intersection
    row = np.repeat(np.arange(len(sets)), size)[keep]
    number = np.cumsum(seen > 1) - 1
    both = np.zeros((len(sets), len(sets)))
    columns = number[column[keep]]
    order = np.argsort(columns, kind="stable")
    row, columns = row[order], columns[order]
    step = 1 << 14
    for first in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        a, b = np.searchsorted(columns, [first, first + step])
        part = np.zeros((len(sets), step), np.float32)
        part[row[a:b], columns[a:b] - first] = 1
        both += part @ part.T
    linked = both * 100 >= percent * (size[:, None] + size[None] - both)
    found, left = [], np.ones(len(sets), bool)
    for root in range(len(sets)):
        if left[root]:
            reached = np.zeros(len(sets), bool)
            reached[root] = True
            fresh = reached
            while fresh.any():
                fresh = linked[fresh].any(axis=0) & ~reached
                reached |= fresh
            left &= ~reached
            found += [(root, int(x)) for x in np.flatnonzero(reached) if x != root]
    return found


def _first_links(inside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) within blocks of the buckets, stored. Every class is in one block, and a is
    the least of its group there, so a is the component of b at once."""
    sizes = inside.groupBy("bucket").agg(F.count("*").alias("n"))
    chosen = inside.join(sizes, "bucket").groupBy("rep").agg(F.max(F.struct("n", "bucket")).alias("x"))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("x.n") / BLOCK)).cast("int")
    placed = chosen.select(
        F.col("rep").alias("doc_id"), F.col("x.bucket").alias("bucket"),
        F.pmod(F.xxhash64("rep"), blocks).alias("block"),
    )
    # blocks of one class hold no link
    several = placed.groupBy("bucket", "block").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).filter("x < y")
    placed = placed.join(several.select("bucket", "block"), ["bucket", "block"], "left_semi")
    key = inside.schema["rep"].dataType.simpleString()

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("doc_id")
        ids = rows["doc_id"].tolist()
        found = block_links([np.asarray(s, np.int64) for s in rows["set"]], percent)
        return pd.DataFrame({"a": [ids[x] for x, _ in found], "b": [ids[y] for _, y in found]})

    return cut_lineage(
        placed.join(sets, "doc_id").groupBy("bucket", "block").applyInPandas(links, f"a {key}, b {key}").distinct()
    )


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``.

    Words are parted by ASCII white space and A-Z count as a-z. A set is the distinct
    ``width``-word shingles, or the whole sequence where there are fewer words. Rows
    without words or text are linked with nothing and are kept, as are rows with a null
    doc_id, whose component is null. Rows of one doc_id are one document: linked with all that
    any of them is linked with. Repeated rows are returned each. Other columns are not read.
    """
    named = docs.filter("doc_id IS NOT NULL")
    signed = cut_lineage(signatures(named, width))
    # one class for each distinct set, named by its least document; copies of a class go no further
    classes = cut_lineage(
        signed.filter("n_shingles > 0").groupBy("key1", "key2", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.min_by(F.struct("bands", "sketch"), "doc_id").alias("s"))
        .select("key1", "key2", "n_shingles", "rep", "s.bands", "s.sketch")
    )
    member = cut_lineage(
        signed.select("doc_id", "n_shingles", "key1", "key2")
        .join(classes.select("key1", "key2", "n_shingles", "rep"), ["key1", "key2", "n_shingles"], "left")
        .select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"))
    )
    same_id = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count("*").alias("rows")).filter("a < b")
    same = member.join(same_id, "doc_id").select("a", F.col("rep").alias("b")).filter("a < b").distinct()

    bucketed = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = bucketed.groupBy("bucket").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    inside = cut_lineage(bucketed.join(shared.select("bucket"), "bucket"))
    sets = cut_lineage(shingle_sets(named, inside.select(F.col("rep").alias("doc_id")).distinct(), width))

    first = _first_links(inside, sets, percent)
    near = first.select(F.col("b").alias("node"), F.col("a").alias("component"))
    far = _across(_open_buckets(inside, near), classes, sets, percent)
    labels = components(first.unionByName(far).unionByName(same))

    found = member.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    found = found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    unnamed = signatures(docs.filter("doc_id IS NULL"), width).select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return found.unionByName(unnamed)


def _open_buckets(inside: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, rep, component) of the buckets whose members are in more than one component, stored."""
    labelled = inside.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "bucket", "rep", F.coalesce("component", "rep").alias("component")
    )
    labelled = cut_lineage(labelled)
    several = labelled.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y")
    return cut_lineage(labelled.join(several.select("bucket"), "bucket", "left_semi"))


def far_links(rows: pd.DataFrame, first: int, second: int, percent: int) -> list[tuple]:
    """Pairs of components that a link between a class of block ``first`` and one of block ``second`` joins."""
    block, label = rows["block"].to_numpy(), rows["component"].astype("category").cat.codes.to_numpy().copy()
    size = rows["n_shingles"].to_numpy()
    sketch = np.stack([np.asarray(x, np.int64) for x in rows["sketch"]]).view(np.uint64)
    sets = [np.asarray(x, np.int64) for x in rows["set"]]
    names, limit, found = rows["component"].tolist(), farthest(percent / 100), []
    other = np.flatnonzero(block == second)
    for x in np.flatnonzero(block == first).tolist():
        near = other[label[other] != label[x]]
        if first == second:
            near = near[near > x]
        low, high = np.minimum(size[near], size[x]), np.maximum(size[near], size[x])
        near = near[low * 100 >= high * percent]
        near = near[np.bitwise_count(sketch[near] ^ sketch[x]).sum(axis=1) <= limit]
        for y in near.tolist():
            if label[y] != label[x]:
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if both * 100 >= percent * (size[x] + size[y] - both):
                    label[label == label[y]] = label[x]
                    found.append((names[x], names[y]))
    return found


def _across(open_: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between components, stored; ``open_`` holds (bucket, rep, component).

    Components that share buckets, directly or through others, are a family; outside it their
    classes have no link. A family is dealt into blocks, and each pair of blocks meets in one task,
    where sizes and bitmaps rule out nearly all pairs and full sets decide the rest.
    """
    lows = open_.groupBy("bucket").agg(F.min("component").alias("a"))
    family = components(open_.join(lows, "bucket").select("a", F.col("component").alias("b")).distinct())
    member = open_.select("rep", "component").distinct().join(
        family.select(F.col("node").alias("component"), F.col("component").alias("family")), "component"
    )
    sizes = member.groupBy("family").agg(
        F.ceil(F.count("*") / WIDE_BLOCK).cast("int").alias("blocks"), F.min("component").alias("x"), F.max("component").alias("y")
    ).filter("x < y").select("family", "blocks")
    placed = member.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    own = F.col("block")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j"))
    )
    units = placed.join(classes.select("rep", "n_shingles", "sketch"), "rep").join(sets.withColumnRenamed("doc_id", "rep"), "rep").select(
        F.col("rep").alias("doc_id"), "component", "family", "block", "n_shingles", "sketch", "set", F.explode(pairs).alias("unit")
    ).select("*", "unit.i", "unit.j").drop("unit")
    key = open_.schema["rep"].dataType.simpleString()

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        found = far_links(rows, int(rows["i"].iloc[0]), int(rows["j"].iloc[0]), percent)
        return pd.DataFrame({"a": [x for x, _ in found], "b": [y for _, y in found]}, dtype=None if found else object)

    return cut_lineage(units.groupBy("family", "i", "j").applyInPandas(links, f"a {key}, b {key}"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component, all columns as they are; rows without doc_id stay."""
    kept = near_duplicates(docs.select("doc_id", "text"), width, percent).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    once = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    rows = docs.join(kept, "doc_id", "left_semi").withColumn("__turn", F.row_number().over(once)).filter("__turn = 1")
    rest = docs.filter("doc_id IS NULL")
    return without(rows, ["__turn"]).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(rest)
