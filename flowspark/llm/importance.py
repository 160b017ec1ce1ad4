"""Quality classifier by importance resampling with hashed n-gram models.

Three generative models share one table of hashed words and word pairs: the target
model is counted on good labelled documents, the raw model on all documents, and a
third one on the bad labelled documents where there are any. An n-gram's log ratio is that
of the target to the raw model, plus that of the target model to the bad one. A document's
log weight is the sum of the log ratios of its n-grams, and the documents
to keep are a sample without replacement in proportion to the weights, drawn by
adding Gumbel noise and taking the k greatest.

Three things make this work on texts of any length. An n-gram is counted once per
document, in the models and in the weight, so that repeats neither set the
probabilities nor add up. And a ratio
counts only as far as it is certain: standard errors (one against the raw model, two
against the bad one) and a dead zone are taken off its logarithm. Otherwise the small errors of thousands of common or rare words
outweigh the few words that tell. Weights are raised to a power before the draw, so
that the noise decides only between documents of nearly equal weight.

Counting is one pass with a sum per bucket and task. Only ratios that are not zero
come to the driver, at most one per bucket. The k-th greatest key is found by
counting keys by their leading bits, a few rounds over stored numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowspark.llm.common import python_ready, unit_interval
from flowspark.llm.hashing import Piece, ngrams, pieces
from flowspark.llm.texts import map_texts
from flowspark.session import cut_lineage

#: Buckets of single words, and of word pairs behind them.
WORD_BUCKETS, PAIR_BUCKETS = 1 << 19, 1 << 18
BUCKETS = WORD_BUCKETS + PAIR_BUCKETS
#: Labelled documents that the target model is counted on, good and bad together.
SAMPLE = 50_000
CERTAINTY, DEAD_ZONE = 1.0, 0.5
#: Standard errors taken off ratios of good to bad documents, which are fewer than all documents.
LABELLED_CERTAINTY = 2.0
#: The power that weights are raised to where documents of both kinds are labelled.
SHARPNESS = 4.0
#: A word that many times on end has one bucket whatever the word.
RUN = 6
_SCALE, _SHIFT = 1 << 20, 1 << 61
OUTPUT = ["log_weight", "key", "kept"]


def buckets(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and word pair of a piece of lower-cased texts.

    A pair that ends a run of at least ``RUN`` equal words lies in the last bucket.
    """
    words = piece.word_hashes()
    pairs, of = ngrams(words, piece.word_at, 2)
    single = (words >> np.uint64(20)) & np.uint64(WORD_BUCKETS - 1)
    double = ((pairs >> np.uint64(20)) & np.uint64(PAIR_BUCKETS - 1)) + np.uint64(WORD_BUCKETS)
    text, at = piece.text_of_word(), np.arange(len(words))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    run = at - np.maximum.accumulate(np.where(again, 0, at)) + 1 if len(words) else at
    starts = np.append(True, text[1:] != text[:-1])[: len(words)]
    double[run[~starts] >= RUN] = BUCKETS - 1
    return np.concatenate([single, double]).astype(np.int64), np.concatenate([text, of])


def once(bucket: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each bucket once per text."""
    both = np.unique(text * BUCKETS + bucket)
    return both % BUCKETS, both // BUCKETS


def label_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, good): the labelled documents of least hash, at most ``size``."""
    known = labels.filter("doc_id IS NOT NULL AND good IS NOT NULL").groupBy("doc_id").agg(F.bool_and("good").alias("good"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def document_counts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(bucket, raw, target, bad): all documents that hold an n-gram of the bucket, and the good and bad ones of the sample."""
    python_ready(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target, bad = (np.zeros(BUCKETS, np.int64) for _ in range(3))
        for batch in batches:
            kind = batch.column(1).to_pandas()
            is_good, is_bad = (kind == True).to_numpy(), (kind == False).to_numpy()  # noqa: E712
            for piece in pieces(batch.column(0), lower=True):
                bucket, text = once(*buckets(piece))
                text = text + piece.first
                raw += np.bincount(bucket, minlength=BUCKETS)
                target += np.bincount(bucket[is_good[text]], minlength=BUCKETS)
                bad += np.bincount(bucket[is_bad[text]], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([
            pa.array(seen, pa.int32()), pa.array(raw[seen]), pa.array(target[seen]), pa.array(bad[seen]),
        ], names=["bucket", "raw", "target", "bad"])

    # at most ``SAMPLE`` rows
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "good")
    return known.mapInArrow(count, "bucket int, raw long, target long, bad long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target"), F.sum("bad").alias("bad")
    )


def log_ratios(counts: DataFrame, certainty: float = CERTAINTY, dead_zone: float = DEAD_ZONE) -> np.ndarray:
    """Log ratio of target to raw model per bucket, drawn in towards zero."""
    total = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not total[0] or not total[1]:
        return np.zeros(BUCKETS)
    expected = F.col("raw") * F.lit(float(total[1]) / float(total[0])) + 1
    seen = F.col("target") + F.lit(1.0)
    return _sure(counts, F.log(seen / expected), seen, expected, certainty, dead_zone)


def labelled_ratios(counts: DataFrame, good: int, bad: int) -> np.ndarray:
    """Log ratio per bucket of target to raw model, plus that of its share of the ``good`` documents to its share
    of the ``bad`` ones, each drawn in towards zero, raised to the power ``SHARPNESS``. Both numbers must be positive."""
    of_good, of_bad = F.col("target") + F.lit(1.0), F.col("bad") + F.lit(1.0)
    ratio = F.log(of_good / F.lit(good + 2.0) / (of_bad / F.lit(bad + 2.0)))
    rows = counts.filter("target + bad > 0")
    return SHARPNESS * (log_ratios(counts) + _sure(rows, ratio, of_good, of_bad, LABELLED_CERTAINTY, DEAD_ZONE))


def _sure(counts: DataFrame, ratio: Column, seen: Column, expected: Column, certainty: float, dead_zone: float) -> np.ndarray:
    """``ratio`` per bucket less its standard errors and the dead zone; only those left come to the driver."""
    out = np.zeros(BUCKETS)
    sure = F.abs(ratio) - F.lit(certainty) * F.sqrt(1 / seen + 1 / expected) - F.lit(dead_zone)
    rows = (
        counts.select("bucket", (F.signum(ratio) * F.greatest(sure, F.lit(0.0))).alias("r"))
        .filter("r <> 0").toPandas()
    )
    out[rows["bucket"].to_numpy()] = rows["r"].to_numpy()
    return out


def greatest(keys: DataFrame, k: int, bits: int = 62, step: int = 16) -> int | None:
    """The k-th greatest value of the long column ``key``, from 0 to 2^bits - 1; None if k is 0.

    A round counts the values below the prefix found so far by their next bits.
    """
    if k <= 0:
        return None
    prefix, left = 0, bits
    while left:
        width = min(step, left)
        left -= width
        rows = keys.filter(F.shiftright("key", left + width) == prefix).groupBy(
            F.shiftright("key", left).alias("head")
        ).agg(F.count("*").alias("n")).collect()
        for head, n in sorted(((r["head"], r["n"]) for r in rows), reverse=True):
            if n >= k:
                prefix = head
                break
            k -= n
        else:
            return 0
    return prefix


def best_bound(scored: DataFrame, sample: DataFrame) -> int:
    """The key from which on to keep, so that labelled documents part best: the share of good ones kept
    less the share of bad ones kept is greatest. Weights were fitted on these documents and part others less
    well, so the bound is the highest that lies within one standard error of the best. 0 without both kinds."""
    # at most one row per document of the sample
    rows = scored.select("doc_id", "__place").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.max("__place").alias("place"), F.bool_and("good").alias("good")
    ).toPandas().sort_values("place", ascending=False)
    good = rows["good"].to_numpy(bool)
    if not good.any() or good.all():
        return 0
    kept, passed = np.cumsum(good) / good.sum(), np.cumsum(~good) / (~good).sum()
    parted = kept - passed
    best = int(parted.argmax())
    error = np.sqrt(kept[best] * (1 - kept[best]) / good.sum() + passed[best] * (1 - passed[best]) / (~good).sum())
    return int(rows["place"].iloc[int(np.flatnonzero(parted >= parted[best] - error)[0])])


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, seed: int = 41, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with log_weight, key and kept.

    Kept are the k rows of greatest key: ``share`` of all rows, rounded up, or by default as many as
    lie above the bound that parts the labelled documents best. Rows that tie with the last one
    kept stay too, as repeated rows always do. Null and empty texts have weight 0. Without
    labels or without good ones among them all weights are 0; without labels of both kinds
    all rows are kept. Columns named as the results are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in OUTPUT])
    sample = cut_lineage(label_sample(docs, labels))
    counts = cut_lineage(document_counts(docs, sample))
    # at most ``SAMPLE`` rows
    kinds = dict(docs.select("doc_id").join(F.broadcast(sample), "doc_id").groupBy("good").count().collect())
    good, bad = kinds.get(True, 0), kinds.get(False, 0)
    ratios = labelled_ratios(counts, good, bad) if good and bad else log_ratios(counts)

    def work(piece: Piece) -> list:
        bucket, text = once(*buckets(piece))
        return [np.bincount(text, ratios[bucket], minlength=piece.texts)]

    noise = -F.log(-F.log((unit_interval(F.col("__noise")) + 1e-17)))
    named = docs.withColumn("__noise", F.xxhash64(F.lit(seed), "doc_id", "text"))

    def scored(columns: list[str]) -> DataFrame:
        out = map_texts(named, [*columns, "__noise"], "log_weight double", work, lower=True)
        out = out.withColumn("key", F.col("log_weight") + noise).drop("__noise")
        # keys as whole numbers, so that their bits can be counted
        return out.withColumn("__place", F.greatest(F.lit(0), F.least(F.lit(2 * _SHIFT - 1), (F.col("key") * _SCALE).cast("long") + _SHIFT)))

    keep = list(keep or docs.columns)
    slim = "text" not in keep
    stored = cut_lineage(scored(list(dict.fromkeys([*keep, "doc_id"])) if slim else ["doc_id"]))
    if share is None:
        bound = best_bound(stored, sample)
    else:
        bound = greatest(stored.select(F.col("__place").alias("key")), int(np.ceil(share * stored.count())))
    kept = F.lit(False) if bound is None else F.col("__place") >= bound
    # whole texts are scored once more rather than stored
    out = (stored if slim else scored(keep)).withColumn("kept", kept)
    return out.select(*[F.col(f"`{c}`") for c in keep], *OUTPUT)
