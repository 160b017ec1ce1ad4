"""Mixing sources to target weights: capped water-filling over whole sources.

Every source gets a target in words. A source may be repeated ``max_epochs`` times
at most; what it cannot take is shared again among the others by their weights,
until no target is above its cap. A source then gives all its documents
``whole`` times, and one seeded fraction of them once more.

All of it is DataFrame work. Documents meet in groups only as sums per (source,
slice of the hash range); the one slice of a source in which the fraction ends is
walked document by document, and slices are cut so that one holds about
``SLICE_ROWS`` documents however large the source is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import WORDS, unit_interval, without
from flowspark.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
SLICE_ROWS = 256
MAX_SLICES = 65_536
OUTPUT = ["source_size", "target", "copies", "taken"]


def word_count(text: str = "text") -> Column:
    """Number of words of a text; 0 where it is null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """(source, source_size, n, target) from (source, source_size, n).

    Weights repeat along the sources in code point order, null last. The water
    level rises round by round: a round clamps the sources whose cap lies below
    it and shares the rest of the total by weight. Only three sums of a round come
    to the driver; a level that clamps nobody new is final.
    """
    ordered = cut_lineage(
        sources.orderBy(F.col("source").asc_nulls_last()).withColumn("_id", F.monotonically_increasing_id())
    )
    # the id holds the sorted partition above 33 bits of row number
    parts = ordered.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    table = cut_lineage(
        ordered.withColumn("_part", F.shiftright("_id", 33)).join(starts, "_part").select(
            "source", "source_size", "n", F.element_at(wheel, (place % len(weights) + 1).cast("int")).alias("_weight"),
            (F.col("source_size") * max_epochs).alias("_cap"),
        )
    )
    total, weight = table.agg(F.sum("source_size"), F.sum("_weight")).first()
    total, weight = float(total or 0), float(weight or 0)
    level, clamped = (total / weight if weight else 0.0), -1
    while True:
        below = F.col("_cap") <= F.lit(level) * F.col("_weight")
        n, cap, cap_weight = table.filter(below).agg(F.count("*"), F.sum("_cap"), F.sum("_weight")).first()
        if n == clamped:
            break
        clamped, rest = n, weight - float(cap_weight or 0)
        if rest <= 0:
            break
        level = (total - float(cap or 0)) / rest
    full = F.col("_cap") <= F.lit(level) * F.col("_weight")
    target = F.when(full, F.col("_cap").cast("double")).otherwise(F.lit(level) * F.col("_weight"))
    return table.select("source", "source_size", "n", target.alias("target"))


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_epochs: int = 3,
    seed: int = 17,
    identity: Sequence[str] = ("doc_id", "text"),
) -> DataFrame:
    """``docs`` with source_size, target, copies and taken; copies may be 0.

    The extra fraction is the documents of lowest seeded hash, up to the target;
    the last gap is closed by the one further document of that slice whose size
    fits it best, where that comes nearer. A source's taken words then differ from
    its target by less than half of one document, mostly by far less.

    Null sources form a source of their own, sorted last. Null texts have size 0
    and get the copies of any document. An empty table gives an empty result.
    Repeated rows are documents like others; ties of the hash are settled by the
    identity columns and by size, so that only equal rows are interchangeable.
    Columns named as the results are replaced, all other columns are kept.
    """
    ids = [F.col(c) for c in identity if c in docs.columns]
    base = without(docs, OUTPUT).withColumns(
        {"__size": size.cast("long"), "__source": F.col(source).cast("string"), "__h": F.xxhash64(F.lit(seed), *ids)}
    )
    stats = base.groupBy(F.col("__source").alias("source")).agg(
        F.coalesce(F.sum("__size"), F.lit(0)).alias("source_size"), F.count("*").alias("n")
    )
    targets = source_targets(stats, weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    plan = cut_lineage(
        targets.withColumnRenamed("n", "__n").withColumn("__whole", whole.cast("long"))
        .withColumn("__need", F.when(F.col("__whole") < max_epochs, F.col("target") - F.col("__whole") * F.col("source_size")).otherwise(0.0))
        .withColumn("__slices", F.least(F.lit(MAX_SLICES), F.ceil(F.col("__n") / SLICE_ROWS)))
        .withColumnRenamed("source", "__name").drop("__n")
    )
    key = F.col("__source").eqNullSafe(F.col("__name"))
    piece = F.floor(unit_interval(F.col("__h")) * F.col("__slices"))
    sums = (
        base.join(plan, key).groupBy("__name", piece.alias("__slice")).agg(F.sum("__size").alias("__words"), F.first("__need").alias("__need"))
    )
    running = Window.partitionBy("__name").orderBy("__slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        sums.withColumn("__upto", F.sum("__words").over(running)).filter(F.col("__upto") > F.col("__need"))
        .groupBy(F.col("__name").alias("__cut_name"))
        .agg(F.min("__slice").alias("__cut"), F.min_by(F.col("__need") - (F.col("__upto") - F.col("__words")), "__slice").alias("__room"))
    )
    plan = cut_lineage(
        plan.join(cuts, F.col("__name").eqNullSafe(F.col("__cut_name")), "left").drop("__cut_name", "__need")
    )
    dealt = base.join(plan, key).withColumn("__slice", piece)
    settled = dealt.filter(F.col("__cut").isNull() | (F.col("__slice") != F.col("__cut"))).withColumn(
        "__extra", F.col("__slice") < F.col("__cut")
    )
    edge = dealt.filter(F.col("__slice") == F.col("__cut"))
    order = Window.partitionBy("__name").orderBy("__h", *[c for c in identity if c in docs.columns], "__size")
    everyone = Window.partitionBy("__name")
    edge = edge.withColumn("__place", F.row_number().over(order)).withColumn(
        "__upto", F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    edge = edge.withColumn("__in", F.col("__upto") <= F.col("__room")).withColumn(
        "__left", F.col("__room") - F.coalesce(F.max(F.when(F.col("__in"), F.col("__upto"))).over(everyone), F.lit(0))
    )
    miss = F.when(~F.col("__in"), F.abs(F.col("__size") - F.col("__left")))
    best = F.min(F.when(miss.isNotNull(), F.struct(miss.alias("miss"), F.col("__place").alias("place")))).over(everyone)
    edge = edge.withColumn("__best", best).withColumn(
        "__extra",
        F.col("__in") | ((F.col("__best.place") == F.col("__place")) & (F.col("__best.miss") < F.col("__left"))),
    )
    rows = settled.unionByName(edge.drop("__place", "__upto", "__in", "__left", "__best"))
    copies = F.col("__whole") + F.coalesce(F.col("__extra"), F.lit(False)).cast("long")
    return rows.select(
        *[F.col(f"`{c}`") for c in without(docs, OUTPUT).columns], "source_size", "target", copies.alias("copies"),
        (copies * F.col("__size")).alias("taken"),
    )


def mixed(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: each document as many times as it is taken, with the columns of ``docs``."""
    rows = mix(docs, size, **options).filter("copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"`{c}`") for c in docs.columns])
