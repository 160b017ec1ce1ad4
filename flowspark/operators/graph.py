"""Step graphs of all flows at once: edges, levels, fan-out, inherited facts.

Each function works on the step table, keyed by (flow, name), so one very large
flow spreads over the cluster like any other rows. The iterative ones store
every round in the shared checkpoint folder: a lost executor repeats one round
at most, and plans stay short.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.session import cut_lineage


def stored(df: DataFrame) -> DataFrame:
    """``df`` stored like any round, as a table that grows with the input and that joins never broadcast.

    Its files are compressed, by fifty times for steps, so the optimizer takes hundreds of
    megabytes for a small table, and what is broadcast has to fit the driver.
    """
    return cut_lineage(df).hint("merge")


def nodes(steps: DataFrame) -> DataFrame:
    """One row per step name; where a name repeats, the last parents count."""
    return steps.groupBy("flow", "name").agg(
        F.max_by("parents", "pos").alias("parents"), F.min("pos").alias("pos"), F.max_by("ord", "pos").alias("ord")
    )


def edges(steps: DataFrame) -> DataFrame:
    """Distinct (flow, parent, child), with ``known`` false where the parent is no step."""
    pairs = steps.select("flow", F.explode("parents").alias("parent"), F.col("name").alias("child")).distinct()
    names = steps.select("flow", F.col("name").alias("parent"), F.lit(True).alias("known")).distinct()
    return pairs.join(names.hint("merge"), ["flow", "parent"], "left").withColumn("known", F.coalesce("known", F.lit(False)))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _chains(chain: DataFrame) -> DataFrame:
    """(flow, name, target, dist): from each step with one parent up to the next step with none or several.

    ``chain`` has the steps with one parent, its only entry of ``parents``. A pointer jumps as far as its target's own
    pointer, so its reach doubles every round, and a chain of n steps takes about log2(n)
    rounds. Steps on or below a cycle of such steps never arrive and are left out: once
    a round has let no pointer arrive, only those are left.
    """
    start = chain.select("flow", "name", F.col("parents")[0].alias("target"), F.lit(1).cast("bigint").alias("dist"))
    above = chain.select("flow", F.col("name").alias("target"), F.lit(True).alias("_open"))
    found = stored(start.join(above, ["flow", "target"], "left").select(
        "flow", "name", "target", "dist", F.coalesce("_open", F.lit(False)).alias("open")
    ))
    arrived, left = [found.filter("NOT open")], found.agg(F.count_if("open")).first()[0]
    while left:
        still = found.filter("open")
        known = _union(arrived).unionByName(still).select(
            "flow", F.col("name").alias("target"), F.col("target").alias("_target"), F.col("dist").alias("_dist"), F.col("open").alias("_open")
        )
        found = stored(still.join(known, ["flow", "target"]).select(
            "flow", "name", F.col("_target").alias("target"), (F.col("dist") + F.col("_dist")).alias("dist"), F.col("_open").alias("open")
        ))
        before, left = left, found.agg(F.count_if("open")).first()[0]
        arrived.append(found.filter("NOT open"))
        if left == before:
            break
    return _union(arrived).drop("open")


def placed_levels(steps: DataFrame, ignore_unknown: bool = False) -> tuple[DataFrame, DataFrame]:
    """Longest path from the roots: (flow, name, pos, level) of every step that can
    be placed, and (flow, name, pos) of the rest: on or behind a cycle, or, unless
    ``ignore_unknown``, behind a parent that is no step.

    A step with one parent lies one level below it, so chains of such steps are
    contracted first. What is left are roots and steps where paths meet. Those are peeled:
    a round settles the steps whose last open edge went with the round before, and stores
    only the edges that are still open.
    """
    own = stored(nodes(steps).withColumn("parents", F.array_distinct("parents")))
    if ignore_unknown:
        links = own.select("flow", F.explode("parents").alias("parent"), "name")
        known = links.join(own.select("flow", F.col("name").alias("parent")), ["flow", "parent"], "left_semi")
        kept = known.groupBy("flow", "name").agg(F.collect_list("parent").alias("parents"))
        own = stored(own.drop("parents").join(kept, ["flow", "name"], "left").withColumn("parents", F.coalesce("parents", F.array().cast("array<string>"))))
    counted = own.select("flow", "name", "pos", "parents", F.size("parents").cast("bigint").alias("need"))
    pointers = _chains(counted.filter("need = 1"))

    target = pointers.select("flow", F.col("name").alias("parent"), "target", "dist")
    meeting = counted.filter("need > 1")
    edges_left = stored(
        meeting.select("flow", F.col("name").alias("child"), F.explode("parents").alias("parent"))
        .join(target, ["flow", "parent"], "left")
        .select("flow", F.coalesce("target", "parent").alias("source"), "child", (F.coalesce("dist", F.lit(0)) + 1).alias("weight"))
    )
    zero = F.lit(0).cast("bigint")
    ready = counted.filter("need = 0").select("flow", "name", "pos", zero.alias("level"))
    open_ = meeting.drop("parents").withColumn("level", zero)
    done = [ready]
    while not open_.isEmpty():
        sources = ready.select("flow", F.col("name").alias("source"), F.col("level").alias("_from"))
        met = edges_left.join(sources, ["flow", "source"]).groupBy("flow", F.col("child").alias("name")).agg(
            F.count("*").alias("met"), F.max(F.col("_from") + F.col("weight")).alias("below")
        )
        open_ = stored(open_.join(met, ["flow", "name"], "left").select(
            "flow", "name", "pos", (F.col("need") - F.coalesce("met", F.lit(0))).alias("need"), F.greatest("level", "below").alias("level")
        ))
        ready, open_ = open_.filter("need = 0").drop("need"), open_.filter("need > 0")
        if ready.isEmpty():
            break
        done.append(ready)
        edges_left = stored(edges_left.join(sources, ["flow", "source"], "left_anti"))
    anchors = _union(done)
    chained = counted.filter("need = 1").join(pointers, ["flow", "name"], "left").join(
        anchors.select("flow", F.col("name").alias("target"), F.col("level").alias("_from")).hint("merge"), ["flow", "target"], "left"
    ).select("flow", "name", "pos", (F.col("_from") + F.col("dist")).alias("level"))
    never = open_.select("flow", "name", "pos", F.lit(None).cast("bigint").alias("level"))
    levels = stored(anchors.unionByName(chained).unionByName(never))
    return levels.filter("level IS NOT NULL"), levels.filter("level IS NULL").drop("level")


def numbered(df: DataFrame, group: str, place: str, width: int = 10_000, then: Sequence[str] = ()) -> DataFrame:
    """Add ``n``: 1, 2, ... per group in the order of the whole number ``place``, and of ``then`` where that is equal.

    Groups are counted in stretches of ``width`` places. Only the counts of the
    stretches meet in one task, so one huge group is numbered in parallel.
    """
    cut = df.withColumn("_stretch", F.floor(F.col(place) / width))
    before = Window.partitionBy(group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(group, "_stretch").agg(F.count("*").alias("_rows"))
    starts = counts.select(group, "_stretch", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(group, "_stretch").orderBy(place, *then))
    return cut.withColumn("_inside", inside).join(starts, [group, "_stretch"]).withColumn(
        "n", F.col("_start") + F.col("_inside")
    ).drop("_stretch", "_start", "_inside")


def step_levels(steps: DataFrame) -> DataFrame:
    """(flow, name, level, placed). Steps that cannot be placed are numbered after
    the flow's highest level, in document order."""
    placed, rest = placed_levels(steps)
    top = placed.groupBy("flow").agg(F.max("level").alias("top"))
    last = numbered(rest, "flow", "pos").join(top, "flow", "left").select(
        "flow", "name", "pos", (F.coalesce("top", F.lit(0)) + F.col("n")).cast("bigint").alias("level"), F.lit(False).alias("placed")
    )
    return placed.withColumn("placed", F.lit(True)).unionByName(last)


def order_diff(steps: DataFrame, levels: DataFrame) -> DataFrame:
    """Given order beside optimal level of each step."""
    return steps.join(levels.select("flow", "name", "level").hint("merge"), ["flow", "name"]).select(
        "flow", "name", "pos", F.col("ord").alias("old_order"), F.col("level").alias("new_order"),
        (~F.col("ord").eqNullSafe(F.col("level"))).alias("changed"),
    )


def optimize_flows(documents: DataFrame, steps: DataFrame) -> DataFrame:
    """Documents with optimal step orders, steps sorted by (order, place); a flow
    with nothing to change, or without steps, keeps its document as it is.

    The new orders travel back as one small map per flow; the documents
    themselves are shuffled once, by flow.
    """
    diff = order_diff(steps, step_levels(steps))
    changes = diff.groupBy("flow").agg(
        F.bool_or("changed").alias("changed"),
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct("name", F.col("new_order").cast("int"))))).alias("orders"),
    )
    renumbered = F.transform(
        "document.steps",
        lambda s, i: F.struct(
            F.col("orders")[s["name"]].alias("o"), i.alias("i"), s.withField("order", F.col("orders")[s["name"]]).alias("s")
        ),
    )
    new_steps = F.transform(F.array_sort(renumbered), lambda x: x["s"])
    joined = documents.join(changes.hint("merge"), "flow", "left").withColumn("changed", F.coalesce("changed", F.lit(False)))
    return joined.withColumn(
        "document", F.when(F.col("changed"), F.col("document").withField("steps", new_steps)).otherwise(F.col("document"))
    ).drop("orders")


# Fixed value: the sentence of the suggestion.
FAN_OUT_TEXT = "Step '%s' feeds %d downstream steps. Consider splitting into intermediate temp views to enable more parallel execution of dependent branches."


def fan_out(steps: DataFrame, threshold: int = 3) -> DataFrame:
    """Steps with more than ``threshold`` distinct children."""
    detail = F.format_string(FAN_OUT_TEXT, F.col("parent"), F.col("children"))
    return (
        edges(steps).filter("known").groupBy("flow", "parent").agg(F.count("*").alias("children"))
        .filter(F.col("children") > threshold)
        .select("flow", F.col("parent").alias("step"), "children", detail.alias("detail"))
    )


def inherited(links: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts (flow, name, fact) carried from each step to all steps downstream.

    A round extends only what the round before it found new. The result holds
    (flow, step, fact), never pairs of steps, so its size is steps times facts
    that truly reach them. Cycles end it because facts are finite. ``links`` is
    read every round, so it should be a stored table.
    """
    links = links.select("flow", F.col("parent").alias("name"), "child")
    fresh = facts.select("flow", "name", "fact").distinct()
    known: list[DataFrame] = []
    while True:
        found = (
            fresh.join(links.hint("merge"), ["flow", "name"]).select("flow", F.col("child").alias("name"), "fact").distinct()
        )
        if known:
            found = found.join(_union(known).hint("merge"), ["flow", "name", "fact"], "left_anti")
        fresh = stored(found)
        known.append(fresh)
        if fresh.isEmpty():
            return _union(known)
