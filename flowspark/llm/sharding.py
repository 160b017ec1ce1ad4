"""Sharding by balanced label propagation over groups of equal texts.

Documents of one text are linked; a link is cut where its ends lie in different
shards. Documents of one text in one shard are alike to the rule, so the state is
a row per text with its documents per shard and not one row per document, and a group that
holds a third of all rows is one row of 40 entries.

Shards have fixed quotas of rows, at most one apart. A round lets every part of a
group move to the shard in which the group is strongest among those with room:
moves between two shards against each other are exchanged, further ones fill free
places. Documents without a copy have no links; they fill what is left at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import unit_interval, without
from flowspark.session import cut_lineage

OUTPUT = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
SLICE_ROWS = 256
#: Slices whose sums meet in one task, and whose total goes on as one row.
BLOCK_SLICES = 4096
#: A text with at least one in so many of all rows is hot; so many texts can be at most.
HOT_TEXTS = 1000


def slices_of(rows: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(rows / SLICE_ROWS)).cast("long")


def slice_starts(sums: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """(keys, __slice, ``out``): the sum of ``value`` before each slice of a key, from (keys, __slice, ``value``).

    In two levels: within blocks of slices, and over the totals of the blocks.
    """
    cut = sums.withColumn("__block", F.floor(F.col("__slice") / BLOCK_SLICES))
    rows = (Window.unboundedPreceding, -1)
    totals = cut.groupBy(*keys, "__block").agg(F.sum(value).alias("__total"))
    before = F.coalesce(F.sum("__total").over(Window.partitionBy(*keys).orderBy("__block").rowsBetween(*rows)), F.lit(0))
    inside = F.coalesce(F.sum(value).over(Window.partitionBy(*keys, "__block").orderBy("__slice").rowsBetween(*rows)), F.lit(0))
    return cut.withColumn("__in_block", inside).join(totals.withColumn("__before", before), [*keys, "__block"]).select(
        *keys, "__slice", (F.col("__before") + F.col("__in_block")).alias(out)
    )


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Add ``out``: 0, 1, ... within ``keys``, by the column ``__slice`` and then ``order``.

    ``__slice`` cuts a key into parts of bounded size; only the counts of blocks of parts
    meet per key, so a key with a third of all rows is numbered in parallel.
    """
    starts = slice_starts(df.groupBy(*keys, "__slice").agg(F.count("*").alias("__rows")), keys, "__rows", "__start")
    inside = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy(*order)) - 1
    return df.withColumn("__inside", inside).join(starts, [*keys, "__slice"]).withColumn(
        out, F.col("__start") + F.col("__inside")
    ).drop("__start", "__inside")


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard; the first ones take one more where it doesn't divide."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _wishes(room: list[int] | None, turn: int, seed: int) -> tuple[Column, Column]:
    """(best, moves) of a row (text_key, parts): the strongest part, among those of shards with room where ``room`` is
    given, and an entry (shard, docs, to, gain) per part; to and gain are null for parts that stay."""
    tie = lambda p: F.xxhash64(F.lit(seed + turn // 2), "text_key", p["shard"])
    open_ = F.col("parts") if room is None else F.filter("parts", lambda p: _at(room, "long", p["shard"]) > 0)
    best = F.array_max(F.transform(open_, lambda p: F.struct(p["docs"].alias("docs"), tie(p).alias("tie"), p["shard"].alias("to"))))

    def move(p: Column) -> Column:
        wants = (F.struct(p["docs"].alias("docs"), tie(p).alias("tie")) < F.struct("best.docs", "best.tie")) & F.col("best").isNotNull()
        return F.struct(
            p["shard"].alias("shard"), p["docs"].alias("docs"), F.when(wants, F.col("best.to")).alias("to"),
            F.when(wants, F.col("best.docs") - p["docs"]).alias("gain"),
        )

    return best, F.transform("parts", move)


def _at(values: list, kind: str, index: Column) -> Column:
    """The value at an index from 0 of a list that the plan holds as one literal."""
    return F.element_at(F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>"), (index + 1).cast("int"))


def _allowed(asked: dict[tuple[int, int], int], free: list[int], shards: int) -> dict[tuple[int, int], int]:
    """How many of the documents asked to move per pair of shards may: exchanges, and what free places take."""
    allowed = {k: min(v, asked.get(k[::-1], 0)) for k, v in asked.items()}
    for j in range(shards):
        rest = {k: v - allowed[k] for k, v in asked.items() if k[1] == j and v > allowed[k]}
        total, left = sum(rest.values()), max(0, free[j])
        for k, v in sorted(rest.items()):
            take = min(v, left, -(-free[j] * v // total) if total > free[j] else v)
            allowed[k] += take
            left -= take
    return allowed


def _cuts(moves: DataFrame, asked: dict[tuple[int, int], dict[int, int]], allowed: dict[tuple[int, int], int], slices: int) -> dict[tuple[int, int], tuple[int, str, int]]:
    """Per pair of shards that not all may pass: the slice and text at which its limit is reached, and what that text still moves.

    The levels' sums tell the level, those of its slices the slice; only the rows of such slices are put in order.
    """
    found = {}
    for k, by_level in asked.items():
        left = allowed[k]
        if 0 < left < sum(by_level.values()):
            for level in sorted(by_level, reverse=True):
                if left <= by_level[level]:
                    found[k] = ((64 - level) * slices, left)
                    break
                left -= by_level[level]
    if not found:
        return {}
    # at most one row per pair of shards and one literal per pair
    limits = moves.sparkSession.createDataFrame([(*k, *v) for k, v in found.items()], "shard int, to int, first long, left long")
    rows = moves.join(F.broadcast(limits), ["shard", "to"]).filter(F.floor(F.col("__slice") / slices) * slices == F.col("first"))
    upto = (Window.unboundedPreceding, -1)
    if slices > 1:
        sums = rows.groupBy("shard", "to", "__slice", "left").agg(F.sum("docs").alias("d")).withColumn(
            "start", F.coalesce(F.sum("d").over(Window.partitionBy("shard", "to").orderBy("__slice").rowsBetween(*upto)), F.lit(0))
        )
        reached = sums.filter("start < left AND left <= start + d").selectExpr("shard", "to", "__slice", "left - start AS left").collect()
        limits = moves.sparkSession.createDataFrame([tuple(r) for r in reached], "shard int, to int, __slice long, left long")
        rows = moves.join(F.broadcast(limits), ["shard", "to", "__slice"])
    ahead = F.coalesce(F.sum("docs").over(Window.partitionBy("shard", "to", "__slice").orderBy("text_key").rowsBetween(*upto)), F.lit(0))
    last = rows.withColumn("left", F.col("left") - ahead).filter("0 < left AND left <= docs")
    return {(r["shard"], r["to"]): (r["__slice"], r["text_key"], r["left"]) for r in last.select("shard", "to", "__slice", "text_key", "left").collect()}


def propagated(groups: DataFrame, rows: int, shards: int, rounds: int, seed: int) -> tuple[DataFrame, dict[int, int]]:
    """(text_key, n, parts) from (text_key, n), n at least 2, and the documents per shard; parts are entries (shard, docs).

    At the start the documents of all groups are dealt round robin, which is within
    the quotas. Every move goes to a stronger part of the group (ties by a hash),
    so the kept links only grow. ``rounds`` bounds the rounds; they end earlier
    when none of the parts wants to move. A text's parts lie in one row, so a round moves no
    row: only sums per pair of shards and level, and the places where limits are reached, come to the driver.
    """
    quota = quotas(rows, shards)
    ordered = groups.withColumn("__slice", F.floor(unit_interval(F.xxhash64(F.lit(seed), "text_key")) * slices_of(F.lit(groups.count()))))
    starts = slice_starts(ordered.groupBy("__slice").agg(F.sum("n").alias("__n")), [], "__n", "__start")
    inside = Window.partitionBy("__slice").orderBy("text_key").rowsBetween(Window.unboundedPreceding, -1)
    first = ordered.withColumn("__in", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(starts, "__slice")
    offset = (F.col("__start") + F.col("__in")) % shards
    dealt = F.transform(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(shards)).cast("int") - 1), lambda j: F.struct(
        ((F.col("o") + j) % shards).cast("int").alias("shard"),
        F.floor((F.col("n") - 1 - j) / shards + 1).cast("long").alias("docs"),
    ))
    state = cut_lineage(first.select("text_key", "n", offset.alias("o")).select("text_key", "n", dealt.alias("parts")))
    held = {r["shard"]: r["docs"] for r in state.select(F.inline("parts")).groupBy("shard").agg(F.sum("docs").alias("docs")).collect()}
    for turn in range(rounds):
        free = [quota[s] - held.get(s, 0) for s in range(shards)]
        # a full shard can still take part in exchanges in even rounds
        best, wish = _wishes(free if turn % 2 else None, turn, seed)
        wishes = state.withColumn("best", best).withColumn("moves", wish)
        moves = wishes.select("text_key", F.inline("moves")).withColumn("level", F.floor(F.log2(F.col("gain") + 1)).cast("int"))
        count, levels = 0, {}
        for r in moves.groupBy("shard", "to", "level").agg(F.sum("docs").alias("docs"), F.count("*").alias("n")).collect():
            count += r["n"]
            if r["to"] is not None:
                levels.setdefault((r["shard"], r["to"]), {})[r["level"]] = r["docs"]
        if not levels:
            break
        allowed = _allowed({k: sum(v.values()) for k, v in levels.items()}, free, shards)
        if not any(allowed.values()):
            if turn % 2:
                break
            continue
        # the greatest gains go first; equal gains by hash, in slices whose sums decide
        slices = max(1, -(-(count // (shards * shards) + 1) // SLICE_ROWS))
        place = lambda level: (64 - level) * slices + F.floor(unit_interval(F.xxhash64(F.lit(turn), "text_key")) * slices)
        cuts = _cuts(moves.filter("to IS NOT NULL").withColumn("__slice", place(F.col("level"))), levels, allowed, slices)
        # all of a pair go where none is cut; a slice before all others lets none go
        every = {k: (1 << 62, "", 0) for k, v in allowed.items() if v and k not in cuts} | cuts
        at = [every.get((i, j), (-1, "", 0)) for i in range(shards) for j in range(shards)]

        def gone(m: Column) -> Column:
            pair, own = m["shard"] * shards + m["to"], place(F.floor(F.log2(m["gain"] + 1)).cast("int"))
            slice_, key = _at([x[0] for x in at], "long", pair), _at([x[1] for x in at], "string", pair)
            left = F.when(F.col("text_key") == key, _at([x[2] for x in at], "long", pair)).when(F.col("text_key") < key, m["docs"])
            return F.coalesce(F.when(own < slice_, m["docs"]).when(own == slice_, left), F.lit(0).cast("long"))

        went = F.transform("moves", lambda m: F.struct(m["shard"].alias("shard"), m["docs"].alias("docs"), gone(m).alias("go")))
        came = F.aggregate("went", F.lit(0).cast("long"), lambda a, m: a + m["go"])
        after = F.transform("went", lambda m: F.struct(
            m["shard"].alias("shard"),
            (m["docs"] - m["go"] + F.when(m["shard"] == F.col("best.to"), F.col("came")).otherwise(0)).alias("docs"),
        ))
        state = cut_lineage(wishes.withColumn("went", went).withColumn("came", came).select(
            "text_key", "n", F.filter(after, lambda p: p["docs"] > 0).alias("parts")
        ))
        for (i, j), v in allowed.items():
            held[i] -= v
            held[j] += v
    return state, held


def propagate(groups: DataFrame, rows: int, shards: int, rounds: int, seed: int) -> DataFrame:
    """(text_key, shard, docs): the parts of :func:`propagated`, a row each."""
    return propagated(groups, rows, shards, rounds, seed)[0].select("text_key", F.inline("parts"))


def _with_groups(slim: DataFrame, grouped: DataFrame, rows: int) -> DataFrame:
    """``slim`` with the columns of its text's group, nulls for rows without one.

    Hot texts are at most ``HOT_TEXTS``, by their share of all rows, so those are sent to the rows.
    Null texts have no group. All others meet their group by the text.
    """
    heavy = F.col("__n") * HOT_TEXTS >= rows
    known = slim.join(F.broadcast(grouped.filter(heavy)), "__key", "left")
    settled = F.col("__n").isNotNull() | F.col("__key").isNull()
    others = known.filter(~settled).drop("__n", "__parts").join(grouped.filter(~heavy), "__key", "left")
    return known.filter(settled).unionByName(others)


def shard(
    docs: DataFrame, shards: int = 40, rounds: int = 10, seed: int = 29, text: str = "text", doc_id: str = "doc_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` with size, text_crc32, law ``rows``, shard, slot and grown_shard (null
    under this law).

    Shards differ by one row at most, whatever the groups. A null text has size 16,
    checksum 0 and no group; empty texts are equal texts. Repeated rows are
    documents like others and get slots of their own. An empty table gives an
    empty result. Columns named as the results are replaced. The texts are read once: what is kept
    and their digests are stored.
    """
    base = without(docs, OUTPUT)
    names = list(keep or base.columns)
    slim = cut_lineage(base.select(
        *[F.col(f"`{c}`") for c in names], (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 16).alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).cast("long").alias("text_crc32"), F.md5(text).alias("__key"),
        F.xxhash64(F.lit(seed), doc_id, text).alias("__h"), F.col(doc_id).alias("__id"),
    ))
    groups = cut_lineage(
        slim.filter("__key IS NOT NULL").groupBy(F.col("__key").alias("text_key")).agg(F.count("*").alias("n")).filter("n > 1")
    )
    rows = slim.count()
    state, held = propagated(groups, rows, shards, rounds, seed)
    # the shards of a group as ranges of its members' numbers; at most ``shards`` entries
    grouped = state.select(F.col("text_key").alias("__key"), F.col("n").alias("__n"), F.array_sort("parts").alias("__parts"))
    joined = cut_lineage(_with_groups(slim, grouped, rows))
    linked = joined.filter("__n IS NOT NULL").withColumn("__slice", F.floor(unit_interval(F.col("__h")) * slices_of(F.col("__n"))))
    linked = numbered(linked, ["__key"], ["__h", "__id"], "__k")
    ends = F.transform(
        F.sequence(F.lit(1), F.size("__parts")),
        lambda i: F.aggregate(F.slice("__parts", 1, i), F.lit(0).cast("long"), lambda a, p: a + p["docs"]),
    )
    at = F.size(F.filter(ends, lambda e: e <= F.col("__k")))
    linked = linked.withColumn("shard", F.element_at("__parts", at + 1)["shard"])

    upto, total = [], 0
    for s, q in enumerate(quotas(rows, shards)):
        total += q - held.get(s, 0)
        upto.append(total)
    singles = joined.filter("__n IS NULL").withColumn(
        "__slice", F.floor(unit_interval(F.col("__h")) * slices_of(F.lit(rows)))
    )
    singles = numbered(singles, [], ["__h", "__id"], "__k")
    bounds = F.array(*[F.lit(int(x)) for x in upto])
    singles = singles.withColumn("shard", F.size(F.filter(bounds, lambda e: e <= F.col("__k"))).cast("int"))

    placed = cut_lineage(linked.unionByName(singles).drop("__parts", "__k", "__n", "__key", "__slice")).withColumn(
        "__slice", F.floor(unit_interval(F.col("__h")) * slices_of(F.lit(rows / shards)))
    )
    return numbered(placed, ["shard"], ["__h", "__id"], "slot").select(
        *[F.col(f"`{c}`") for c in names], "size", "text_crc32", F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
