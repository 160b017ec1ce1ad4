"""Exact top-k search by inner product with a forest of M-trees, best first.

Inner product is turned into distance: every vector gets one more component,
sqrt(M^2 - |x|^2) with M the greatest length of all, and queries get 0; then the
nearest vectors are those of greatest product. An M-tree holds vectors in pages.
A node has a pivot, a covering radius and its distance to the parent's pivot, and
a leaf entry its distance to the leaf's pivot. A search takes the node with the
best bound next and ends when no bound reaches the k-th best product so far; the
stored distances rule out children and entries by the triangle inequality before
their own distance is computed. Bounds are widened by a rounding margin, and
products are exact whole numbers, so results are exact.

Vectors are dealt to the nearest of sampled pivots. The vectors of a pivot are cut
by their distance from it into rings of about ``TREE_VECTORS``, and each ring is a
tree; only equal distances, such as copies, are dealt to several rings by a hash. A
query first searches the tree it lies in. Its k-th product there then rules out
rings by the pivot's distance, and it goes on to the trees that remain. One task
holds one tree and a bounded block of queries, and the queries of a block share one
best-first order: a page is read once for all that still need it.

Products of vectors with sums of squares from ``WIDE`` on are not exact in floating
point. Such vectors stay out of the trees; as queries and as candidates they are
compared in blocks, by whole numbers of any size.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowspark.llm.common import python_ready
from flowspark.session import cut_lineage

#: Sampled pivots at least and at most, vectors of a tree, entries of a leaf, children of an inner node.
PIVOTS, MOST_PIVOTS, TREE_VECTORS, LEAF, FANOUT = 16, 1024, 32_768, 1024, 12
#: Queries of a task's block, and of those that share one order.
BLOCK, SHARED_ORDER = 50_000, 512
#: Sums of squares below this have exact products.
WIDE = 2.0**50
#: Wide vectors of a block, and vectors that meet them.
WIDE_BLOCK, SCAN_BLOCK = 500, 20_000
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1
#: Distances are compared with this margin; products of whole numbers differ by one at least.
MARGIN = 1e-6
_NODE = (
    "tree long, node int, parent int, leaf boolean, pivot array<double>, radius double, parent_distance double, "
    "ids array<long>, vectors array<int>, distances array<double>"
)
_RESULT = "query_id long, v array<double>, vec_id long, score long"


def quantised(table: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v, wide, square): whole numbers floor(scale * x), the sum of their squares, and for those with one from
    ``WIDE`` on null in v and the scaled components in wide. Rows with a null id, a null vector, or a component
    that is null or, scaled, not finite are left out."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    good = F.forall("y", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    rows = table.filter(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("y")
    ).filter(F.coalesce(good, F.lit(False)))
    # a component below 2^25 is far from any overflow, so only others are told apart by the scaled values
    small = F.forall("y", lambda y: F.abs(y) < float(1 << 25))
    whole = F.when(small, F.transform("y", lambda y: F.floor(F.least(F.greatest(y, F.lit(-2.0**26)), F.lit(2.0**26))).cast("int")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.withColumn("v", whole).withColumn("square", square)
    narrow = F.coalesce(F.col("square") < WIDE, F.lit(False))
    return rows.select(
        "vec_id", F.when(narrow, F.col("v")).alias("v"), F.when(~narrow, F.col("y")).alias("wide"),
        F.when(narrow, F.col("square")).otherwise(float("inf")).alias("square"),
    )


def _lifted(v: np.ndarray, bound: float) -> np.ndarray:
    """Vectors with the component that makes all lengths equal."""
    rest = np.sqrt(np.maximum(0.0, bound - (v * v).sum(axis=1)))
    return np.concatenate([v, rest[:, None]], axis=1)


def _distances(rows: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    d = rows - pivot
    return np.sqrt((d * d).sum(axis=-1))


def build_tree(ids: np.ndarray, v: np.ndarray, bound: float) -> list[dict]:
    """Nodes of an M-tree; parents come before children.

    A node of too many vectors chooses far-apart pivots among them, deals the others to
    the nearest, and so on. Vectors that are all alike are cut by place.
    """
    rows = _lifted(v.astype(float), bound)
    nodes: list[dict] = []
    stack = [(np.arange(len(ids)), -1, rows[0])]
    while stack:
        member, parent, pivot = stack.pop()
        own = _distances(rows[member], pivot)
        node = {
            "node": len(nodes), "parent": parent, "leaf": len(member) <= LEAF, "pivot": pivot, "radius": float(own.max()),
            "parent_distance": float(_distances(nodes[parent]["pivot"][None], pivot)[0]) if parent >= 0 else 0.0,
            "ids": ids[:0], "vectors": v[:0], "distances": own[:0],
        }
        nodes.append(node)
        if node["leaf"]:
            node |= {"ids": ids[member], "vectors": v[member], "distances": own}
            continue
        if node["radius"] == 0:
            for k in range(0, len(member), LEAF):
                stack.append((member[k : k + LEAF], node["node"], pivot))
            continue
        nearest, which = own.copy(), np.zeros(len(member), int)
        chosen = [pivot]
        for k in range(1, FANOUT):
            far = int(nearest.argmax())
            if nearest[far] == 0:
                break
            chosen.append(rows[member[far]])
            d = _distances(rows[member], chosen[-1])
            which[d < nearest] = k
            nearest = np.minimum(nearest, d)
        for k, p in enumerate(chosen):
            part = member[which == k]
            if len(part):
                stack.append((part, node["node"], p))
    return nodes


class Tree:
    """An M-tree as read back from its pages."""

    def __init__(self, pages: pd.DataFrame, bound: float):
        pages = pages.sort_values("node")
        self.bound = bound
        self.pivot = np.stack([np.asarray(p, float) for p in pages["pivot"]])
        self.radius = pages["radius"].to_numpy() * (1 + MARGIN) + MARGIN
        self.parent_distance = pages["parent_distance"].to_numpy()
        self.leaf = pages["leaf"].to_numpy()
        dim = self.pivot.shape[1] - 1
        self.ids = [np.asarray(x, np.int64) for x in pages["ids"]]
        self.vectors = [np.asarray(x, float).reshape(len(i), dim) for x, i in zip(pages["vectors"], self.ids)]
        self.distances = [np.asarray(x, float) for x in pages["distances"]]
        parent = pages["parent"].to_numpy()
        self.children = [np.flatnonzero(parent == k) for k in range(len(parent))]

    def search(self, query: np.ndarray, own_id: int, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, products) of the k best entries with a product of at least ``least``."""
        ids, products = self.search_block(query[None], np.array([own_id]), k, np.array([least]))
        found = np.isfinite(products[0])
        return ids[0][found], products[0][found]

    def search_block(self, queries: np.ndarray, own_ids: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, products), a row per query: its k best entries with a product of at least its ``least``, best first;
        places without an entry have the product -inf.

        The node with the best bound for any query comes next, for all queries whose own bound still reaches it.
        """
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        energy = (queries * queries).sum(axis=1) + self.bound
        ids, products = np.zeros((len(q), k), np.int64), np.full((len(q), k), -np.inf)
        kth = np.array(least, float)

        def reach(rows: np.ndarray) -> np.ndarray:
            """Greatest distance of entries with the k-th product."""
            return np.sqrt(np.maximum(0.0, energy[rows] - 2 * (kth[rows] - 0.5))) * (1 + MARGIN)

        limit = reach(np.arange(len(q)))
        d = _distances(q, self.pivot[0])
        waiting = {0: (np.arange(len(q)), d)}
        heap = [(max(0.0, float((d - self.radius[0]).min())), 0)]
        while heap:
            low, node = heapq.heappop(heap)
            rows, d = waiting.pop(node)
            if low > limit.max():
                break
            live = d - self.radius[node] <= limit[rows]
            rows, d = rows[live], d[live]
            if not len(rows):
                continue
            slack = limit[rows] + MARGIN * (1 + d)
            if self.leaf[node]:
                near = np.flatnonzero((np.abs(d[:, None] - self.distances[node]) <= slack[:, None]).any(axis=0))
                here = self.ids[node][near]
                found = queries[rows] @ self.vectors[node][near].T
                keep = (found >= kth[rows][:, None]) & (here != own_ids[rows][:, None])
                for at in np.flatnonzero(keep.any(axis=1)):
                    row = rows[at]
                    new_ids = np.append(ids[row], here[keep[at]])
                    new = np.append(products[row], found[at][keep[at]])
                    best = np.lexsort((new_ids, -new))[:k]
                    ids[row], products[row] = new_ids[best], new[best]
                    kth[row] = max(kth[row], products[row, -1])
                limit[rows] = reach(rows)
                continue
            for c in self.children[node]:
                able = np.abs(d - self.parent_distance[c]) - self.radius[c] <= slack
                if able.any():
                    away = _distances(q[rows[able]], self.pivot[c])
                    near = away - self.radius[c] <= limit[rows[able]]
                    if near.any():
                        waiting[c] = (rows[able][near], away[near])
                        heapq.heappush(heap, (max(0.0, float(away[near].min() - self.radius[c])), int(c)))
        return ids, products


def scan(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, v, vec_id, score): each query's k best candidates of each block, by whole numbers of any size.

    Both hold (vec_id, y, dim), y the scaled components; scores beyond 64 bits are the ends of their range.
    """
    sides = []
    for rows, size in ((queries, WIDE_BLOCK), (candidates, SCAN_BLOCK)):
        sides.append((rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "y"), F.lit(max(1, -(-rows.count() // size)))))))
    counts = [x.agg(F.coalesce(F.max("part"), F.lit(0)) + 1).first()[0] for x in sides]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
    asked = sides[0].withColumnRenamed("part", "block").withColumn("part", every(counts[1]))
    held = sides[1].withColumn("block", every(counts[0]))

    def compare(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        whole = lambda y: np.array([math.floor(x) for x in y], object)
        ids, vectors = held["vec_id"].to_numpy(), [whole(y) for y in held["y"]]
        out = []
        for own, y in zip(asked["vec_id"], asked["y"]):
            q = whole(y)
            scores = [(-min(GREATEST, max(LEAST, int(q @ v) if len(v) else 0)), int(i)) for i, v in zip(ids, vectors) if i != own and len(v) == len(q)]
            out += [(own, y, i, -s) for s, i in heapq.nsmallest(k, scores)]
        return pd.DataFrame(out, columns=["query_id", "v", "vec_id", "score"])

    return asked.groupBy("block", "part").cogroup(held.groupBy("block", "part")).applyInPandas(compare, _RESULT)


def top_k(table: DataFrame, every: int = 50, k: int = 5, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` its k best others.

    Score is the inner product of the whole-number vectors; ties go to the smaller vec_id; rank
    counts from 1. Vectors left out by ``quantised`` take no part. Only vectors of one length
    are compared. Rows of one vec_id are never each other's candidates; queries of equal id and vector
    are one, and other repeated rows are candidates each. A query with fewer than k
    candidates gets them all; an empty table gives an empty result. Every finite vector takes part; scores beyond 64
    bits are the ends of their range and tie there.
    """
    spark = table.sparkSession
    python_ready(spark)
    every_row = cut_lineage(quantised(table, vector, scale).withColumns({
        "dim": F.size(F.coalesce(F.col("v").cast("array<double>"), "wide")), "row": F.monotonically_increasing_id(),
    }))
    base = every_row.filter("v IS NOT NULL").select("vec_id", "v", "dim", "row", "square")
    bound, n, rows = every_row.agg(F.max(F.when(F.col("square") < WIDE, F.col("square"))), F.count("v"), F.count("*")).first()
    results = _search(base, bound, n, every, k) if n else spark.createDataFrame([], _RESULT)
    if n < rows:
        both = every_row.select("vec_id", F.coalesce("wide", F.col("v").cast("array<double>")).alias("y"), "dim", F.col("wide").isNotNull().alias("__wide"))
        asked = both.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "y"])
        wide = both.filter("__wide").drop("__wide")
        results = results.unionByName(scan(asked.drop("__wide"), wide, k)).unionByName(
            scan(asked.filter("__wide").drop("__wide"), both.filter("NOT __wide").drop("__wide"), k)
        )
    best = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "vec_id")
    return results.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(base: DataFrame, bound: float, n: int, every: int, k: int) -> DataFrame:
    """(query_id, v, vec_id, score): at least the k best of each query, from trees over ``n`` stored vectors."""
    spark = base.sparkSession
    wanted = max(PIVOTS, min(MOST_PIVOTS, 2 * n // TREE_VECTORS))
    # at most MOST_PIVOTS rows
    sample = [r["v"] for r in base.select("v", F.xxhash64("v", "vec_id").alias("h")).orderBy("h").limit(wanted).collect()]
    pivots = {d: _lifted(np.array([v for v in sample if len(v) == d], float), bound) for d in {len(v) for v in sample}}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            part, away = np.full(len(dims), -1, np.int32), np.zeros(len(dims))
            for d, some in pivots.items():
                rows = np.flatnonzero(dims == d)
                if len(rows):
                    v = batch.column(1).take(pa.array(rows)).flatten().to_numpy().astype(float).reshape(len(rows), d)
                    lifted, nearest = _lifted(v, bound), np.full(len(rows), np.inf)
                    for number, pivot in enumerate(some):
                        own = _distances(lifted, pivot)
                        part[rows[own < nearest]] = number
                        nearest = np.minimum(nearest, own)
                    away[rows] = nearest
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(away)], names=["vec_id", "v", "dim", "row", "part", "away"])

    dealt = cut_lineage(base.select("vec_id", "v", "dim", "row").mapInArrow(
        deal, "vec_id long, v array<int>, dim int, row long, part int, away double"
    ))
    # one row per pivot and length, then one per tree
    sizes = dealt.groupBy("dim", "part").agg(F.count("*").alias("n")).collect()
    grid = max(-(-r["n"] // TREE_VECTORS) for r in sizes)
    quantiles = F.percentile_approx("away", [i / grid for i in range(1, grid)]) if grid > 1 else F.lit(None).cast("array<double>")
    first, places = 0, []
    for r in dealt.groupBy("dim", "part").agg(F.count("*").alias("n"), quantiles.alias("cuts")).orderBy("dim", "part").collect():
        trees = -(-r["n"] // TREE_VECTORS)
        cuts = [float(r["cuts"][max(0, -(-i * grid // trees) - 1)]) for i in range(1, trees)]
        places.append((r["dim"], r["part"], first, cuts))
        first += trees
    placed_at = spark.createDataFrame(places, "dim int, part int, first long, cuts array<double>")
    # a vector's ring; equal distances that fill several rings are dealt to them by a hash
    below = F.size(F.filter("cuts", lambda c: c < F.col("away")))
    same = F.size(F.filter("cuts", lambda c: c == F.col("away")))
    placed = cut_lineage(dealt.join(F.broadcast(placed_at), ["dim", "part"]).select(
        "vec_id", "v", "dim", "part", "away", (F.col("first") + below + F.pmod(F.xxhash64("row"), same + 1)).alias("tree")
    ))
    rings = placed.groupBy("tree").agg(
        F.first("dim").alias("dim"), F.first("part").alias("part"), F.min("away").alias("low"), F.max("away").alias("high")
    ).orderBy("tree").toPandas()
    placed = placed.select("vec_id", "v", "tree")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id", kind="stable")
        v = np.stack(rows["v"].to_numpy()).astype(np.int32)
        nodes = pd.DataFrame(build_tree(rows["vec_id"].to_numpy(), v, bound))
        nodes.insert(0, "tree", int(rows["tree"].iloc[0]))
        nodes["vectors"] = [x.ravel() for x in nodes["vectors"]]
        return nodes[["tree", "node", "parent", "leaf", "pivot", "radius", "parent_distance", "ids", "vectors", "distances"]]

    pages = cut_lineage(placed.groupBy("tree").applyInPandas(build, _NODE))
    queries = cut_lineage(placed.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "v").agg(F.min("tree").alias("tree")))

    def searched(pages: pd.DataFrame, asked: pd.DataFrame, least: np.ndarray) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        tree = Tree(pages, bound)
        own = asked["vec_id"].to_numpy()
        for at in range(0, len(asked), SHARED_ORDER):
            some = slice(at, at + SHARED_ORDER)
            v = np.stack(asked["v"].to_numpy()[some]).astype(float)
            yield some, *tree.search_block(v, own[some], k, least[some])

    def seed(pages: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        least = np.full(len(asked), -np.inf)
        if len(asked):
            for some, _, products in searched(pages, asked, least.copy()):
                least[some] = products[:, -1]
        return pd.DataFrame({"vec_id": asked["vec_id"], "v": asked["v"], "least": least})

    seeded = cut_lineage(
        pages.groupBy("tree").cogroup(queries.groupBy("tree")).applyInPandas(seed, "vec_id long, v array<int>, least double")
    )
    blocks = max(1, -(-seeded.count() // BLOCK))
    ring_of = {d: some[["tree", "part", "low", "high"]].to_numpy() for d, some in rings.groupby("dim")}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SHARED_ORDER):
                batch = whole.slice(start, SHARED_ORDER)
                least, dims = batch.column(2).to_numpy(), batch.column(1).value_lengths().to_numpy()
                index, trees = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for d in np.unique(dims):
                    rows = np.flatnonzero(dims == d)
                    v = batch.column(1).take(pa.array(rows)).flatten().to_numpy().astype(float).reshape(len(rows), d)
                    reach = np.sqrt(np.maximum(0.0, (v * v).sum(axis=1) + bound - 2 * (least[rows] - 0.5))) * (1 + MARGIN)
                    lifted = np.concatenate([v, np.zeros((len(v), 1))], axis=1)
                    away: dict[int, np.ndarray] = {}
                    for tree, part, low, high in ring_of[d]:
                        if part >= 0:
                            if part not in away:
                                away[part] = _distances(lifted, pivots[d][int(part)])
                            far = np.maximum(low - away[part], away[part] - high)
                            near = np.flatnonzero(far <= reach + MARGIN * (1 + away[part] + high))
                        else:
                            near = np.arange(len(rows))
                        index.append(rows[near])
                        trees.append(np.full(len(near), int(tree)))
                at, tree = np.concatenate(index), np.concatenate(trees)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in batch.columns), pa.array(tree)], names=["vec_id", "v", "least", "tree"])

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    asked = seeded.mapInArrow(spread, "vec_id long, v array<int>, least double, tree long").withColumn("block", block)
    copies = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def answer(pages: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        for some, ids, products in searched(pages, asked, asked["least"].to_numpy(float)) if len(asked) else ():
            row, place = np.nonzero(np.isfinite(products))
            out.append(pd.DataFrame({
                "query_id": asked["vec_id"].to_numpy()[some][row], "v": asked["v"].to_numpy()[some][row],
                "vec_id": ids[row, place], "score": products[row, place].astype(np.int64),
            }))
        return pd.concat(out) if out else pd.DataFrame([], columns=["query_id", "v", "vec_id", "score"], dtype=object)

    return copies.groupBy("tree", "block").cogroup(asked.groupBy("tree", "block")).applyInPandas(
        answer, "query_id long, v array<int>, vec_id long, score long"
    ).withColumn("v", F.col("v").cast("array<double>"))
