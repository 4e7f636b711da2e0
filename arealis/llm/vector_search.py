"""Nearest neighbours by vantage-point trees, one for every shard of the vectors.

A node keeps a vantage point and, for both children, the range of distances from it.  By the triangle
inequality no point of a child is nearer to a query than the query's distance to that range; a child is
left out when this bound times the relaxing factor exceeds the distance of the worst neighbour held.
Factor one restores exact search, larger factors visit fewer nodes.  Queries come in blocks, every block
meets every shard once, and the neighbours of the shards are merged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.llm.common import stored

NEIGHBOURS = 10
QUERY_STEP = 100
#: Vectors of a shard and queries of a block, on average.
SHARD = 4_096
BLOCK = 512
LEAF = 64
#: Factor one: exact.
RELAX = 1.0
#: Share of a distance that rounding may take from a bound.
SLACK = 1e-9


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, components summed in order."""
    out = np.zeros((len(queries), len(points)))
    for d in range(points.shape[1]):
        gap = queries[:, d, None] - points[None, :, d]
        out += gap * gap
    return np.sqrt(out)


@dataclass
class Tree:
    points: np.ndarray
    ids: np.ndarray
    leaf: int = LEAF
    nodes: list = field(default_factory=list)

    def __post_init__(self) -> None:
        self.root = self._build(np.arange(len(self.points)))

    def _build(self, rows: np.ndarray) -> int:
        if not len(rows):
            return -1
        at = len(self.nodes)
        self.nodes.append(None)
        if len(rows) <= self.leaf:
            self.nodes[at] = (rows,)
            return at
        # the row farthest from the first one spreads distances well
        apart = distances(self.points[rows[:1]], self.points[rows])[0]
        vantage, rest = rows[np.argmax(apart)], np.delete(rows, np.argmax(apart))
        d = distances(self.points[[vantage]], self.points[rest])[0]
        order = np.argsort(d, kind="stable")
        half = len(order) // 2
        parts = [
            (d[o].min(), d[o].max(), self._build(rest[o])) for o in (order[:half], order[half:])
        ]
        self.nodes[at] = (vantage, *parts)
        return at

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, relax: float):
        """Distances and ids of the k nearest points per query, nearest first, ties to smaller ids.

        ``own`` are the queries' ids, which are no answers.  Places without a point hold infinity.
        """
        best = np.full((len(queries), k), np.inf)
        names = np.full((len(queries), k), np.iinfo(np.int64).max)

        def offer(asked: np.ndarray, rows: np.ndarray, found: np.ndarray) -> None:
            found = np.where(self.ids[rows][None, :] == own[asked][:, None], np.inf, found)
            far = np.hstack([best[asked], found])
            who = np.hstack([names[asked], np.broadcast_to(self.ids[rows], found.shape)])
            who = np.where(np.isinf(far), np.iinfo(np.int64).max, who)
            order = np.lexsort((who, far), axis=1)[:, :k]
            best[asked] = np.take_along_axis(far, order, 1)
            names[asked] = np.take_along_axis(who, order, 1)

        def visit(at: int, asked: np.ndarray) -> None:
            if at < 0 or not len(asked):
                return
            node = self.nodes[at]
            if len(node) == 1:
                offer(asked, node[0], distances(queries[asked], self.points[node[0]]))
                return
            vantage, *children = node
            d = distances(queries[asked], self.points[[vantage]])[:, 0]
            offer(asked, np.array([vantage]), d[:, None])
            near = d <= children[0][1]
            for side, order in ((near, (0, 1)), (~near, (1, 0))):
                for c in order:
                    low, high, child = children[c]
                    bound = np.maximum(np.maximum(d[side] - high, low - d[side]), 0)
                    bound -= SLACK * (d[side] + high)
                    group = asked[side]
                    visit(child, group[bound * relax <= best[group, -1]])

        visit(self.root, np.arange(len(queries)))
        return best, names


def usable(column: str) -> Column:
    """Not null, not zero, all components present and finite."""
    x = F.col(column)
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return x.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(x, lambda v: v != 0)


def _searcher(k: int, relax: float):
    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(shard) and len(block):
            rows = shard.sort_values("vec_id", kind="stable")
            points = np.stack(rows["embedding"].to_numpy()).astype(float)
            ids = rows["vec_id"].to_numpy(np.int64)
            # exact repeats of a row are one candidate
            first = ~pd.DataFrame(np.column_stack([ids.view(float), points])).duplicated().to_numpy()
            queries = np.stack(block["embedding"].to_numpy()).astype(float)
            own = block["vec_id"].to_numpy(np.int64)
            best, names = Tree(points[first], ids[first]).search(queries, own, k, relax)
            held = np.isfinite(best)
            out = {
                "query_id": np.repeat(own, k)[held.ravel()],
                "vec_id": names[held],
                "score": best[held],
            }
        return pd.DataFrame(out)

    return search


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEIGHBOURS,
    relax: float = RELAX,
    shard_size: int = SHARD,
    block_size: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` for each row of ``queries``.

    Both have vec_id and embedding.  Vectors that are null, zero or hold a null or non-finite component,
    and rows without vec_id, take no part; vectors meet only vectors of their own length.  Exact repeats of
    a row are one candidate and one query; a vec_id with several vectors has one list over all of them.
    """

    def taken(df: DataFrame) -> DataFrame:
        return df.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("embedding").cast("array<double>").alias("embedding"),
        )

    points, asked = taken(vectors), taken(queries).dropDuplicates(["vec_id", "embedding"])
    shards, blocks = max(1, -(-points.count() // shard_size)), max(1, -(-asked.count() // block_size))
    length = F.size("embedding").alias("length")

    def dealt(df: DataFrame, name: str, n: int, other: str, m: int) -> DataFrame:
        return df.select(
            "vec_id",
            "embedding",
            length,
            F.pmod(F.xxhash64("vec_id"), F.lit(n)).alias(name),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))).alias(other),
        )

    keys = ["length", "shard", "block"]
    found = (
        dealt(points, "shard", shards, "block", blocks)
        .groupBy(*keys)
        .cogroup(dealt(asked, "block", blocks, "shard", shards).groupBy(*keys))
        .applyInPandas(_searcher(k, relax), "query_id long, vec_id long, score double")
    )
    place = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        stored(found, "nearest-shards")
        .withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_of_step(vectors: DataFrame, step: int = QUERY_STEP, **options) -> DataFrame:
    """Queries are the rows whose vec_id the step divides."""
    return nearest(vectors, vectors.where(F.col("vec_id") % step == 0), **options)
