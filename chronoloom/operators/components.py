"""Connected components of an edge table by local contraction and alternating star contractions.

First each task replaces the edges it holds, a bounded chunk at a time, by stars
around the least node they connect; small tables are done by that. What chunks
share is joined in rounds, each two groupings with a minimum (partial
aggregation, so a hub costs no more than any other node) and two joins that
adaptive execution can split when a hub is hot. No node's neighbourhood is ever
gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronoloom.sources.shared import drop_shared, materialize

#: Edges that a task contracts at once.
CHUNK = 1 << 20


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of the nodes 0 to n - 1 the least node that the edges ``(a, b)`` reach."""
    root = np.arange(n)
    while len(a):
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while ((up := root[root]) != root).any():
            root = up
    return root


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        both = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in (0, 1)]
        nodes, at = np.unique(np.concatenate(both), return_inverse=True)
        root = least_reachable(len(nodes), at[: len(both[0])], at[len(both[0]) :])
        u = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[u], pa.int64()), pa.array(nodes[root[u]], pa.int64())], names=["u", "v"])

    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= CHUNK:
            yield stars(held)
            held, size = [], 0
    if held:
        yield stars(held)


def _contracted(edges: DataFrame) -> DataFrame:
    return materialize(edges.mapInArrow(_contract, "u long, v long"), "edges")


def contracted_near(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Edges ``(u, v)`` that join the same nodes, fewer where most are joined under equal ``keys``: a task contracts those that it holds."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.repartition(parts, *keys).sortWithinPartitions(*keys).select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(_contract, "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("n")).select("u", F.least("u", "n").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node is either the centre of a star or names one centre."""
    none = F.lit(None).cast("long")
    ends = edges.select(F.col("u").alias("node"), "v", F.lit(0).alias("centre")).union(edges.select(F.col("v").alias("node"), none.alias("v"), F.lit(1).alias("centre")))
    seen = ends.groupBy("node").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.max("centre").alias("centre"))
    return seen.filter("lo < hi or (lo is not null and centre = 1)").isEmpty()


def connected_components(edges: DataFrame, src: str = "u", dst: str = "v", max_rounds: int = 100) -> DataFrame:
    """Return ``(node, component)`` for all nodes on an edge; component = smallest node reachable.

    Nodes are whole numbers. Loops and repeated or reversed edges are ignored;
    null ends drop out; an empty edge table gives an empty result. Nodes without
    edges aren't listed. Rounds grow with the logarithm of the longest path; if
    ``max_rounds`` isn't enough, this raises.
    """
    e = edges.select(F.greatest(src, dst).cast("long").alias("u"), F.least(src, dst).cast("long").alias("v")).filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).filter("u > v").distinct()
    e = _contracted(e)
    for _ in range(max_rounds):
        if _are_stars(e):
            stars = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
            return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        new = _contracted(_small_star(_large_star(e)).distinct())
        drop_shared(e)
        e = new
    raise RuntimeError(f"components unfinished after {max_rounds} rounds")
