"""Connected components by alternating large and small stars.

Every edge is directed to the smaller node. A large star moves the larger neighbours of a node
to its smallest neighbour, a small star the smaller ones; both together reach one star per
component in a number of rounds that grows with the logarithm of its size. The minimum of a
node's neighbours is an aggregate that reduces before its shuffle, and a node with many
neighbours is joined, so a hot node is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("node", "near").union(edges.select(F.col("near").alias("node"), F.col("node").alias("near")))
    least = both.groupBy("node").agg(F.least("node", F.min("near")).alias("least"))
    larger = edges.select(F.col("near").alias("node"), F.col("node").alias("far"))
    return larger.join(least, "node").select(F.col("far").alias("node"), F.col("least").alias("near")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("node").agg(F.min("near").alias("least"))
    moved = edges.join(least, "node").select(F.col("near").alias("node"), F.col("least").alias("near"))
    kept = least.select("node", F.col("least").alias("near"))
    return moved.where(F.col("node") != F.col("near")).union(kept).distinct()


def _state(edges: DataFrame) -> tuple:
    # wide enough for a sum of 64-bit hashes
    total = F.sum(F.xxhash64("node", "near").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def components(pairs: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of the first two columns.

    Pairs may repeat, in either direction; a node paired with itself is ignored. Each round
    is written to the shared folder, so the lineage stays short.
    """
    a, b = (F.col(c) for c in pairs.columns[:2])
    edges = pairs.where(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("near")).distinct()
    edges = stored(edges)
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("near").alias("node"), F.col("near").alias("component")).distinct()
    return edges.select("node", F.col("near").alias("component")).union(roots)
