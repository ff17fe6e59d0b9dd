"""Exact top-k inner products by a dual-tree search over cover trees.

Candidates and queries lie in blocks of bounded size. For a pair of blocks both get a cover
tree, and pairs of nodes are searched together: the inner product of any two of their points
is at most that of the centres plus what the covering radii add, and a pair of nodes is left
out if that is below the worst k-th score of the query group. The best of each block are
merged per query. Scores are whole numbers and exact; only pairs that cannot enter a list are
left out.

Nulls and edges: vectors that are null, empty, or hold null or non-finite components take no
part; vectors of each length are searched among themselves; components of any size count, in
integers as long as needed, and a score beyond 64 bits is ranked as a double and given as the
nearest that has 64 (a component whose scaled value is no double takes no part); ties go to the smaller id; rows with the query's own id are no candidates; rows with equal ids
and vectors are separate candidates; fewer candidates than k give shorter lists; other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers, stored

#: Candidates and queries in a block.
BLOCK, QUERIES = 4096, 1024
#: Nodes of so few points are not divided further.
LEAF = 24
_WORD = 2.0**63


@dataclass
class Node:
    """A centre, the radius that covers all points below it, and the points or nodes below.

    Points which are alone at their scale hang directly on the node they were divided from.
    """

    centre: np.ndarray
    radius: float
    points: np.ndarray
    children: list[Node] = field(default_factory=list)

    @property
    def norm(self) -> float:
        return float(np.sqrt(self.centre @ self.centre))


def build(vectors: np.ndarray, points: np.ndarray, centre: int | None = None, scale: float | None = None) -> Node:
    """A cover tree over the chosen rows.

    At each scale a node keeps its centre and takes points further away than the scale as new
    centres, each of which covers the points within the scale.
    """
    centre = int(points[0]) if centre is None else centre
    gaps = np.sqrt(((vectors[points] - vectors[centre]) ** 2).sum(axis=1))
    radius = float(gaps.max())
    node = Node(vectors[centre], radius, points)
    if len(points) <= LEAF or radius == 0:
        return node
    scale = 2.0 ** np.floor(np.log2(radius)) if scale is None else scale
    while scale >= radius:
        scale /= 2
    alone, left = [], points[gaps > scale]
    groups = [(centre, points[gaps <= scale])]
    while len(left):
        own = int(left[0])
        near = ((vectors[left] - vectors[own]) ** 2).sum(axis=1) <= scale * scale
        groups.append((own, left[near]))
        left = left[~near]
    for own, covered in groups:
        if len(covered) == 1:
            alone.append(int(covered[0]))
        else:
            node.children.append(build(vectors, covered, own, scale / 2))
    node.points = np.array(alone, np.int64)
    return node


class Search:
    """Lists of the k best candidates of each query, filled by node pairs."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int):
        largest = max(np.abs(queries).max(initial=0), np.abs(data).max(initial=0))
        # doubles hold the sums exactly below 2 ** 53, words below 2 ** 63
        most = largest * largest * data.shape[1]
        kind = np.float64 if most < 2.0**53 else np.int64 if most < _WORD / 2 else object
        self.queries, self.data = _whole(queries, kind), _whole(data, kind)
        self.kind = object if kind is object else np.int64
        self.query_ids, self.ids, self.k = query_ids, ids, k
        self.query_norms = np.sqrt((queries**2).sum(axis=1))
        self.best = [np.empty((0, 2), self.kind)] * len(queries)
        self.worst = np.full(len(queries), -np.inf)
        self.compared = 0

    def run(self) -> None:
        queries, data = self.queries.astype(float), self.data.astype(float)
        query_root = build(queries, np.arange(len(queries)))
        self.pair(query_root, build(data, np.arange(len(data))))

    def _compare(self, queries: np.ndarray, points: np.ndarray) -> None:
        scores = self.queries[queries] @ self.data[points].T
        self.compared += scores.size
        for row, query in zip(scores, queries, strict=True):
            # in doubles on both sides: rounding keeps the order
            enters = (row.astype(float) >= self.worst[query]) & (self.ids[points] != self.query_ids[query])
            if not enters.any():
                continue
            new = np.column_stack([row[enters].astype(self.kind), self.ids[points[enters]]])
            merged = np.concatenate([self.best[query], new])
            if self.kind is object:
                order = sorted(range(len(merged)), key=lambda i: (-merged[i, 0], merged[i, 1]))
            else:
                order = np.lexsort((merged[:, 1], -merged[:, 0]))
            merged = merged[order][: self.k]
            self.best[query] = merged
            if len(merged) == self.k:
                self.worst[query] = merged[-1, 0]

    def _below(self, node: Node) -> np.ndarray:
        """All queries below a node."""
        return np.concatenate([node.points, *(self._below(c) for c in node.children)]) if node.children else node.points

    def pair(self, group: Node, node: Node) -> None:
        bound = group.centre @ node.centre + group.norm * node.radius + node.norm * group.radius + group.radius * node.radius
        members = self._below(group)
        # a margin for the rounding of the radii
        if bound * (1 + 1e-9) + 1 < self.worst[members].min():
            return
        if len(group.points):
            self._points(group.points, node)
        for child in group.children:
            if node.children and node.radius >= child.radius:
                if len(node.points):
                    self._single(child, node.points)
                for below in self._by_bound(child.centre, node.children):
                    self.pair(child, below)
            else:
                self.pair(child, node) if child.children else self._points(child.points, node)

    def _single(self, group: Node, points: np.ndarray) -> None:
        """A query group against single points, whose radius is zero."""
        members = self._below(group)
        bounds = self.data[points].astype(float) @ group.centre + group.radius * np.sqrt((self.data[points].astype(float) ** 2).sum(axis=1))
        close = bounds * (1 + 1e-9) + 1 >= self.worst[members].min()
        if close.any():
            self._compare(members, points[close])

    def _points(self, queries: np.ndarray, node: Node) -> None:
        """Single queries against a node; each is judged by its own list."""
        bounds = self.queries[queries].astype(float) @ node.centre + self.query_norms[queries] * node.radius
        queries = queries[bounds * (1 + 1e-9) + 1 >= self.worst[queries]]
        if not len(queries):
            return
        if len(node.points):
            self._compare(queries, node.points)
        if node.children:
            middle = self.queries[queries].astype(float).mean(axis=0)
            for child in self._by_bound(middle, node.children):
                self._points(queries, child)

    @staticmethod
    def _by_bound(centre: np.ndarray, nodes: list[Node]) -> list[Node]:
        """The most promising node first, so the lists fill with high scores early."""
        length = float(np.sqrt(centre @ centre))
        return sorted(nodes, key=lambda n: -(float(centre @ n.centre) + length * n.radius))


def _whole(values: np.ndarray, kind: type) -> np.ndarray:
    """Whole doubles as numbers of a kind."""
    if kind is not object:
        return values.astype(kind)
    return np.array([[int(x) for x in row] for row in values.tolist()], dtype=object).reshape(values.shape)


def _search(key: tuple, queries: pd.DataFrame, data: pd.DataFrame, k: int, factor: float) -> pd.DataFrame:
    if not len(queries) or not len(data):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "size": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "size": float})
    left, right = (np.floor(np.array(side["v"].tolist(), dtype=float) * factor) for side in (queries, data))
    search = Search(left, queries["vec_id"].to_numpy(), right, data["vec_id"].to_numpy(), k)
    search.run()
    found = [np.column_stack([np.full(len(b), q), b]) for q, b in zip(search.query_ids, search.best, strict=True)]
    table = np.concatenate(found)
    scores = table[:, 1]
    sizes = scores.astype(float)
    if search.kind is object:
        scores = np.array([max(-(2**63), min(2**63 - 1, int(s))) for s in scores], np.int64)
    return pd.DataFrame({"query_id": table[:, 0].astype(np.int64), "vec_id": table[:, 2].astype(np.int64), "score": scores, "size": sizes})


def top_k(rows: DataFrame, is_query: Column, k: int = 10, factor: float = 1024.0) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query row.

    A condition on ``vec_id`` names the queries; all rows are candidates.
    """
    prepare_workers(rows.sparkSession)
    limit = F.lit(1.7e308 / max(factor, 1.0))
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= limit))
    good = rows.where(F.col("vec_id").isNotNull() & F.coalesce(fits, F.lit(False)) & (F.size("embedding") > 0))
    vectors = good.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.size("embedding").alias("n"))
    # one row for each length of vectors
    counted = vectors.groupBy("n").agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_query).alias("wanted")).where("wanted > 0")
    sizes = counted.select("n", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"), F.ceil(F.col("wanted") / QUERIES).cast("int").alias("parts"))
    vectors = vectors.join(F.broadcast(stored(sizes)), "n")

    def spread(part: DataFrame, own: str, own_count: str, other: str, other_count: str, seed: int) -> DataFrame:
        """Rows in blocks of their own, sent to every block of the other side."""
        block = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.col(own_count)).cast("int").alias(own)
        everywhere = F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)).alias(other)
        # columns of their own, as both sides come from one table
        return part.select(*[F.col(c).alias(c) for c in ("vec_id", "v", "n")], block, everywhere)

    data = spread(vectors, "block", "blocks", "queries", "parts", 1)
    queries = spread(vectors.where(is_query), "queries", "parts", "block", "blocks", 2)

    def search(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _search(key, left, right, k, factor)

    pairs = queries.groupBy("n", "block", "queries").cogroup(data.groupBy("n", "block", "queries"))
    best = pairs.applyInPandas(search, "query_id bigint, vec_id bigint, score bigint, size double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("size"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
