"""Exact ranked lexical search by a dual-tree search over items and documents.

Statistics come from one pass over the documents, the lists from a second: each task keeps the k
best documents of every item. For a chunk of documents the weighted term counts form rows of
non-negative coordinates, one for each term of the items. Two trees stand over items and over
documents, whose nodes hold the largest value of each coordinate below them, so the product of
two nodes bounds every score between them. A pair of nodes is left out if its bound is below the
k-th score of every item under it; the rest is taken apart down to single rows, where the bound
is the score. Documents are first put in order of their own bounds against groups of items, so
documents that matter to the same items share nodes, and whole chunks go by one product.

Items are taken in blocks of at most ``ITEMS`` items and ``TERMS`` terms (a larger item is a block
of its own), one block in the driver at a time; per task and block at most k documents an item
leave the search. The lists of tasks are cut in two steps, so none meets all tasks at once.

Nulls and edges: a null or empty text has no terms; documents without terms count nowhere; rows
that share a ``doc_id`` are documents of their own, and a document without ``doc_id`` counts in the
statistics, but is in no list; rows that share an ``item_id`` are one item, whose terms add up,
and rows without one are left out; an item without terms, or whose terms no document holds, has
an empty list; texts of any length are taken whole; scores of 2^53 and more are computed in
64-bit integers; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers, stored

#: Items and their terms in a block.
ITEMS, TERMS = 1024, 8192
#: Cells of the table of a chunk of documents; documents in a chunk at most.
CELLS, CHUNK = 1 << 22, 1024
#: Nodes under a node.
FAN = 8
#: Groups of items, at most, by which documents are put in order.
GROUPS = 64
#: Parts of the tasks whose lists are cut apart before they meet.
PARTS = 256
#: Bytes that end a term become spaces, capital letters of ASCII small ones.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_PLAIN).split() if text else []


@dataclass(frozen=True)
class Statistics:
    documents: int
    terms: int
    #: Documents that hold each term of the block.
    holding: dict[bytes, int]

    def weight(self, term: bytes) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * self.holding.get(term, 0) + 1)))

    def damping(self, length: np.ndarray) -> np.ndarray:
        """The weight of a document's length."""
        return 25 + (75 * length * self.documents) // self.terms


class Items:
    """The items of a block as rows of term weights, and the tree over them."""

    def __init__(self, counts: dict[int, Counter], statistics: Statistics):
        found = {item: {t: n * statistics.weight(t) for t, n in terms.items() if statistics.holding.get(t)} for item, terms in counts.items()}
        self.terms = {t: k for k, t in enumerate(sorted({t for terms in found.values() for t in terms}))}
        self.statistics = statistics
        # a count weighs less than 1,000,000
        most = max((sum(terms.values()) for terms in found.values()), default=0) * 1_000_000
        # doubles hold whole numbers exactly below 2 ** 53
        self.kind = np.int64 if most >= 1 << 53 else np.float64
        rows = np.zeros((len(found), len(self.terms)), self.kind)
        for row, terms in zip(rows, found.values()):
            row[[self.terms[t] for t in terms]] = list(terms.values())
        order = _by_likeness(rows.astype(np.float64))
        self.ids = np.array(list(found), np.int64)[order]
        self.levels = _tree(rows[order])


def _by_likeness(rows: np.ndarray) -> np.ndarray:
    """Rows in an order in which like ones are close: each node takes the rows most like the first
    one that is left, and the nodes are put in order in the same way."""
    if len(rows) <= FAN:
        return np.arange(len(rows))
    norms = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    likeness = (rows / np.where(norms, norms, 1)) @ (rows / np.where(norms, norms, 1)).T
    left, groups = np.arange(len(rows)), []
    while len(left):
        nearest = np.argsort(-likeness[left[0], left[1:]], kind="stable")[: FAN - 1] + 1
        groups.append(np.concatenate([left[:1], left[nearest]]))
        left = np.delete(left, [0, *nearest])
    # one that is not full comes last, as nodes are cut at fixed places
    last = groups.pop()
    order = _by_likeness(np.array([rows[g].sum(axis=0) for g in groups]))
    return np.concatenate([*(groups[k] for k in order), last])


def _tree(rows: np.ndarray) -> list[np.ndarray]:
    """Levels of coordinate maxima from the root down; the last one is the rows themselves.

    Above rows of 64-bit integers stand doubles, with a margin for their rounding.
    """
    levels = [rows]
    while len(levels[0]) > 1:
        highest = np.maximum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN), axis=0)
        levels.insert(0, highest.astype(np.float64) * (1 + 1e-9) if highest.dtype == np.int64 else highest)
    return levels


def _below(nodes: np.ndarray, count: int) -> np.ndarray:
    """The children of nodes, of ``count`` there are."""
    children = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
    return children[children < count]


class Lists:
    """The k best documents of each item, and how much of the work was left out."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        count = len(items.ids)
        self.scores, self.docs = np.zeros((count, k), np.int64), np.zeros((count, k), np.int64)
        self.scored = self.possible = 0

    @property
    def worst(self) -> np.ndarray:
        """The k-th score of each item; documents must score above 0 to enter."""
        return self.scores[:, -1]

    def _thresholds(self) -> list[np.ndarray]:
        """For each node of the item tree the least score that could still enter below it."""
        levels = [np.maximum(self.worst, 1)]
        while len(levels[0]) > 1:
            levels.insert(0, np.minimum.reduceat(levels[0], np.arange(0, len(levels[0]), FAN)))
        return levels

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        """Searches a chunk of documents, given by their coordinates."""
        items = self.items.levels
        if not rows.size or not items[-1].size:
            return
        self.possible += len(rows) * len(items[-1])
        thresholds = self._thresholds()
        # whole documents against groups of items
        group = max(h for h, level in enumerate(items[:-1] or items) if len(level) <= GROUPS or not h)
        bounds = rows @ items[group].T
        alive = np.flatnonzero((bounds >= thresholds[group]).any(axis=1))
        if not len(alive):
            return
        bounds = bounds[alive]
        best = bounds.argmax(axis=1)
        alive = alive[np.lexsort((-bounds[np.arange(len(alive)), best], best))]
        ids, rows = ids[alive], rows[alive]
        levels = _tree(rows)
        # depth first from the most promising node, so that thresholds rise early
        top = max(0, len(levels) - 3)
        reach = (levels[top] @ items[0].T)[:, 0]
        for node in np.argsort(-reach, kind="stable").tolist():
            for group in self._groups(levels[top][node]):
                self._descend(ids, levels, top, node, group)

    def _groups(self, node: np.ndarray) -> list[int]:
        """The last nodes of the item tree whose product with a document node leaves a chance,
        the best first."""
        items, thresholds = self.items.levels, self._thresholds()
        last, group = max(0, len(items) - 2), np.array([0])
        for height in range(last + 1):
            bounds = items[height][group] @ node
            open_nodes = bounds >= thresholds[height][group]
            group, bounds = group[open_nodes], bounds[open_nodes]
            if height < last:
                group = _below(group, len(items[height + 1]))
        return group[np.argsort(-bounds, kind="stable")].tolist()

    def _descend(self, ids: np.ndarray, docs: list[np.ndarray], depth: int, node: int, group: int) -> None:
        """Takes a document node apart against a node of items, down to single scores."""
        items = self.items.levels
        own = slice(FAN * group, FAN * (group + 1))
        if depth >= len(docs) - 2:
            below = slice(FAN * node, FAN * (node + 1))
            scores = docs[-1][below] @ items[-1][own].T
            self.scored += scores.size
            for column in np.flatnonzero(scores.max(axis=0) >= np.maximum(self.worst[own], 1)).tolist():
                self._enter(FAN * group + column, scores[:, column].astype(np.int64), ids[below])
            return
        start = FAN * node
        bounds = docs[depth + 1][start : start + FAN] @ items[max(0, len(items) - 2)][group]
        for child in np.argsort(-bounds, kind="stable").tolist():
            if bounds[child] >= max(1, self.worst[own].min()):
                self._descend(ids, docs, depth + 1, start + child, group)

    def _enter(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        enters = scores >= max(1, self.worst[item])
        scores, ids = np.concatenate([self.scores[item], scores[enters]]), np.concatenate([self.docs[item], ids[enters]])
        # places not filled have score 0 and come last
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], ids[order]

    def table(self) -> pa.RecordBatch:
        item, place = np.nonzero(self.scores)
        columns = [self.items.ids[item], self.docs[item, place], self.scores[item, place]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item_id", "doc_id", "score"])


def coordinates(texts: list[bytes | None], items: Items) -> np.ndarray:
    """The weighted counts of the items' terms in each text."""
    rows = np.zeros((len(texts), len(items.terms)), items.kind)
    number = items.terms.get
    for row, text in zip(rows, texts):
        words = terms_of(text)
        places = np.fromiter((number(w, -1) for w in words), np.int64, len(words))
        found, counts = np.unique(places[places >= 0], return_counts=True)
        if len(found):
            m = items.statistics.damping(np.int64(len(words)))
            row[found] = (1_000_000_000 * counts) // (1000 * counts + 8 * m)
    return rows


def _statistics(texts: DataFrame, terms: set[bytes]) -> Statistics:
    """Counts over all documents: a task sends one row for each term it met, and two sums."""
    order = sorted(terms)
    number = {t: k for k, t in enumerate(order)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding, documents, total = np.zeros(len(number), np.int64), 0, 0
        get = number.get
        for batch in batches:
            for text in batch.column(1):
                words = terms_of(text.as_py())
                documents, total = documents + bool(words), total + len(words)
                met = set(map(get, set(words)))
                met.discard(None)
                holding[list(met)] += 1
        met = np.flatnonzero(holding)
        places, values = np.concatenate([met, [-1, -2]]), np.concatenate([holding[met], [documents, total]])
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(values, pa.int64())], ["place", "n"])

    # at most one row for each term of the block
    sums = texts.mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = {r["place"]: r["n"] for r in sums}
    return Statistics(found.get(-1, 0), found.get(-2, 0), {order[k]: n for k, n in found.items() if k >= 0})


def _search_block(texts: DataFrame, counts: dict[int, Counter], k: int) -> DataFrame:
    """(item_id, doc_id, score, part): the lists of each task."""
    statistics = _statistics(texts, set().union(*counts.values()))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(counts, statistics)
        chunk = max(1, min(CHUNK, CELLS // max(1, len(items.terms))))
        lists = Lists(items, k)
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid())
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                lists.add(np.asarray(part.column(0)), coordinates(part.column(1).to_pylist(), items))
        yield lists.table()

    found = texts.mapInArrow(search, "item_id bigint, doc_id bigint, score bigint")
    return found.withColumn("part", F.spark_partition_id() % PARTS)


def _blocks(items: DataFrame) -> Iterator[dict[int, Counter]]:
    """Terms of the items, a block at a time."""
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    chosen = items.where("item_id IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), text)
    block: dict[int, Counter] = {}
    terms: set[bytes] = set()
    for row in chosen.orderBy("item_id").toLocalIterator():
        words = Counter(terms_of(row["text"]))
        new = row["item_id"] not in block
        if new and block and (len(block) >= ITEMS or len(terms | words.keys()) > TERMS):
            yield block
            block, terms = {}, set()
        block.setdefault(row["item_id"], Counter()).update(words)
        terms |= words.keys()
    if terms:
        yield block


def _cut(lists: DataFrame, k: int, *group: str) -> DataFrame:
    """The k best of each group, with their rank."""
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "doc_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item.

    The documents are read twice for each block of items; nothing of them is shuffled but the
    lists. Each block's lists are written before the next block starts.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    text: Column = F.col("text").cast("binary").alias("text")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    found = spark.createDataFrame([], "item_id bigint, doc_id bigint, score bigint, part int")
    for block in _blocks(items):
        found = found.union(stored(_cut(_search_block(texts, block, k), k, "item_id", "part").drop("rank")))
    return _cut(found, k, "item_id").select("item_id", "rank", "doc_id", "score")
