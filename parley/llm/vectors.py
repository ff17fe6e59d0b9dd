"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Rotations are learned on a bounded sample: principal axes first, then turns that bring the
signs of the rotated vectors closest to the vectors themselves. Every row is coded by the signs
of the vector itself, not of what it differs from the mean, so bits differ with the angle of a
pair also where all vectors share a direction; buckets are fuller there. The code is cut into substrings of as many bits as the number of rows asks for,
one table per substring, and there are as many tables as find a pair at the threshold with the
wanted recall. Pairs that share a substring and whose codes are close are reranked with the
original vectors in double precision, so none below the threshold is linked.

Groups make no lists of pairs. Equal vectors are one class with a count. In each bucket the most
central class is a hub, and whoever lies within half the angle of the threshold of its hub
joins the hub's ball: any two of a ball are within the whole angle, so they link without a
look at the pair, and only pairs that are not of one ball are compared.

Nulls and edges: vectors that are null, empty, zero, or hold null or non-finite components link
with nothing; vectors of each length are compared among themselves; equal vectors link; rows that share a
``vec_id`` stay rows and share links; a null ``vec_id`` links with nothing and has a null
component; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import prepare_workers, stored
from parley.llm.components import components

#: Rows that the rotations are learned on, and rounds of learning.
SAMPLE, ROUNDS, SEED = 10_000, 30, 11
#: Chance to find a pair that lies at the threshold; higher ones are found more often.
RECALL = 0.97
#: Bits of the code that are compared before vectors are moved, in words of 64.
CHECK_WORDS = 2


def usable(column: str = "embedding") -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(column, lambda x: x != 0), F.lit(False))


def learn_rotation(sample: np.ndarray, bits: int, rng: np.random.Generator) -> np.ndarray:
    """Axes (columns) whose signs are the code: principal axes, turned by quantisation."""
    _, axes = np.linalg.eigh(sample.T @ sample)
    axes = axes[:, ::-1][:, :bits]
    projected = sample @ axes
    turn, _ = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))
    for _ in range(ROUNDS):
        signs = np.where(projected @ turn >= 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(signs.T @ projected)
        turn = (u @ v).T
    return axes @ turn


class Codes:
    """Rotations; gives substrings for the tables and words for the comparison.

    A rotation keeps all dimensions, as a pair's angle is another one on fewer axes.
    """

    def __init__(self, sample: np.ndarray, width: int, tables: int):
        rng = np.random.default_rng(SEED)
        self.width, self.tables = width, tables
        centred = sample - sample.mean(axis=0)
        bits = sample.shape[1]
        needed = max(width * tables, 64 * CHECK_WORDS)
        self.rotations = [learn_rotation(centred, bits, rng) for _ in range(-(-needed // bits))]

    def of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x tables) substrings, (rows x CHECK_WORDS) words."""
        units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        bits = np.concatenate([units @ r >= 0 for r in self.rotations], axis=1)
        parts = bits[:, : self.width * self.tables].reshape(len(bits), self.tables, self.width)
        keys = parts @ (1 << np.arange(self.width, dtype=np.int64))
        words = np.packbits(bits[:, : 64 * CHECK_WORDS], axis=1).view(np.int64)
        return keys, words


def plan_tables(rows: int, threshold: float) -> tuple[int, int]:
    """(bits of a substring, tables) for so many rows.

    Substrings have about log2(rows) bits, so unrelated rows share a bucket rarely whatever the
    size. A bit of two vectors differs with their angle over pi.
    """
    width = min(40, max(8, math.ceil(math.log2(max(rows, 2)))))
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, math.ceil(math.log(1 - RECALL) / math.log(1 - agree))


def code_distance(threshold: float) -> int:
    """Differing bits that a pair at the threshold has at most, five deviations off."""
    bits, differ = 64 * CHECK_WORDS, math.acos(threshold) / math.pi
    return math.ceil(bits * differ + 5 * math.sqrt(bits * differ * (1 - differ)))


def _table_rows(classes: DataFrame, codes: Codes) -> DataFrame:
    """(bucket, rep, w0, w1) for every class and table."""
    shared = classes.sparkSession.sparkContext.broadcast(codes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = np.array(batch.column(1).to_pylist(), dtype=float)
            keys, words = shared.value.of(vectors)
            tables = keys.shape[1]
            bucket = keys | (np.arange(tables, dtype=np.int64) << 48)
            reps = np.repeat(batch.column(0).to_numpy(), tables)
            columns = [bucket.ravel(), reps, *(np.repeat(words[:, i], tables) for i in range(CHECK_WORDS))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "rep", "w0", "w1"])

    return classes.select("rep", "vector").mapInArrow(rows, "bucket bigint, rep bigint, w0 bigint, w1 bigint")


def _close(columns: list[str], others: list[str], threshold: float) -> Column:
    differing = [F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(columns, others, strict=True)]
    return sum(differing[1:], differing[0]) <= code_distance(threshold)


def balls(buckets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """(rep, ball): each class at most once, in the ball of the heaviest hub that it is near.

    The hub of a bucket is the class that meets the most others over all its buckets; a hub
    that holds others is in its own ball.
    """
    shared = buckets.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where("size > 1")
    weights = shared.groupBy("rep").agg(F.sum("size").alias("weight"))
    weighted = shared.select("bucket", "rep", "w0", "w1").join(weights, "rep")
    heaviest = F.max(F.struct("weight", "rep", "w0", "w1")).over(Window.partitionBy("bucket"))
    with_hub = weighted.withColumn("hub", heaviest).where(F.col("rep") != F.col("hub.rep"))
    with_hub = with_hub.select("rep", F.col("hub.rep").alias("b"), "w0", "w1", F.col("hub.w0").alias("v0"), F.col("hub.w1").alias("v1"), F.col("hub.weight").alias("weight"))
    near = with_hub.where(_close(["w0", "w1"], ["v0", "v1"], threshold)).groupBy(F.col("rep").alias("a"), "b").agg(F.max("weight").alias("weight"))
    # a little closer than half the angle, against rounding
    half = math.cos(math.acos(threshold) / 2) + 1e-9
    inside = stored(near.join(rerank(near.select("a", "b"), classes, half), ["a", "b"]))
    chosen = inside.groupBy(F.col("a").alias("rep")).agg(F.max_by("b", F.struct("weight", "b")).alias("ball"))
    hubs = chosen.select(F.col("ball").alias("rep")).distinct()
    others = chosen.join(hubs, "rep", "left_anti")
    # a hub may have gone to another hub, which leaves its ball without it
    return stored(others.union(hubs.select("rep", F.col("rep").alias("ball"))))


def candidates(buckets: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs a > b that share a bucket, are not of one ball, and whose codes are close."""
    rows = buckets.join(members, "rep", "left").withColumn("ball", F.coalesce("ball", -1 - F.col("rep")))
    other = rows.select("bucket", F.col("rep").alias("b"), F.col("w0").alias("v0"), F.col("w1").alias("v1"), F.col("ball").alias("ball2"))
    apart = (F.col("rep") > F.col("b")) & (F.col("ball") != F.col("ball2"))
    pairs = rows.join(other, "bucket").where(apart & _close(["w0", "w1"], ["v0", "v1"], threshold))
    return pairs.select(F.col("rep").alias("a"), "b").distinct()


def rerank(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine in double precision reaches the threshold."""
    left = classes.select(F.col("rep").alias("a"), F.col("vector").alias("va"))
    right = classes.select(F.col("rep").alias("b"), F.col("vector").alias("vb"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            va, vb = (np.array(batch.column(i).to_pylist(), dtype=float) for i in (2, 3))
            cosine = (va * vb).sum(axis=1) / np.sqrt((va * va).sum(axis=1) * (vb * vb).sum(axis=1))
            yield batch.select([0, 1]).filter(pa.array(cosine >= threshold))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")
    return both.mapInArrow(keep, "a bigint, b bigint").distinct()


def near_vectors(rows: DataFrame, threshold: float = 0.9) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row (vec_id, embedding)."""
    prepare_workers(rows.sparkSession)
    everything = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    valid = F.coalesce(usable("vector") & F.col("vec_id").isNotNull(), F.lit(False))
    good = everything.where(valid)
    # vectors of each length are compared among themselves
    lengths = sorted(r["n"] for r in good.select(F.size("vector").alias("n")).distinct().collect())
    per_class = everything.sparkSession.createDataFrame([], "vector array<double>, n_links bigint, component_id bigint")
    for length in lengths:
        per_class = per_class.union(_linked_classes(good.where(F.size("vector") == length), threshold))
    found = everything.withColumn("vector", F.when(valid, F.col("vector"))).join(per_class, "vector", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))


def _linked_classes(good: DataFrame, threshold: float) -> DataFrame:
    """(vector, n_links, component_id) for the distinct vectors of one length."""
    classes = stored(good.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    count = classes.count()
    if count:
        sample = classes.select("rep", "vector").orderBy(F.xxhash64("rep")).limit(SAMPLE).collect()
        units = np.array([r["vector"] for r in sorted(sample)])
        units /= np.linalg.norm(units, axis=1)[:, None]
        codes = Codes(units, *plan_tables(count, threshold))
        buckets = stored(_table_rows(classes, codes))
        members = balls(buckets, classes, threshold)
        links = stored(rerank(stored(candidates(buckets, members, threshold)), classes, threshold))
    else:
        members = classes.select("rep", F.col("rep").alias("ball"))
        links = stored(classes.select(F.col("rep").alias("a"), F.col("rep").alias("b")))
    joined = components(links.union(members.select("rep", "ball")))
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.groupBy("rep").agg(F.sum("copies").alias("copies"))
    # a class links with all of its ball but itself, and with those found one by one
    inside = members.join(sizes, "rep")
    whole = inside.groupBy("ball").agg(F.sum("copies").alias("all"))
    of_ball = inside.join(whole, "ball").select(F.col("rep").alias("a"), (F.col("all") - F.col("copies")).alias("copies"))
    of_pairs = both.join(sizes.withColumnRenamed("rep", "b"), "b").select("a", "copies")
    others = of_pairs.union(of_ball).groupBy("a").agg(F.sum("copies").alias("linked"))
    named = classes.select("vector", "rep", "copies").join(others, F.col("rep") == F.col("a"), "left").drop("a")
    named = named.join(joined, F.col("rep") == F.col("node"), "left")
    return named.select(
        "vector",
        (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
