"""What every batch changed in the master: the deltas of all batches from one pass.

A row is an insert in the first batch which holds its key, and an update in any later one. The
first batch of a key comes from an aggregate that reduces before its shuffle, so the rows
themselves are shuffled once, however many batches there are. They are shuffled by key and a
number made of the row: equal rows still meet, and a key with very many rows is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.merge import INSERT, UPDATE, EntitySpec

#: Parts of the rows of one key.
PARTS = 64


def _first_value(batch: str, column: str) -> Column:
    """The value of the first batch: the least that is not null, if there are several."""
    return F.min(F.struct(F.col(batch), F.col(column).isNull(), F.col(column).alias("value")))["value"]


def change_feed(
    batches: DataFrame,
    spec: EntitySpec,
    batch: str = "batch_id",
    of: Sequence[int] | None = None,
) -> DataFrame:
    """(batch, change, columns of the table): the distinct rows of each batch, which are inserts
    or updates of the master over the batches before. First-seen values of an update are those
    of the master, as in a merge.

    ``of`` names the batches that are asked for; of all others only keys, and values which stay
    as first seen, are read. Nulls in keys match each other; rows without a batch are left out.
    """
    stay = [c for c in spec.columns if c not in spec.keep_first]
    # In a struct nulls equal each other.
    keyed = batches.where(F.col(batch).isNotNull()).select(F.struct(*spec.keys).alias("_key"), batch, *spec.columns)
    part = F.pmod(F.xxhash64(batch, *stay), F.lit(PARTS)).cast("int")
    asked = F.lit(True) if of is None else F.col(batch).isin(list(of))
    if of:
        keyed = keyed.where(F.col(batch) <= max(of))
    first = keyed.groupBy("_key").agg(
        F.min(batch).alias("_first"),
        *[_first_value(batch, c).alias("_first_" + c) for c in spec.keep_first],
        F.collect_set(F.when(asked, part)).alias("_parts"),
    )
    # One narrow row for each part of a key that has rows.
    known = first.withColumn("_part", F.explode("_parts")).drop("_parts")
    rows = keyed.where(asked).withColumn("_part", part).join(known, ["_key", "_part"])
    later = F.col("_first") < F.col(batch)
    kept = {c: F.when(later, F.col("_first_" + c)).otherwise(F.col(c)) for c in spec.keep_first}
    change = F.when(later, UPDATE).otherwise(INSERT).alias("change")
    columns = [kept.get(c, F.col(c)).alias(c) for c in spec.columns]
    # Key and part are there for their partitioning: equal rows are in one task already.
    return rows.select("_key", "_part", batch, change, *columns).distinct().drop("_key", "_part")


def feed_counts(feed: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Inserted and updated rows of each batch."""
    return feed.groupBy(batch).agg(
        F.count_if(F.col("change") == INSERT).alias("inserted"), F.count_if(F.col("change") == UPDATE).alias("updated")
    )
