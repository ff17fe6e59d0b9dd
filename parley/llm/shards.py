"""Shards by jump consistent hashing, in column expressions.

The key and the number of shards decide. With one more shard a row stays where it is or moves
into the new shard, and the fraction 1 / (n + 1) of the rows moves. No ring table exists.

Nulls and edges: a null key counts as 0; a null text has no bytes; rows with equal keys share
a shard and get slots of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import numbered

#: The step of the generator, state * MULTIPLIER + 1 modulo 2 ** 64.
MULTIPLIER = 2862933555777941757
#: Parts of a shard, numbered one by one.
BUCKETS = 1024
_LOW = 0xFFFFFFFF


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """The next state in halves of 32 bits.

    Spark has no product modulo 2 ** 64, so halves are multiplied by 16 bits at a time, which
    stays below 2 ** 49.
    """
    m0, m1 = MULTIPLIER & 0xFFFF, MULTIPLIER >> 16 & 0xFFFF
    m2, m3 = MULTIPLIER >> 32 & 0xFFFF, MULTIPLIER >> 48

    def times_low_half(half: Column, a: int, b: int) -> Column:
        """half * (a + b * 65536) modulo 2 ** 32"""
        return (half * a + F.shiftleft((half * b).bitwiseAND(0xFFFF), 16)).bitwiseAND(_LOW)

    upper = low * m1
    total = low * m0 + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + 1
    carry = F.shiftright(total, 32) + F.shiftright(upper, 16)
    new_high = carry + times_low_half(high, m0, m1) + times_low_half(low, m2, m3)
    return new_high.bitwiseAND(_LOW), total.bitwiseAND(_LOW)


def jump(key: Column, shards: int) -> Column:
    """struct(shard, grown_shard, bucket): the shard among ``shards`` and among one more.

    ``bucket`` comes from the first state, so it is as stable as the shard.
    """
    key = F.coalesce(key.cast("bigint"), F.lit(0).cast("bigint"))
    # shiftright keeps the sign: the mask makes the upper half unsigned
    first = _next_state(F.shiftright(key, 32).bitwiseAND(_LOW), key.bitwiseAND(_LOW))

    def struct(high: Column, low: Column, shard: Column, following: Column) -> Column:
        return F.struct(high.alias("high"), low.alias("low"), shard.alias("shard"), following.alias("following"))

    def step(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        scale = F.lit(2147483648.0) / (F.shiftright(high, 1) + 1).cast("double")
        following = F.floor((state["following"] + 1).cast("double") * scale)
        moved = struct(high, low, state["following"], following)
        return F.when(state["following"] < shards, moved).otherwise(state)

    zero = F.lit(0).cast("bigint")
    start = struct(F.shiftright(key, 32).bitwiseAND(_LOW), key.bitwiseAND(_LOW), zero, zero)
    # a step goes forward by one shard at least
    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
    grown = F.when(end["following"] == shards, F.lit(shards).cast("bigint")).otherwise(end["shard"])
    return F.struct(
        end["shard"].cast("int").alias("shard"),
        grown.cast("int").alias("grown_shard"),
        F.shiftright(first[0], 22).cast("int").alias("bucket"),
    )


def shard(docs: DataFrame, shards: int = 16, key: str = "doc_id") -> DataFrame:
    """Size, checksum, shard and slot of every document.

    Slots are gapless from 0 in every shard. They are counted by bucket of the shard and moved
    by the sizes of the buckets before, so no task sees a whole shard and no text is shuffled.
    """
    # a null text has the bytes of an empty one
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    placed = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump(F.col(key), shards).alias("_to"),
    )
    flat = placed.select("doc_id", "size", "text_crc32", "law", "_to.*")
    order = [F.col("doc_id").asc_nulls_first(), F.col("size"), F.col("text_crc32")]
    rows = numbered(flat, ["shard"], "bucket", order, "slot")
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
