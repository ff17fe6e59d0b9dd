"""Exact numbers of different users from states which can be stored and merged.

Users get dense numbers once; new users follow those known. A state holds one bit for each user
of a channel, in bitmaps of fixed size, so the states of batches merge by a bitwise or, and a new
batch costs what its own posts cost. A user counts in a channel if any batch holds a post of
theirs there, also one which a later batch replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect
from parley.operators.filters import activity
from parley.operators.ordered import row_index


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(user_id, number): the users of ``known`` with their numbers, and all others of ``users``,
    each numbered on from there. Rows without a user are left out."""
    new = users.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    if known is None:
        return row_index(new, ["user_id"], "number")
    new = new.join(known.select(F.col("user_id").alias("_user")), F.col("user_id") == F.col("_user"), "left_anti")
    following = known.agg(F.coalesce(F.max("number") + 1, F.lit(0)).alias("next")).first()["next"]
    numbered = row_index(new, ["user_id"], "number").withColumn("number", F.col("number") + following)
    return known.select("user_id", "number").unionByName(numbered)


def user_states(posts: DataFrame, numbers: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    """(channel, bucket, users): for each channel the active users as bits.

    Posts are reduced to pairs of channel and user before they meet the numbers, and bitmaps are
    built before they are shuffled, so a channel with most of the posts costs no more.
    """
    active = activity(posts, dialect).where("channel IS NOT NULL AND user_id IS NOT NULL")
    pairs = active.select("channel", "user_id").distinct()
    numbered = pairs.join(numbers.select(F.col("user_id").alias("_user"), "number"), F.col("user_id") == F.col("_user"))
    # Buckets count from 1.
    place = F.col("number") + 1
    return numbered.groupBy("channel", F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("users")
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all posts out of the states of parts of them, in any order."""
    everything = reduce(DataFrame.unionByName, states)
    return everything.groupBy("channel", "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def users_of_states(state: DataFrame) -> DataFrame:
    """Number of different users of each channel, as ``counts.users_per_channel``. A state with
    several rows for a bucket, such as that of stored parts, is merged first."""
    return state.groupBy("channel").agg(F.sum(F.bitmap_count("users")).alias("user_id"))
