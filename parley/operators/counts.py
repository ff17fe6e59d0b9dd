"""Activity counts. Every count is a hash aggregate with a partial step before its shuffle,
so a channel with most of the rows costs no more than any other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect
from parley.operators.filters import activity, threaded


def _counted(posts: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Non-null counts per key; rows with a null key are left out."""
    for key in keys:
        posts = posts.where(F.col(key).isNotNull())
    return posts.groupBy(*keys).agg(*[F.count(c).alias(c) for c in columns])


def _measures(dialect: Dialect) -> list[str]:
    return ["ts", "thread_ts"] if dialect.threads else ["ts"]


def count_by_channel(posts: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    return _counted(activity(posts, dialect), ["channel"], _measures(dialect))


def count_by_channel_user(posts: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    return _counted(activity(posts, dialect), ["channel", "user_id"], _measures(dialect))


def users_per_channel(posts: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    """Number of different active users of each channel."""
    active = activity(posts, dialect).where("channel is not null and user_id is not null")
    return active.groupBy("channel").agg(F.count_distinct("user_id").alias("user_id"))


def max_per_channel(posts: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    """The highest post count of any user, per channel."""
    counts = count_by_channel_user(posts, dialect)
    return counts.groupBy("channel").agg(F.max("ts").alias("ts"))


def top_users_per_channel(
    posts: DataFrame, users: DataFrame, channels: DataFrame, dialect: Dialect = THREADED
) -> DataFrame:
    """The most active user of each channel with names; users with equal counts all stay.

    The highest count is joined back on (channel, count) instead of ranking: no task ever
    holds all users of a channel.
    """
    counts = count_by_channel_user(posts, dialect).select("channel", "user_id", "ts")
    highest = counts.groupBy("channel").agg(F.max("ts").alias("ts"))
    top = counts.join(highest, ["channel", "ts"])
    named_users = users.select(F.col("id").alias("_user"), F.col("real_name").alias("user_name"))
    named_channels = channels.select(
        F.col("id").alias("_channel"), F.col("name").alias("channel_name")
    )
    return (
        top.join(named_users, F.col("user_id") == F.col("_user"), "left")
        .join(named_channels, F.col("channel") == F.col("_channel"), "left")
        .select(F.col("channel").alias("channel_id"), "channel_name", "user_id", "user_name", "ts")
    )


def count_by_thread(posts: DataFrame) -> DataFrame:
    """Posts of each thread, of any subtype."""
    return _counted(threaded(posts), ["channel", "thread_ts"], ["ts"])


def count_by_thread_user(posts: DataFrame) -> DataFrame:
    return _counted(threaded(posts), ["channel", "thread_ts", "user_id"], ["ts"])
