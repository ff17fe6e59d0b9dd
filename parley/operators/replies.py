"""Seconds since the previous post of the same channel, thread or user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect
from parley.functions.times import seconds_between, ts_key
from parley.operators.filters import threaded
from parley.operators.ordered import ROWS_PER_SLICE, order_bounds, with_previous


def post_bounds(posts: DataFrame, rows_per_slice: int = ROWS_PER_SLICE) -> list[float]:
    """Cut points of the message order, to be shared by the three measures. Runs jobs over
    ``posts``, which should be a stored table."""
    return order_bounds(posts, ts_key("ts"), rows_per_slice)


def _timediff(posts: DataFrame, keys: Sequence[str], bounds: Sequence[float]) -> DataFrame:
    ties = [F.col("channel"), F.col("text")]
    rows = with_previous(posts, keys, ts_key("ts"), "time", "_previous", ties, bounds)
    diff = seconds_between(F.col("time"), F.col("_previous"))
    return rows.withColumn("diff", F.coalesce(diff, F.lit(0.0))).drop("_previous")


def timediff_conversations(posts: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """``bounds`` as given by ``post_bounds``; building the plan runs no job."""
    return _timediff(posts, ["channel"], bounds)


def timediff_threads(posts: DataFrame, bounds: Sequence[float]) -> DataFrame:
    return _timediff(threaded(posts), ["channel", "thread_ts"], bounds)


def timediff_users(
    posts: DataFrame, bounds: Sequence[float], dialect: Dialect = THREADED
) -> DataFrame:
    """Across channels; only posts in threads where the product has threads."""
    rows = threaded(posts) if dialect.threads else posts
    hashed = rows.withColumn("user_hash", user_hash())
    return _timediff(hashed, ["user_id"], bounds)


def user_hash(column: str = "user_id"):
    """A stable number for a user, equal in every run."""
    return F.xxhash64(column)
