"""What each user did and when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect
from parley.functions.times import ts_key
from parley.operators.filters import is_activity


def _ts_at(extreme, condition: Column | None = None) -> Column:
    """The message id text at the first or last numeric id, optionally under a condition."""
    key = ts_key("ts") if condition is None else F.when(condition, ts_key("ts"))
    return extreme("ts", key)


def _positive(count: Column) -> Column:
    return F.when(count > 0, count)


def user_activity(
    users: DataFrame, posts: DataFrame, reactions: DataFrame, dialect: Dialect = THREADED
) -> DataFrame:
    """First post of any kind, and count, first and last of activity posts and of reactions
    given, for every user. Counts of users who did nothing are null."""
    active = is_activity(dialect)
    posted = (
        posts.where(F.col("user_id").isNotNull())
        .groupBy(F.col("user_id").alias("_poster"))
        .agg(
            _ts_at(F.min_by).alias("join_date"),
            _positive(F.count_if(active)).alias("message_count"),
            _ts_at(F.min_by, active).alias("first_message_date"),
            _ts_at(F.max_by, active).alias("last_message_date"),
        )
    )
    reacted = (
        reactions.where(F.col("user_id").isNotNull())
        .groupBy(F.col("user_id").alias("_reactor"))
        .agg(
            F.count("*").alias("reaction_count"),
            _ts_at(F.min_by).alias("first_reaction_date"),
            _ts_at(F.max_by).alias("last_reaction_date"),
        )
    )
    batch = F.col("batch")
    if dialect.geo:
        # A user who posted before the first export was invited no later than that post.
        late = F.coalesce(batch.try_cast("double") > F.col("join_date").try_cast("double"), F.lit(False))
        invited = F.when(late, F.col("join_date")).otherwise(batch)
    else:
        invited = batch
    named = ["name"] if dialect.geo else []
    return (
        users.join(posted, F.col("id") == F.col("_poster"), "left")
        .join(reacted, F.col("id") == F.col("_reactor"), "left")
        .select(
            F.col("id").alias("user_id"), *named, invited.alias("invite_date"), "join_date",
            "message_count", "first_message_date", "last_message_date",
            "reaction_count", "first_reaction_date", "last_reaction_date",
        )
    )
