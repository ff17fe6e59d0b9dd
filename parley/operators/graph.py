"""The social graph: users and channels as nodes, what they do to each other as edges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.dialect import FLAT, THREADED, Dialect
from parley.operators.filters import activity, differs, threaded
from parley.operators.posts import user_geo
from parley.schemas import EDGE_COLUMNS, NODE_COLUMNS


def nodes(
    users: DataFrame,
    channels: DataFrame,
    zone: DataFrame | None = None,
    country: DataFrame | None = None,
    dialect: Dialect = THREADED,
) -> DataFrame:
    none = F.lit(None).cast("string")
    label = F.col("name") if dialect.geo else F.coalesce("name", "real_name")
    people = user_geo(users, zone, country, dialect).select(
        "id", label.alias("label"), F.lit("user").alias("type"), F.col("real_name").alias("name"),
        "iso", "country", "city", none.alias("channel_type"), none.alias("channel_class"),
    )
    title = F.coalesce("name", "id")
    rooms = channels.select(
        "id", title.alias("label"), F.lit("channel").alias("type"), title.alias("name"),
        none.alias("iso"), none.alias("country"), none.alias("city"),
        F.col("type").alias("channel_type"), F.col("class").alias("channel_class"),
    )
    return people.unionByName(rooms).select(*NODE_COLUMNS)


def _edges(df: DataFrame, relate: str) -> DataFrame:
    return df.withColumn("relate", F.lit(relate)).select(*EDGE_COLUMNS)


def _joined_on(active: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``other`` has its columns prefixed by ``_``; keys are pairs of equal names."""
    condition = [F.col(k) == F.col("_" + k) for k in keys]
    return active.join(other, condition, how)


def _active(posts: DataFrame, dialect: Dialect) -> DataFrame:
    return activity(posts, dialect).select("channel", "ts", "thread_ts", "user_id", "time")


def edges_interacts(
    posts: DataFrame, dialect: Dialect = THREADED, join_keys: Sequence[str] = ("ts",)
) -> DataFrame:
    """Author of a reply to the author of its thread parent, else author to channel.

    ``join_keys``: a parent is found by message id alone; add ``channel`` where ids repeat
    across channels. Posts outside threads have no parent and skip the join, which would
    gather all of them under the null key.
    """
    active = _active(posts, dialect)
    alone = active.where(F.col("thread_ts").isNull()).withColumns(
        {"source": F.col("user_id"), "target": F.col("channel")}
    )
    parents = threaded(active).select(
        F.col("ts").alias("_ts"), F.col("channel").alias("_channel"), F.col("user_id").alias("_parent")
    )
    condition = [F.col("thread_ts") == F.col("_ts")]
    if "channel" in join_keys:
        condition.append(F.col("channel") == F.col("_channel"))
    replies = (
        threaded(active)
        .join(parents, condition, "left")
        .where(differs(F.col("user_id"), F.col("_parent")))
        .withColumns({"source": F.col("user_id"), "target": F.coalesce("_parent", "channel")})
    )
    both = alone.select("channel", "source", "target", "time").unionByName(
        replies.select("channel", "source", "target", "time")
    )
    return _edges(both, "interacts")


def edges_reacts(
    posts: DataFrame,
    reactions: DataFrame,
    dialect: Dialect = THREADED,
    join_keys: Sequence[str] = ("ts",),
) -> DataFrame:
    """Author of a post to each user who reacted to it, the author included."""
    given = reactions.where(F.col("user_id").isNotNull()).select(
        F.col("ts").alias("_ts"), F.col("channel").alias("_channel"), F.col("user_id").alias("target")
    )
    joined = _joined_on(_active(posts, dialect), given, join_keys, "inner")
    return _edges(joined.withColumn("source", F.col("user_id")), "reacts")


def edges_refers(
    posts: DataFrame,
    tags: DataFrame,
    dialect: Dialect = THREADED,
    join_keys: Sequence[str] = ("ts",),
) -> DataFrame:
    """Author of a post to each user it mentions, one edge per mention."""
    mentioned = tags.where(F.col("type") == "user").select(
        F.col("ts").alias("_ts"), F.col("channel").alias("_channel"), F.col("tag").alias("target")
    )
    authored = _active(posts, dialect).where(F.col("user_id").isNotNull())
    joined = _joined_on(authored, mentioned, join_keys, "inner")
    return _edges(joined.withColumn("source", F.col("user_id")), "refers")


def edges(posts: DataFrame, reactions: DataFrame, tags: DataFrame) -> DataFrame:
    """All edges of the first product."""
    return (
        edges_interacts(posts)
        .unionByName(edges_reacts(posts, reactions))
        .unionByName(edges_refers(posts, tags))
    )


# -- second product ---------------------------------------------------------------------------

_UNTIMED = ["channel", "source", "target", "relate"]


def edges_teams(posts: DataFrame, dialect: Dialect = FLAT) -> DataFrame:
    """Author to channel, for every activity post."""
    return activity(posts, dialect).select(
        "channel", F.col("user_id").alias("source"), F.col("channel").alias("target"),
        F.lit("teams").alias("relate"),
    )


def edges_untimed(posts: DataFrame, reactions: DataFrame, tags: DataFrame) -> DataFrame:
    """teams, reacts and refers of the second product; see ``interacts_b`` for the fourth."""
    reacts = edges_reacts(posts, reactions, FLAT).select(*_UNTIMED)
    refers = edges_refers(posts, tags, FLAT).select(*_UNTIMED)
    return edges_teams(posts).unionByName(reacts).unionByName(refers)


def participants(posts: DataFrame, dialect: Dialect = FLAT) -> DataFrame:
    """Activity posts per channel and user; posts without an author form one group."""
    return (
        activity(posts, dialect)
        .where(F.col("channel").isNotNull())
        .groupBy("channel", "user_id")
        .agg(F.count("*").alias("messages"))
    )


def edges_interacts_b(posts: DataFrame, dialect: Dialect = FLAT) -> DataFrame:
    """Interactions by shared channel: each post of a user with each post of another user.

    Their number grows with the square of a channel, so they are given factorized: per
    channel and source the number of target users and of edges. This is exact, and linear in
    the number of (channel, user) pairs. An unknown author differs from everyone, also from
    another unknown author. ``interacts_of`` lists the targets of chosen sources.
    """
    people = participants(posts, dialect)
    totals = people.groupBy(F.col("channel").alias("_channel")).agg(
        F.sum("messages").alias("_messages"), F.count("*").alias("_users")
    )
    known = F.col("user_id").isNotNull()
    # Null-safe, so that the join shuffles the totals again and AQE may split a large channel.
    joined = people.join(totals, F.col("channel").eqNullSafe(F.col("_channel")))
    targets = F.col("_users") - F.when(known, 1).otherwise(0)
    others = F.col("_messages") - F.when(known, F.col("messages")).otherwise(0)
    return joined.select(
        "channel", F.col("user_id").alias("source"), F.lit("interacts").alias("relate"),
        "messages", targets.cast("bigint").alias("targets"),
        (F.col("messages") * others).cast("bigint").alias("edges"),
    ).where(F.col("edges") > 0)


def interacts_of(posts: DataFrame, sources: DataFrame, dialect: Dialect = FLAT) -> DataFrame:
    """Targets of the given users (column ``user_id``): one row per channel, source and
    target with its number of edges. The result has one row per source and co-member."""
    people = participants(posts, dialect)
    chosen = people.join(sources.select("user_id").distinct(), "user_id", "left_semi")
    others = people.select(
        F.col("channel").alias("_channel"), F.col("user_id").alias("target"),
        F.col("messages").alias("_messages"),
    )
    joined = chosen.join(others, F.col("channel") == F.col("_channel"))
    return joined.where(differs(F.col("user_id"), F.col("target"))).select(
        "channel", F.col("user_id").alias("source"), "target",
        F.lit("interacts").alias("relate"),
        (F.col("messages") * F.col("_messages")).alias("weight"),
    )
