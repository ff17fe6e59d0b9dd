"""Users, channels and links mentioned in posts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect
from parley.operators.filters import activity


def _day(posts: DataFrame) -> list[str]:
    return [c for c in ("day",) if c in posts.columns]


def mentions(
    posts: DataFrame, dialect: Dialect = THREADED, only: Sequence[str] = ("user", "channel", "link")
) -> DataFrame:
    """One row per match in the text of activity posts: channel, ts, tag, nice_tag, type.

    The kinds asked for come out of one scan of the text. Tag and label stand around the first
    pipe; a user tag stays whole, also with a pipe, and its label is looked up later. Posts
    which carry their ``day`` pass it on.
    """
    day = _day(posts)
    patterns = {"user": dialect.user_tag, "channel": dialect.channel_tag, "link": dialect.link_tag}
    kinds = [
        F.struct(
            F.lit(kind).alias("type"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(1)).alias("matches"),
        )
        for kind, pattern in patterns.items()
        if pattern and kind in only
    ]
    # A product may lack the kinds asked for.
    kinds = kinds or [F.struct(F.lit("").alias("type"), F.array().cast("array<string>").alias("matches"))]
    found = (
        activity(posts, dialect)
        .where(F.col("text").contains("<"))
        .select("channel", "ts", *day, F.explode(F.array(*kinds)).alias("k"))
        .select("channel", "ts", *day, "k.type", F.explode("k.matches").alias("match"))
    )
    match, is_user = F.col("match"), F.col("type") == "user"
    is_link = (match != "") & ~match.startswith("@") & ~match.startswith("#")
    label = F.when(~is_user & match.contains("|"), F.split_part(match, F.lit("|"), F.lit(2)))
    return found.where((F.col("type") != "link") | is_link).select(
        "channel",
        "ts",
        F.when(is_user, match).otherwise(F.substring_index(match, "|", 1)).alias("tag"),
        label.alias("nice_tag"),
        "type",
        *day,
    )


def extract_tags(posts: DataFrame, users: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    """Mentions with the name of mentioned users.

    Only user tags are joined. The texts are read twice, each time for other patterns, which
    costs less than to shuffle tags that can match no user.
    """
    names = users.select(F.col("id").alias("_id"), F.col("real_name").alias("_name"))
    named = mentions(posts, dialect, ["user"]).join(names, F.col("tag") == F.col("_id"), "left")
    columns = ["channel", "ts", "tag", F.coalesce("nice_tag", "_name").alias("nice_tag"), "type", *_day(posts)]
    others = mentions(posts, dialect, ["channel", "link"])
    return named.select(*columns).unionByName(others)
