"""Posts with their authors: geography of users, and the conversation table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect
from parley.schemas import CONVERSATION_COLUMNS, POST_COLUMNS

def user_geo(
    users: DataFrame,
    zone: DataFrame | None = None,
    country: DataFrame | None = None,
    dialect: Dialect = THREADED,
) -> DataFrame:
    """Users with ``country``, ``city`` and ``iso``.

    The country named by the zone tables, else the first part of the time zone; the city is
    its second part. No join is hinted: Spark broadcasts the zone side if its size allows.
    """
    if not dialect.geo:
        return users.withColumns({c: F.lit("") for c in ("country", "city", "iso")})
    known = zone.join(country, zone["ISO"] == country["ISO2"]).select(
        zone["TZ"].alias("_tz"), zone["ISO"].alias("iso"), country["COUNTRY"].alias("_country")
    )
    parts = F.split("tz", "/")
    return (
        users.join(known, users["tz"] == F.col("_tz"), "left")
        .withColumn("country", F.coalesce("_country", F.get(parts, F.lit(0))))
        .withColumn("city", F.get(parts, F.lit(1)))
        .drop("_tz", "_country")
    )


def posts(
    messages: DataFrame, threads: DataFrame | None = None, prefer_thread: bool = False
) -> DataFrame:
    """Messages and thread replies as one table of distinct rows.

    Copies of one post which differ in any column all stay. ``prefer_thread`` keeps the rows
    of the reply page only wherever a post is in both.
    """
    both = messages.select(*POST_COLUMNS)
    if threads is not None:
        replies = threads.select(*POST_COLUMNS)
        if prefer_thread:
            keys = replies.select(F.col("channel").alias("_channel"), F.col("ts").alias("_ts")).distinct()
            # Null-safe, so that the join shuffles the keys again and AQE may split copies.
            same = F.col("channel").eqNullSafe(F.col("_channel")) & F.col("ts").eqNullSafe(F.col("_ts"))
            both = both.join(keys, same, "left_anti")
        both = both.unionByName(replies)
    return both.distinct()


def conversations(
    messages: DataFrame,
    threads: DataFrame | None,
    users: DataFrame,
    zone: DataFrame | None = None,
    country: DataFrame | None = None,
    dialect: Dialect = THREADED,
    prefer_thread: bool = False,
) -> DataFrame:
    """Posts with name and place of their author, in the columns of the conversation table."""
    authors = user_geo(users, zone, country, dialect).select(
        F.col("id").alias("_id"), "real_name", "name", "city", "country", "iso"
    )
    # Posts without an author find nobody; a key of their own keeps them from gathering as
    # nulls in one task.
    apart = F.concat(F.lit("\u0000"), F.xxhash64("channel", "ts").cast("string"))
    rows = posts(messages, threads, prefer_thread).withColumn(
        "_author", F.coalesce("user_id", apart)
    )
    joined = rows.join(authors, F.col("_author") == F.col("_id"), "left")
    return joined.withColumn("ts_int", F.col("ts").try_cast("double")).select(
        *CONVERSATION_COLUMNS
    )
