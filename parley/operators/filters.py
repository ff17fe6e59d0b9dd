"""Predicates shared by the metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.dialect import THREADED, Dialect


def is_activity(dialect: Dialect = THREADED, subtype: str = "subtype") -> Column:
    """Posts written by a person: never null, so it can be negated and counted."""
    column = F.col(subtype)
    tests = [
        column.isNull() if value is None else column.eqNullSafe(value)
        for value in dialect.activity_subtypes
    ]
    return reduce(lambda a, b: a | b, tests)


def activity(df: DataFrame, dialect: Dialect = THREADED) -> DataFrame:
    return df.where(is_activity(dialect))


def threaded(df: DataFrame) -> DataFrame:
    return df.where(F.col("thread_ts").isNotNull())


def differs(a: Column, b: Column) -> Column:
    """Inequality in which null differs from everything, also from null."""
    return F.coalesce(a != b, F.lit(True))


def has_replies(column: Column | None = None) -> Column:
    column = F.col("reply_count") if column is None else column
    return F.coalesce(column > 0, F.lit(False))
