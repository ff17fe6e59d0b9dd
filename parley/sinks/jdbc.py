"""Database tables: typed overwrite with sized text columns."""

from __future__ import annotations

import configparser
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions.times import parse_iso


@dataclass(frozen=True)
class LoadSpec:
    table: str
    group: str
    # Text columns which get a sized VARCHAR where the database asks for one.
    sized: tuple[str, ...] = ()
    has_time: bool = False


# The loaded tables and their sized columns.
LOADS = {
    spec.table: spec
    for spec in (
        LoadSpec("channel_data", "master", ("name",)),
        LoadSpec("channel_ref", "master"),
        LoadSpec("reaction_data", "master", ("reaction",)),
        LoadSpec("user_data", "master", ("email", "name", "real_name")),
        LoadSpec("file_data", "master", ("name",), has_time=True),
        LoadSpec("poll_data", "master", ("text", "vote_item"), has_time=True),
        LoadSpec("conversation_data", "metrics", ("real_name", "text"), has_time=True),
        LoadSpec("tag_data", "metrics", ("tag", "nice_tag")),
        LoadSpec("node_data", "metrics"),
        LoadSpec("edge_data", "metrics"),
    )
}


def jdbc_options(text: str, section: str) -> dict[str, str]:
    """Connection options out of the text of a properties file. Never print them."""
    parser = configparser.RawConfigParser()
    parser.read_string(text)
    get = lambda key: parser.get(section, key)
    return {
        "url": get("database.url"),
        "driver": get("database.driver"),
        "user": get("database.user"),
        "password": get("database.password"),
    }


def typed_time(df: DataFrame, column: str = "time") -> DataFrame:
    """ISO text to a timestamp, moved to the end."""
    parsed = parse_iso(df[column]) if dict(df.dtypes)[column] == "string" else df[column]
    others = [c for c in df.columns if c != column]
    return df.select(*others, parsed.alias(column))


def byte_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Longest UTF-8 length of each column, all in one aggregate."""
    return df.agg(*[F.max(F.octet_length(c)).alias(c) for c in columns])


def char_lengths(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.max(F.length(c)).alias(c) for c in columns])


def size_varchar(
    df: DataFrame, columns: Sequence[str], existing: DataFrame | None = None
) -> str:
    """Column types for ``createTableColumnTypes``.

    A column is as wide as its longest value here or in the existing database table, and at
    least 1. One aggregate per side; only one row of numbers reaches the driver.
    """
    if not columns:
        return ""
    here = byte_lengths(df, columns).first()
    stored = char_lengths(existing, columns).first() if existing is not None else {}
    widths = {c: max(1, here[c] or 0, (stored[c] or 0) if stored else 0) for c in columns}
    return ", ".join(f"{c} VARCHAR({n})" for c, n in widths.items())


def load_table(
    df: DataFrame,
    spec: LoadSpec,
    options: dict[str, str],
    sized: bool = False,
    existing: DataFrame | None = None,
    connections: int = 16,
) -> None:
    """Overwrite a database table over at most ``connections`` connections. All columns of an
    edge table are loaded."""
    rows = typed_time(df) if spec.has_time else df
    # A shuffle to as many tasks as connections; without it the work above would be as narrow.
    writer = rows.repartition(connections).write.mode("overwrite").option("numPartitions", connections)
    if sized and spec.sized:
        writer = writer.option("createTableColumnTypes", size_varchar(rows, spec.sized, existing))
    properties = {k: v for k, v in options.items() if k != "url"}
    writer.jdbc(options["url"], spec.table, properties=properties)


def load_group(
    tables: dict[str, DataFrame],
    group: str,
    options: dict[str, str],
    sized: bool = False,
    existing: Callable[[str], DataFrame | None] = lambda _: None,
) -> list[str]:
    """Load every table of a group (master or metrics) which is at hand. ``existing`` gives the
    database table of a name, whose widths sized columns keep."""
    specs = [s for s in LOADS.values() if s.group == group and s.table in tables]
    for spec in specs:
        held = existing(spec.table) if sized and spec.sized else None
        load_table(tables[spec.table], spec, options, sized, held)
    return [spec.table for spec in specs]
