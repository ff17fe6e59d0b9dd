"""Stored tables: entity and reference CSV files, and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from parley.schemas import ENTITIES, REFERENCES
from parley.sources.files import exists

# Only an empty field is null: words such as NA or None are data.
_CSV = {"header": True, "multiLine": True, "escape": '"', "quote": '"', "nullValue": ""}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table of the given schema; an absent file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).options(**_CSV).csv(path)


def read_entity(
    spark: SparkSession, home: str, key: str, name: str, schema: StructType | None = None
) -> DataFrame:
    return read_csv(spark, f"{home}/{key}/{name}.csv", schema or ENTITIES[name])


def read_reference(
    spark: SparkSession, home: str, name: str, schema: StructType | None = None
) -> DataFrame:
    return read_csv(spark, f"{home}/references/{name}.csv", schema or REFERENCES[name])


def read_jdbc(spark: SparkSession, table: str, options: dict[str, str]) -> DataFrame:
    """A database table; ``options`` as given by ``parley.sinks.jdbc.jdbc_options``."""
    properties = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], table, properties=properties)
