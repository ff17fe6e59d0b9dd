"""File outputs: fully quoted CSV at the edge, Parquet inside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.dialect import Dialect
from parley.functions.times import batch_time, iso_text
from parley.operators.ordered import row_index
from parley.sources.files import remove

_CSV = {"header": True, "quoteAll": True, "escape": '"', "quote": '"', "nullValue": "", "emptyValue": ""}


def write_entity(
    df: DataFrame, path: str, sort: Sequence[str] = (), index: bool = False
) -> None:
    """Overwrite a CSV table; times become ISO text. ``index`` numbers the sorted rows; the
    files then follow the order only inside, as the number says the place."""
    df = _with_iso_times(df)
    sorted_rows = f"{path}-sorted"
    if index:
        numbered = row_index(df, [*sort] or df.columns, folder=sorted_rows)
        df = numbered.select("index", *df.columns)
    elif sort:
        df = df.orderBy(*sort)
    df.write.mode("overwrite").options(**_CSV).csv(path)
    remove(df.sparkSession, sorted_rows)


def _with_iso_times(df: DataFrame) -> DataFrame:
    times = [name for name, kind in df.dtypes if kind.startswith("timestamp")]
    return df.withColumns({name: iso_text(name) for name in times})


def write_partitions(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str]) -> None:
    """Overwrite a CSV table in folders by the values of some columns, each sorted over its files;
    a large folder is cut into several."""
    ordered = _with_iso_times(df).repartitionByRange(*by, *sort).sortWithinPartitions(*by, *sort)
    ordered.write.mode("overwrite").partitionBy(*by).options(**_CSV).csv(path)


def metric_names(df: DataFrame, dialect: Dialect) -> DataFrame:
    """Column names as the product's exports have them."""
    if not dialect.upper_case:
        return df
    user = dialect.user_column
    return df.select(
        *[F.col(c).alias((user if c == "user_id" else c).upper()) for c in df.columns]
    )


def write_batch_metadata(spark: SparkSession, home: str, batch: str) -> None:
    """One row with the time of the export."""
    time = F.translate(F.substring(batch_time(F.lit(batch)).cast("string"), 1, 19), " ", "T")
    row = spark.range(1).select(time.alias("time"))
    row.coalesce(1).write.mode("overwrite").options(**_CSV).csv(f"{home}/{batch}/metadata")
