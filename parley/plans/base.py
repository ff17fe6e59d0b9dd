"""The base of the master: the replay of some batches, in buckets of the entity key.

    <home>/master/base/log                       one row for each version
    <home>/master/base/<table>/r-<n>/gen=<m>     bucket files

A version names the batches that it holds, with the stamps of their loads, and for each bucket of
each table the generation whose file counts. So the compaction of a late batch writes only the
buckets which hold a key of it, as a new generation, and leaves all other files as they are. The
row of a version is written last; files which no version names do not count.

Rows lie in buckets by the hash of their key and, for a key with more than ``HOT_ROWS`` rows, by a
part number made of the row, so no bucket holds a very large group. Spark reads the buckets
through a table definition in the session's catalog, knows that they are partitioned, and joins
late batches to them by shuffling the late rows only.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parley.operators.merge import EntitySpec, replay
from parley.plans.manifest import append, read_log
from parley.schemas import ENTITIES

#: Rows of one key from which they are spread over several buckets.
HOT_ROWS = 1_000_000
_TABLE = "struct<name: string, root: string, buckets: int, generations: array<int>, hot: array<struct<hash: bigint, parts: int>>>"
_VERSIONS = f"number bigint, batches array<struct<batch: string, stamp: string>>, tables array<{_TABLE}>"
_PLACE = ["_hash", "_part"]
_STATE = ["batch_id", "first_id"]


def version_name(number: int) -> str:
    return f"v-{number:08d}"


@dataclass(frozen=True)
class BaseTable:
    name: str
    root: str
    buckets: int
    #: Generation of the file of each bucket.
    generations: tuple[int, ...]
    #: (hash, parts) of the keys which are spread: at most a row for every ``HOT_ROWS`` rows.
    hot: tuple[tuple[int, int], ...]


@dataclass(frozen=True)
class Version:
    number: int
    stamps: dict[str, str]
    tables: dict[str, BaseTable]


def read_versions(spark: SparkSession, home: str) -> list[Version]:
    """All versions, newest first, by one job."""
    found = []
    for row in read_log(spark, f"{home}/log", _VERSIONS):
        tables = {
            t["name"]: BaseTable(t["name"], t["root"], t["buckets"], tuple(t["generations"]), tuple((h["hash"], h["parts"]) for h in t["hot"]))
            for t in row["tables"]
        }
        found.append(Version(row["number"], {b["batch"]: b["stamp"] for b in row["batches"]}, tables))
    return sorted(found, key=lambda v: -v.number)


def write_version(spark: SparkSession, home: str, version: Version) -> None:
    tables = [(t.name, t.root, t.buckets, list(t.generations), [*t.hot]) for t in version.tables.values()]
    append(spark, f"{home}/log", [(version.number, sorted(version.stamps.items()), tables)], _VERSIONS)


# -- bucket files -------------------------------------------------------------------------------


def _schema(name: str) -> StructType:
    schema = StructType([*ENTITIES[name].fields])
    for column in (*_STATE, "_hash"):
        schema = schema.add(column, "long")
    return schema.add("_part", "integer")


def _definition(spark: SparkSession, table: BaseTable) -> str:
    """The name of the table in the catalog of the session, which gets to know it if needed."""
    known = f"parley_base_{hashlib.md5(table.root.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(table.name))
    place = table.root.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {known} ({columns}, gen INT) USING parquet PARTITIONED BY (gen)"
        f" CLUSTERED BY ({', '.join(_PLACE)}) INTO {table.buckets} BUCKETS LOCATION '{place}'"
    )
    spark.catalog.refreshTable(known)
    return known


def _bucket(buckets: int) -> Column:
    """The bucket of a row, as Spark numbers them."""
    return F.pmod(F.hash(*_PLACE), F.lit(buckets))


def read_base(spark: SparkSession, table: BaseTable, only: list[int] | None = None) -> DataFrame:
    """The rows of a base table with their state and place; ``only`` those of some buckets, whose
    files alone are opened."""
    rows = spark.table(_definition(spark, table))
    if only is not None:
        number = F.regexp_extract("_metadata.file_name", r"_(\d+)(?:\.c\d+)?\.[^_]*$", 1).cast("int")
        rows = rows.where(number.isin(only))
    counting = sorted(set(table.generations))
    rows = rows.where(F.col("gen").isin(counting))
    if len(counting) > 1:
        rows = rows.where(F.col("gen") == F.get(F.lit(list(table.generations)), _bucket(table.buckets)))
    return rows.drop("gen")


def _hot(spark: SparkSession, table: BaseTable) -> DataFrame:
    return spark.createDataFrame([*table.hot], "_hash bigint, _parts int")


def _hashed(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    return rows.withColumn("_hash", F.xxhash64(*spec.keys))


def _placed(rows: DataFrame, spec: EntitySpec, hot: DataFrame) -> DataFrame:
    """Rows with the part in which they lie."""
    part = F.pmod(F.xxhash64(*spec.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    return rows.join(F.broadcast(hot), "_hash", "left").withColumn("_part", part).drop("_parts")


def _write(spark: SparkSession, rows: DataFrame, table: BaseTable, generation: int) -> None:
    """One file for each bucket that has rows."""
    known = _definition(spark, table)
    columns = [*_schema(table.name).names, "gen"]
    placed = rows.repartition(table.buckets, *_PLACE).withColumn("gen", F.lit(generation)).select(*columns)
    placed.write.mode("append").format("parquet").partitionBy("gen").bucketBy(table.buckets, *_PLACE).saveAsTable(known)


def write_base(spark: SparkSession, home: str, spec: EntitySpec, state: DataFrame, number: int, buckets: int) -> BaseTable:
    """A base table out of the rows of ``replay(..., state=True)``, which should be cheap to read
    twice: once to find the keys which are to be spread."""
    rows = _hashed(state, spec)
    sizes = rows.groupBy("_hash").count().where(F.col("count") > HOT_ROWS)
    hot = tuple((r["_hash"], -(-r["count"] // HOT_ROWS)) for r in sizes.collect())
    table = BaseTable(spec.name, f"{home}/{spec.name}/r-{number:08d}", buckets, (number,) * buckets, hot)
    _write(spark, _placed(rows, spec, _hot(spark, table)), table, number)
    return table


# -- late batches -------------------------------------------------------------------------------


def _equal(left: str, right: str) -> Column:
    """Equal structs, nulls included, in a form which does not take part in the partitioning."""
    return (F.col(left) >= F.col(right)) & (F.col(left) <= F.col(right))


def _per_key(rows: DataFrame, spec: EntitySpec, key: str, prefix: str) -> DataFrame:
    """The last and the first batch of each key, with the values of the first."""
    return rows.groupBy("_hash", F.col(key).alias(f"{prefix}key")).agg(
        F.max("batch_id").alias(f"{prefix}last"),
        F.min("first_id").alias(f"{prefix}first"),
        *[F.min(F.struct("first_id", F.col(c).isNull(), F.col(c).alias("value")))["value"].alias(prefix + c) for c in spec.keep_first],
    )


def _later(rows: DataFrame, spec: EntitySpec, prefix: str) -> DataFrame:
    """The rows whose own batch is the last of their key, with the first of both sides."""
    others = F.col(f"{prefix}key").isNotNull()
    earlier = others & (F.col(f"{prefix}first") < F.col("first_id"))
    kept = {c: F.when(earlier, F.col(prefix + c)).otherwise(F.col(c)).alias(c) for c in spec.keep_first}
    columns = [kept.get(c, F.col(c)) for c in spec.columns]
    first = F.when(earlier, F.col(f"{prefix}first")).otherwise(F.col("first_id")).alias("first_id")
    stays = ~others | (F.col("batch_id") > F.col(f"{prefix}last"))
    return rows.where(stays).select(*columns, "batch_id", first, *_PLACE)


def _parts_of_keys(spark: SparkSession, table: BaseTable, keys: DataFrame) -> DataFrame:
    """Each key once for every part in which rows of it may lie."""
    spread = keys.join(F.broadcast(_hot(spark, table)), "_hash", "left")
    return spread.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")


def joined(spark: SparkSession, table: BaseTable, late: DataFrame, spec: EntitySpec, only: list[int] | None = None) -> DataFrame:
    """The replay of a base and of late batches of any age, as state rows with their place.

    The late rows are replayed on their own and win where their last batch is younger than that
    of the base. The base is joined where it lies; late rows and keys are shuffled. ``late`` holds
    ``batch_id``; batches of the base must not be among them.
    """
    state = _hashed(replay(late.withColumn("first_id", F.col("batch_id")), spec, first="first_id", state=True), spec)
    state = _placed(state, spec, _hot(spark, table)).withColumn("_key", F.struct(*spec.keys))
    keys = _parts_of_keys(spark, table, _per_key(state, spec, "_key", "_l_"))
    base = read_base(spark, table, only).withColumn("_key", F.struct(*spec.keys))
    matched = keys.withColumnsRenamed({"_hash": "_l_hash", "_part": "_l_part"})
    same = (F.col("_hash") == F.col("_l_hash")) & (F.col("_part") == F.col("_l_part")) & _equal("_key", "_l_key")
    from_base = _later(base.join(matched, same, "left"), spec, "_l_")
    # Only the keys which late batches touch come out of the base a second time.
    touched = base.join(matched, same).select("_hash", "_key", *_STATE, *spec.keep_first)
    known = _per_key(touched, spec, "_key", "_b_").withColumnRenamed("_hash", "_b_hash")
    same = (F.col("_hash") == F.col("_b_hash")) & _equal("_key", "_b_key")
    from_late = _later(state.join(known, same, "left"), spec, "_b_")
    if only is not None:
        from_late = from_late.where(_bucket(table.buckets).isin(only))
    return from_base.unionByName(from_late)


def touched_buckets(spark: SparkSession, table: BaseTable, late: DataFrame, spec: EntitySpec) -> list[int]:
    """Numbers of the buckets in which rows of late keys lie, or would."""
    keys = _hashed(late.select(*spec.keys), spec).select("_hash").distinct()
    places = _parts_of_keys(spark, table, keys).select(_bucket(table.buckets).alias("bucket")).distinct()
    return sorted(r["bucket"] for r in places.collect())


def update_base(spark: SparkSession, table: BaseTable, late: DataFrame, spec: EntitySpec, number: int) -> BaseTable:
    """The base table with late batches: only buckets which hold keys of them are written."""
    touched = touched_buckets(spark, table, late, spec)
    if not touched:
        return table
    _write(spark, joined(spark, table, late, spec, touched), table, number)
    generations = [number if b in set(touched) else g for b, g in enumerate(table.generations)]
    return BaseTable(table.name, table.root, table.buckets, tuple(generations), table.hot)
