"""Folding batches into the master tables: insert, update, never delete.

A key of the incoming batch replaces every master row of that key, so a key which is not
unique (reactions by message id) is replaced as a group. Nulls in keys match each other.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.schemas import ENTITIES

INSERT, UPDATE, UNCHANGED = "insert", "update", "unchanged"


@dataclass(frozen=True)
class EntitySpec:
    name: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    # Columns in which the first value ever seen stays.
    keep_first: tuple[str, ...] = ()
    # Order of an export; the keys where empty.
    sort: tuple[str, ...] = ()


def _spec(name: str, *keys: str, keep_first: Sequence[str] = (), sort: Sequence[str] = ()) -> EntitySpec:
    return EntitySpec(name, keys, tuple(ENTITIES[name].names), tuple(keep_first), tuple(sort))


# Keys of the entity tables.
SPECS = {
    "user_data": _spec("user_data", "id", keep_first=["batch"], sort=["batch"]),
    "channel_data": _spec("channel_data", "id"),
    "message_data": _spec("message_data", "channel", "ts"),
    "thread_data": _spec("thread_data", "channel", "ts"),
    "reaction_data": _spec("reaction_data", "ts"),
    "file_data": _spec("file_data", "id", "channel"),
    "poll_data": _spec("poll_data", "poll_id", "vote_item"),
    "role_data": _spec("role_data", "id"),
}

# The tables each product merges.
THREADED_ENTITIES = (
    "user_data", "channel_data", "message_data", "thread_data", "reaction_data",
    "file_data", "poll_data",
)
FLAT_ENTITIES = (
    "user_data", "channel_data", "message_data", "reaction_data", "file_data", "role_data",
)


def _renamed(df: DataFrame, columns: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in columns])


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def _tagged_incoming(master: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:
    """Distinct incoming rows with ``_change``, first-seen values taken over from master."""
    rows = incoming.select(*spec.columns).distinct()
    # One row per key, aggregated before the shuffle: a large key group stays cheap.
    known = (
        _renamed(master, [*spec.keys, *spec.keep_first], "_m_")
        .groupBy(*["_m_" + k for k in spec.keys])
        .agg(F.lit(True).alias("_known"), *[F.min("_m_" + c).alias("_m_" + c) for c in spec.keep_first])
    )
    joined = rows.join(known, _same_key(spec.keys, "_m_"), "left")
    for c in spec.keep_first:
        joined = joined.withColumn(c, F.when(F.col("_known"), F.col("_m_" + c)).otherwise(F.col(c)))
    change = F.when(F.col("_known"), UPDATE).otherwise(INSERT)
    tagged = joined.withColumn("_change", change).select(*spec.columns, "_change")
    # Rows which differed only in a first-seen column have become equal.
    return tagged.distinct() if spec.keep_first else tagged


def _untouched(master: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:
    arriving = _renamed(incoming, spec.keys, "_i_").distinct()
    return master.select(*spec.columns).join(
        arriving, _same_key(spec.keys, "_i_"), "left_anti"
    )


def changes(
    master: DataFrame, incoming: DataFrame, spec: EntitySpec, distinct_master: bool = False
) -> DataFrame:
    """The new master with ``_change``: insert, update or unchanged.

    ``distinct_master`` says that master has no equal rows, as every result of ``upsert``
    and ``replay``; it saves the one shuffle over whole master rows.
    """
    kept = _untouched(master, incoming, spec)
    if not distinct_master:
        kept = kept.distinct()
    kept = kept.withColumn("_change", F.lit(UNCHANGED))
    return kept.unionByName(_tagged_incoming(master, incoming, spec))


def upsert(
    master: DataFrame, incoming: DataFrame, spec: EntitySpec, distinct_master: bool = False
) -> DataFrame:
    return changes(master, incoming, spec, distinct_master).drop("_change")


def insert_delta(master: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:
    """Distinct incoming rows whose key is new."""
    rows = incoming.select(*spec.columns).distinct()
    known = _renamed(master, spec.keys, "_m_").distinct()
    return rows.join(known, _same_key(spec.keys, "_m_"), "left_anti")


def update_delta(master: DataFrame, incoming: DataFrame, spec: EntitySpec) -> DataFrame:
    """Distinct incoming rows whose key is known, with the first-seen values of master."""
    tagged = _tagged_incoming(master, incoming, spec)
    return tagged.where(F.col("_change") == UPDATE).drop("_change")


def merge_counts(tagged: DataFrame) -> DataFrame:
    """Rows inserted, updated and unchanged, from the frame of ``changes``."""
    return tagged.groupBy(F.col("_change").alias("change")).agg(F.count("*").alias("rows"))


def replay(
    batches: DataFrame,
    spec: EntitySpec,
    batch: str = "batch_id",
    first: str | None = None,
    state: bool = False,
) -> DataFrame:
    """The master which sequential upserts of all batches, in order of ``batch``, would give.

    The rows of a key are those of its last batch. That batch comes from an aggregate which
    reduces before the shuffle, and is joined back; so a key with very many rows never meets
    in one window group, and AQE may split it in the join.

    With ``state`` the rows also carry ``batch_id``, the last batch of their key, and
    ``first_id``, its first; such rows, with ``first`` naming the latter, can be replayed
    together with further batches of any age.
    """
    first = first or batch
    last = batches.groupBy(*[F.col(k).alias("_l_" + k) for k in spec.keys]).agg(
        F.max(batch).alias("_last"),
        F.min(first).alias("_first"),
        *[F.min_by(c, F.col(first)).alias("_first_" + c) for c in spec.keep_first],
    )
    joined = batches.join(
        last, _same_key(spec.keys, "_l_") & (F.col(batch) == F.col("_last")), "inner"
    )
    kept = {c: F.col("_first_" + c) for c in spec.keep_first}
    columns = [kept.get(c, F.col(c)).alias(c) for c in spec.columns]
    if state:
        columns += [F.col("_last").alias("batch_id"), F.col("_first").alias("first_id")]
    return joined.select(*columns).distinct()
