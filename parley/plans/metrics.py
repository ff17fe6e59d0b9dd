"""Conversations and tags of the master by day, derived anew only where batches touched them.

Both tables lie in partitions by the day of the post. What they were derived from, the steps of
each batch, is kept in a log; the next derivation looks only at rows of steps which have come
since. A day is touched

- if a post of such a row falls on it, or fell on it before,
- if a post on it was written by a user who changed in these steps, or, for tags, names one.

Touched days are derived from the master, written, and take the place of their partitions; files
of all other days stay as they are. Everything is derived anew where that cannot be told: the
first time, after a batch was loaded again, or when the zone tables changed. A derivation that
fails has not been logged, and its days are touched again by the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parley.operators import posts, tags
from parley.plans.loading import write_table
from parley.plans.manifest import BatchState, Manifest, append, read_log
from parley.plans.workspace import MASTER, View, Workspace
from parley.schemas import BY_DAY
from parley.sources.files import exists, remove

_LOG = """number bigint, places string,
    batches array<struct<batch: string, stamp: string, tables: array<string>, shown: array<string>>>"""
_TABLES = tuple(BY_DAY)


def day(time: str = "time") -> Column:
    """The partition of a post; posts without a time have one of their own."""
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none"))


def _log_path(ws: Workspace) -> str:
    return f"{ws.home}/{MASTER}/derived"


def _derived(ws: Workspace) -> tuple[Manifest, str] | None:
    """The state of the batches from which the tables were last derived, and of the zone tables."""
    rows = read_log(ws.spark, _log_path(ws), _LOG)
    if not rows:
        return None
    last = max(rows, key=lambda r: r["number"])
    states = {
        b["batch"]: BatchState(b["stamp"], True, frozenset(b["tables"]), frozenset(), frozenset(b["shown"])) for b in last["batches"]
    }
    return Manifest(states, last["number"]), last["places"]


def _places(ws: Workspace) -> str:
    """A number for the content of the zone tables."""
    if not ws.dialect.geo:
        return ""
    found = [ws.reference(name).agg(F.count("*"), F.bit_xor(F.xxhash64("*"))).first() for name in ("zone", "country")]
    return str([tuple(r) for r in found])


def new_steps(old: Manifest, now: Manifest) -> dict[str, frozenset[str]] | None:
    """Steps of merged batches that came since; None if steps have gone."""
    merged = set(now.merged())
    if any(b not in merged or not old.state(b).shown <= now.state(b).shown for b in old.batches):
        return None
    added = {b: now.state(b).shown - old.state(b).shown for b in merged}
    return {b: steps for b, steps in added.items() if steps}


def _conversations(ws: Workspace, table: Callable[[str], DataFrame], days: list[str] | None) -> DataFrame:
    dialect = ws.dialect
    zone, country = (ws.reference("zone"), ws.reference("country")) if dialect.geo else (None, None)
    said = [table(name) for name in ("message_data", "thread_data") if name in ws.entities]
    if days is not None:
        said = [rows.where(day().isin(days)) for rows in said]
    rows = posts.conversations(said[0], said[1] if len(said) > 1 else None, table("user_data"), zone, country, dialect)
    return rows.withColumn("day", day())


def _stored(ws: Workspace, name: str) -> DataFrame:
    schema = StructType([*BY_DAY[name].fields]).add("day", "string")
    return ws.spark.read.schema(schema).parquet(ws.metric_path(MASTER, name))


def _days(rows: DataFrame) -> set[str]:
    """At most one row for each day leaves the cluster."""
    return {r["day"] for r in rows.select("day").distinct().collect()}


def changed_users(view: View, before: View, steps: dict[str, frozenset[str]]) -> DataFrame | None:
    """Ids of users in new steps whose rows in the master are not what they were."""
    arrived = view.rows("user_data", sorted(steps), steps)
    if arrived is None:
        return None
    ids = arrived.select(F.col("id").alias("_id")).distinct()
    now, then = (
        v.table("user_data").join(ids, F.col("id") == F.col("_id"), "left_semi") for v in (view, before)
    )
    return now.exceptAll(then).unionByName(then.exceptAll(now)).select(F.col("id").alias("_user")).distinct()


def touched_days(ws: Workspace, view: View, before: View, steps: dict[str, frozenset[str]]) -> dict[str, list[str]]:
    """Days of each table which rows of new steps concern."""
    conversation, tag = (_stored(ws, name) for name in _TABLES)
    found: set[str] = set()
    for name in ("message_data", "thread_data"):
        arrived = view.rows(name, sorted(steps), steps) if name in ws.entities else None
        if arrived is not None:
            keys = arrived.select(F.col("channel").alias("_channel"), F.col("ts").alias("_ts"), day().alias("_day"))
            same = F.col("channel").eqNullSafe(F.col("_channel")) & F.col("ts").eqNullSafe(F.col("_ts"))
            found |= _days(keys.select(F.col("_day").alias("day")))
            found |= _days(conversation.join(keys, same & (F.col("day") != F.col("_day")), "left_semi"))
    users, named = changed_users(view, before, steps), set()
    if users is not None:
        found |= _days(conversation.join(users, F.col("user_id") == F.col("_user"), "left_semi"))
        named = _days(tag.where("type = 'user'").join(users, F.col("tag") == F.col("_user"), "left_semi"))
    return {"conversation_data": sorted(found), "tag_data": sorted(found | named)}


def _replace(ws: Workspace, name: str, rows: DataFrame, days: list[str] | None) -> None:
    """Write some days of a table, or all of it. A day which has no rows left goes."""
    path = ws.metric_path(MASTER, name)
    if days is None:
        write_table(rows, path, "day", whole=True)
        return
    # Written first, so that the rows are made once and readers see no half of them.
    place = f"{ws.home}/{MASTER}/deriving/{name}"
    write_table(rows, place)
    made = ws.spark.read.schema(rows.schema).parquet(place)
    write_table(made, path, "day")
    for gone in set(days) - _days(made):
        remove(ws.spark, f"{path}/day={gone}")
    remove(ws.spark, place)


def refresh(ws: Workspace, view: View, whole: bool = False) -> dict[str, list[str] | None]:
    """Derive conversations and tags of the master; the days that were written, None for all."""
    known, places = _derived(ws), _places(ws)
    steps = new_steps(known[0], view.manifest) if known and known[1] == places else None
    if whole or steps is None or not all(exists(ws.spark, f"{ws.metric_path(MASTER, n)}/_SUCCESS") for n in _TABLES):
        days: dict[str, list[str] | None] = dict.fromkeys(_TABLES)
    else:
        days = touched_days(ws, view, View(ws, known[0], view.versions), steps)
    for name, of in days.items():
        if of == []:
            continue
        if name == "conversation_data":
            rows = _conversations(ws, view.table, of)
        else:
            said = _stored(ws, "conversation_data")
            said = said if of is None else said.where(F.col("day").isin(of))
            rows = tags.extract_tags(said, view.table("user_data"), ws.dialect)
        _replace(ws, name, rows, of)
    merged = view.manifest.merged()
    states = [(b, s.stamp, sorted(s.tables), sorted(s.shown)) for b in merged for s in [view.manifest.state(b)]]
    if steps is None or steps or whole:
        append(ws.spark, _log_path(ws), [((known[0].last if known else 0) + 1, places, states)], _LOG)
    return days
