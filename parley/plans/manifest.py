"""The manifest of a workspace: what happened to its batches, one small row for each event.

Events are only ever added, so a failure in between loses nothing. They are read by one job,
whatever the number of batches, and folded by their number:

- ``loading``: a step of a batch is being written; what was loaded before still counts;
- ``loaded``: it is complete, under a new stamp, with the names of the tables, the steps whose
  pages the batch consists of, and the steps whose rows its tables show;
- ``merged``: the batch belongs to the master.

One run at a time writes to a workspace.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Row, SparkSession

from parley.sources.files import exists

LOADING, LOADED, MERGED = "loading", "loaded", "merged"
_EVENTS = """number bigint, event string, batch string, stamp string, tables array<string>,
    steps array<string>, shown array<string>"""


@dataclass(frozen=True)
class BatchState:
    #: Of the last complete load.
    stamp: str | None = None
    merged: bool = False
    tables: frozenset[str] = frozenset()
    steps: frozenset[str] = frozenset()
    shown: frozenset[str] = frozenset()
    #: A step was begun after the last complete load.
    pending: bool = False


@dataclass(frozen=True)
class Manifest:
    batches: dict[str, BatchState]
    #: Number of the last event.
    last: int = 0

    def merged(self) -> list[str]:
        """The batches of the master, oldest first."""
        return sorted(b for b, state in self.batches.items() if state.merged)

    def state(self, batch: str) -> BatchState:
        return self.batches.get(batch, BatchState())


def fold(events: Sequence[Row]) -> Manifest:
    batches: dict[str, BatchState] = {}
    last = 0
    for row in sorted(events, key=lambda e: e["number"]):
        state = batches.get(row["batch"], BatchState())
        if row["event"] == LOADING:
            state = replace(state, pending=True)
        elif row["event"] == LOADED:
            lists = {name: frozenset(row[name] or ()) for name in ("tables", "steps", "shown")}
            state = replace(state, stamp=row["stamp"], pending=False, **lists)
        elif row["event"] == MERGED:
            state = replace(state, merged=True)
        batches[row["batch"]] = state
        last = row["number"]
    return Manifest(batches, last)


def read_log(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """All rows of an append-only log, by one job."""
    return spark.read.schema(schema).json(path).collect() if exists(spark, path) else []


def append(spark: SparkSession, path: str, rows: Sequence[tuple], schema: str) -> None:
    """Rows in a file of their own, which appears as a whole."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    return fold(read_log(spark, path, _EVENTS))


def record(
    spark: SparkSession,
    path: str,
    event: str,
    batches: Sequence[str],
    stamp: str | None = None,
    tables: Sequence[str] = (),
    steps: Mapping[str, Iterable[str]] | None = None,
    shown: Mapping[str, Iterable[str]] | None = None,
) -> None:
    """Add an event for each of the batches."""
    number = read_manifest(spark, path).last
    lists = [(sorted(tables), sorted((steps or {}).get(b, ())), sorted((shown or {}).get(b, ()))) for b in batches]
    rows = [(number + i, event, batch, stamp, *of) for i, (batch, of) in enumerate(zip(batches, lists), 1)]
    if rows:
        append(spark, path, rows, _EVENTS)
