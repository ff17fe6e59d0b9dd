"""What leaves a workspace: CSV files and database tables."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.merge import INSERT, SPECS, UPDATE
from parley.operators.ordered import row_index
from parley.plans.workspace import MASTER, View, Workspace
from parley.sinks.files import metric_names, write_entity, write_partitions
from parley.sinks.jdbc import LOADS, load_group
from parley.sources.files import remove
from parley.sources.tables import read_jdbc


def _order(name: str) -> list[str]:
    """Sort columns, then keys, then all others: a large group of one key, such as the
    reactions to one post, is still cut between tasks, and the order is definite."""
    spec = SPECS[name]
    return list(dict.fromkeys([*spec.sort, *spec.keys, *spec.columns]))


def _sorted_path(ws: Workspace, name: str) -> str:
    return f"{ws.home}/{MASTER}/sorted/{name}"


def numbered(ws: Workspace, name: str, view: View | None = None) -> DataFrame:
    """A master table with its ``index`` in export order, as the first column. Its sorted rows
    lie in the workspace until they are removed."""
    rows = (view or ws.view()).table(name)
    return row_index(rows, _order(name), folder=_sorted_path(ws, name)).select("index", *rows.columns)


def export_tables(ws: Workspace, scope: str = MASTER, index: bool = False) -> list[str]:
    """Entity tables as CSV under ``csv`` of the scope, sorted by key."""
    table = ws.tables(scope)
    for name in ws.entities:
        path = f"{ws.home}/{scope}/csv/{name}.csv"
        write_entity(table(name), path, sort=_order(name), index=index)
    return list(ws.entities)


def export_deltas(ws: Workspace, batch: str) -> list[str]:
    """What a batch inserts into the master and updates there, as CSV next to its tables."""
    written = []
    view = ws.view()
    for name in ws.entities:
        feed = view.feed(name, [batch])
        for change in (INSERT, UPDATE):
            target = f"{name}_{change}"
            rows = feed.where(F.col("change") == change).drop("batch_id", "change")
            write_entity(rows, f"{ws.home}/{batch}/csv/{target}.csv", sort=_order(name))
            written.append(target)
    return written


def export_changes(ws: Workspace) -> list[str]:
    """The deltas of all batches of the master as CSV under ``changes``, in folders by batch and
    change: one pass over each table, where ``export_deltas`` makes one for a batch."""
    view = ws.view()
    for name in ws.entities:
        write_partitions(view.feed(name), f"{ws.home}/{MASTER}/changes/{name}", ["batch_id", "change"], _order(name))
    return list(ws.entities)


def export_metrics(ws: Workspace, names: list[str], scope: str = MASTER) -> list[str]:
    """Metrics as CSV, with the column names of the product."""
    folder = ws.home if scope == MASTER else f"{ws.home}/{scope}"
    for name in names:
        rows = metric_names(ws.metric(scope, name), ws.dialect)
        write_entity(rows, f"{folder}/metrics/csv/{name}.csv")
    return names


def database_table(ws: Workspace, options: dict[str, str], name: str) -> DataFrame | None:
    """A table as it is in the database; None where the database has none of the name."""
    try:
        return read_jdbc(ws.spark, name, options)
    except (AnalysisException, Py4JJavaError):
        return None


def load_database(ws: Workspace, options: dict[str, str], sized: bool = False) -> list[str]:
    """The master and its metrics into a database, one table after the other; ``sized`` for
    one with VARCHAR(n), whose columns stay at least as wide as they are."""
    done: list[str] = []
    view = ws.view()
    for spec in LOADS.values():
        name = spec.table
        if spec.group == "metrics":
            table = ws.metric(MASTER, name)
        elif name in ws.entities:
            table = numbered(ws, name, view)
        elif name == "channel_ref":
            table = ws.reference(name)
        else:
            continue
        done += load_group({name: table}, spec.group, options, sized, lambda n: database_table(ws, options, n))
        remove(ws.spark, _sorted_path(ws, name))
    return done
