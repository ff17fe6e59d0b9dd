"""Stage 1: raw pages to entity tables, step by step.

Decoded pages, parsed posts and the rows of the tables lie in partitions by batch and step. A full
load of a batch is one step, which replaces all earlier ones; a stream adds a step for each
arrival of pages, whatever the number of batches in it. A step decodes and parses only its own
pages and adds only rows which they bring: those of its pages, and replies of earlier pages whose
parent is announced now. All its batches are written together. A step counts when the manifest
names it, with all tables or not at all; partitions which it does not name are left-overs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.merge import SPECS
from parley.plans.manifest import LOADED, LOADING, record
from parley.plans.workspace import Workspace, chosen_steps
from parley.schemas import ENTITIES, MESSAGES_PAGE
from parley.sinks.files import write_batch_metadata
from parley.sources import page_tables
from parley.sources.files import exists, glob_names, remove
from parley.sources.pages import LIST_FIELDS, PAGE_PREFIXES, normalize_pages_to_json, page_faults, page_kind, read_pages
from parley.sources.tables import read_entity

_PARTS = "batch_id string, step string"
_DECODED = f"file_name string, json string, {_PARTS}, kind string"

Steps = dict[str, frozenset[str]]


def write_table(df: DataFrame, path: str, *by: str, whole: bool = False) -> None:
    """Overwrite a table, or of a partitioned one the partitions which the rows fall into; with
    ``whole`` all of them."""
    # Readers take a table for complete by its success marker, if no manifest says so.
    marked = df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
    if by and not whole:
        marked = marked.option("partitionOverwriteMode", "dynamic")
    marked.mode("overwrite").partitionBy(*by).parquet(path)


def _decoded(ws: Workspace, steps: Steps) -> DataFrame:
    if not exists(ws.spark, ws.pages_root):
        return ws.spark.createDataFrame([], _DECODED)
    return ws.spark.read.schema(_DECODED).parquet(ws.pages_root).where(chosen_steps(steps))


def unreadable(ws: Workspace, batch: str) -> DataFrame:
    """(file_name, reason) of the pages of a batch which give no rows of their kind: those
    that could not be decoded, and those without the list that their kind holds."""
    pages = _decoded(ws, {batch: ws.manifest().state(batch).steps}).drop("batch_id", "step")
    return page_faults(pages, LIST_FIELDS if ws.dialect.threads else {})


def load_batch(ws: Workspace, batch: str, poll_channel: str | None = None, redact: bool = False) -> list[str]:
    """Entity tables of a batch from all its pages. ``redact`` empties what was said in private
    channels.

    A table given as CSV under ``given`` of the batch takes the place of the one from pages;
    tables which no page holds come in this way only.
    """
    _remove_leftovers(ws, batch)
    pages = read_pages(ws.spark, ws.home, batch).withColumn("batch_id", F.lit(batch))
    add_step(ws, pages, f"load-{uuid.uuid4().hex}", [batch], poll_channel, redact, fresh=True)
    tables = ws.manifest().state(batch).tables
    return [name for name in ws.entities if name in tables]


def _remove_leftovers(ws: Workspace, batch: str) -> None:
    """Delete partitions of a batch which do not count any more."""
    state = ws.manifest().state(batch)
    for root in [ws.pages_root, *map(ws.typed_root, ("messages", "threads")), *map(ws.table_root, ws.entities)]:
        for name in glob_names(ws.spark, f"{root}/batch_id={batch}/step=*"):
            if name.removeprefix("step=") not in state.steps | state.shown:
                remove(ws.spark, f"{root}/batch_id={batch}/{name}")


def add_step(
    ws: Workspace,
    pages: DataFrame,
    step: str,
    batches: Sequence[str],
    poll_channel: str | None = None,
    redact: bool = False,
    fresh: bool = False,
) -> None:
    """Add pages (batch_id, file_name, value) of some batches. Pages which the batch has already
    are left out. ``fresh`` takes them for all pages of their batches.

    ``pages`` is evaluated once. A step which is repeated after a failure overwrites itself.
    Where private channels are redacted, the tables of a batch are made of all its parsed pages
    at each step, as a channel may turn out to be private later than its posts arrive.
    """
    manifest = ws.manifest()
    states = {b: manifest.state(b) for b in batches}
    earlier = {} if fresh else {b: s.steps - {step} for b, s in states.items() if s.steps - {step}}
    shown = {} if fresh or redact else {b: s.shown - {step} for b, s in states.items()}
    record(ws.spark, ws.manifest_path, LOADING, batches)
    _write_pages(ws, pages, step, earlier)
    new = {b: frozenset([step]) for b in batches}
    if ws.dialect.threads:
        for kind in ("messages", "threads"):
            parsed = page_tables.typed_pages(_of_kind(_decoded(ws, new), kind)).withColumn("step", F.lit(step))
            write_table(parsed, ws.typed_root(kind), "batch_id", "step")
    if redact:
        new, old = {b: earlier.get(b, frozenset()) | {step} for b in batches}, {}
    else:
        old = earlier
    tables = _tables(ws, new, old, poll_channel, redact)
    for batch in batches:
        _take_given(ws, tables, batch, bool(old.get(batch)))
    for name, rows in tables.items():
        chosen = rows.select(*ENTITIES[name].names, "batch_id").withColumn("step", F.lit(step))
        write_table(chosen, ws.table_root(name), "batch_id", "step")
    for batch in batches:
        if not states[batch].steps:
            write_batch_metadata(ws.spark, ws.home, batch)
    steps = {b: earlier.get(b, frozenset()) | {step} for b in batches}
    shown = {b: shown.get(b, frozenset()) | {step} for b in batches}
    stamp = uuid.uuid4().hex
    record(ws.spark, ws.manifest_path, LOADED, batches, stamp, list(tables), steps, shown)


def _write_pages(ws: Workspace, pages: DataFrame, step: str, earlier: Steps) -> None:
    if earlier:
        names = _decoded(ws, earlier).select("batch_id", "file_name")
        pages = pages.join(names, ["batch_id", "file_name"], "left_anti")
    known = normalize_pages_to_json(pages).withColumn("kind", page_kind()).where(F.col("kind").isNotNull())
    write_table(known.withColumn("step", F.lit(step)), ws.pages_root, "batch_id", "step", "kind")


def _of_kind(pages: DataFrame, kind: str) -> DataFrame:
    return pages.where(F.col("kind") == kind).drop("step", "kind")


def _typed(ws: Workspace, kind: str, steps: Steps) -> DataFrame:
    schema = f"file_name string, page struct<{MESSAGES_PAGE}>, {_PARTS}"
    if not exists(ws.spark, ws.typed_root(kind)):
        return ws.spark.createDataFrame([], schema).drop("step")
    return ws.spark.read.schema(schema).parquet(ws.typed_root(kind)).where(chosen_steps(steps)).drop("step")


def _batch_id() -> Column:
    return F.col("batch_id")


def _tables(ws: Workspace, new: Steps, old: Steps, poll_channel: str | None, redact: bool) -> dict[str, DataFrame]:
    """The rows which new steps bring to the tables of their batches."""
    decoded = _decoded(ws, new)
    pages = {kind: _of_kind(decoded, kind) for kind in PAGE_PREFIXES}
    if not ws.dialect.threads:
        return {
            "user_data": page_tables.flat_users(pages["users"]),
            "channel_data": page_tables.flat_channels(pages["channels"]),
            "message_data": page_tables.flat_messages(pages["flat_messages"]),
            "file_data": page_tables.flat_files(pages["files"]),
        }
    history, answers = _typed(ws, "messages", new), _typed(ws, "threads", new)
    threads = page_tables.threads_from_pages(history, answers, ws.zone)
    reactions = page_tables.reactions_from_messages(history, answers)
    if old:
        known, before = _typed(ws, "messages", old), _typed(ws, "threads", old)
        # New replies to parents announced before, and earlier replies to parents announced now.
        threads = (
            page_tables.threads_from_pages(history.unionByName(known), answers, ws.zone)
            .unionByName(page_tables.threads_from_pages(history, before, ws.zone, known=known))
        )
        reactions = (
            page_tables.reactions_from_messages(history, answers)
            .unionByName(page_tables.reactions_of_replies(known, answers))
            .unionByName(page_tables.reactions_of_replies(history, before, known=known))
            .distinct()
        )
    tables = {
        "user_data": page_tables.users_from_pages(pages["users"], _batch_id()),
        "channel_data": page_tables.channels_from_pages(pages["channels"]),
        "message_data": page_tables.messages_from_pages(history, ws.zone),
        "thread_data": threads,
        "reaction_data": reactions,
        "file_data": page_tables.files_from_pages(pages["files"], ws.zone),
        "poll_data": page_tables.polls_from_pages(history, poll_channel, ws.zone),
    }
    if redact:
        private = page_tables.private_channels(pages["channels"])
        for name in ("message_data", "thread_data"):
            tables[name] = page_tables.redact_private(tables[name], private)
        told = page_tables.pages_of_others(history, private)
        tables["poll_data"] = page_tables.polls_from_pages(told, poll_channel, ws.zone)
    return tables


def _take_given(ws: Workspace, tables: dict[str, DataFrame], batch: str, again: bool) -> None:
    """Rows of CSV files of a batch instead of those from its pages; they come with its first step."""
    for name in ws.entities:
        if exists(ws.spark, f"{ws.home}/{batch}/given/{name}.csv"):
            given = read_entity(ws.spark, ws.home, f"{batch}/given", name).select(*SPECS[name].columns)
            given = (given.where("false") if again else given).withColumn("batch_id", F.lit(batch))
            others = tables[name].where(_batch_id() != batch) if name in tables else None
            tables[name] = others.unionByName(given) if others is not None else given
