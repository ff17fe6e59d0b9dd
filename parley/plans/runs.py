"""Runs over a workspace: load a batch, merge it, derive the metrics, count.

Stage 1 decodes the pages of a batch into entity tables, 2 merges them into the master,
3 derives the metrics, 4 counts. A run for stage N does N and all later ones; a run without
a batch derives the metrics of the master. Tables that later steps share are written and read
back, which also cuts the lineage at a stored table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators import counts, graph, members, posts, replies, tags
from parley.operators.merge import SPECS, replay
from parley.plans.base import BaseTable, Version, update_base, version_name, write_base, write_version
from parley.plans.loading import load_batch, unreadable, write_table
from parley.plans.manifest import MERGED, record
from parley.plans.metrics import refresh
from parley.plans.workspace import MASTER, View, Workspace
from parley.sources.files import list_batches, remove

__all__ = ["compact", "load_batch", "merge_all", "merge_batch", "merge_batches", "replay_all", "run", "run_batch_then_master", "unreadable"]

# -- stage 2 ----------------------------------------------------------------------------------


def merge_batch(ws: Workspace, batch: str) -> list[str]:
    """Make a loaded batch part of the master. No row is copied; an empty table changes nothing."""
    return merge_batches(ws, [batch])


def merge_batches(ws: Workspace, batches: list[str]) -> list[str]:
    """Make loaded batches part of the master; names of the tables which they have."""
    manifest = ws.manifest()
    missing = [b for b in batches if manifest.state(b).stamp is None]
    if missing:
        raise RuntimeError(f"batches {missing} are not loaded completely: load them again")
    record(ws.spark, ws.manifest_path, MERGED, [b for b in batches if not manifest.state(b).merged])
    return [name for name in ws.entities if any(name in manifest.state(b).tables for b in batches)]


def merge_all(ws: Workspace) -> list[str]:
    """Merge every loaded batch."""
    manifest = ws.manifest()
    return merge_batches(ws, sorted(b for b, state in manifest.batches.items() if state.stamp))


def compact(ws: Workspace, whole: bool = False) -> str | None:
    """Make a base of all merged batches, so that readers need not go through them again.

    Where there is a base of some of them, only those of its buckets are written which hold keys
    of the others; ``whole`` writes all anew, which also finds new keys with very many rows. None
    without batches. Files of older versions stay until they are removed by hand.
    """
    view = ws.view()
    batches = view.manifest.merged()
    if not batches:
        return None
    missing = [b for b in batches if view.manifest.state(b).stamp is None]
    if missing:
        raise RuntimeError(f"batches {missing} are not loaded completely: load them again")
    old = None if whole else view.base_of(batches)
    number = max((v.number for v in view.versions), default=0) + 1
    late = [b for b in batches if not old or b not in old.stamps]
    if old and not late:
        return version_name(old.number)
    made = [_compacted(view, name, late, old.tables.get(name) if old else None, number) for name in ws.entities]
    stamps = {b: view.manifest.state(b).stamp for b in batches}
    write_version(ws.spark, ws.base_path, Version(number, stamps, {t.name: t for t in made if t}))
    return version_name(number)


def _compacted(view: View, name: str, late: list[str], base: BaseTable | None, number: int) -> BaseTable | None:
    """A table of a new base version; None where no batch has the table."""
    ws, spec = view.ws, SPECS[name]
    rows = view.rows(name, late)
    if rows is None:
        return base
    if base:
        return update_base(ws.spark, base, rows, spec, number)
    # Stored, as it is read twice.
    place = f"{ws.base_path}/{name}/state-{number:08d}"
    write_table(replay(rows.withColumn("first_id", F.col("batch_id")), spec, first="first_id", state=True), place)
    buckets = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return write_base(ws.spark, ws.base_path, spec, ws.spark.read.parquet(place), number, buckets)
    finally:
        remove(ws.spark, place)


# -- stages 3 and 4 -----------------------------------------------------------------------------


def derive_metrics(ws: Workspace, scope: str) -> list[str]:
    dialect = ws.dialect
    written: list[str] = []

    def put(name: str, df: DataFrame) -> DataFrame:
        write_table(df, ws.metric_path(scope, name))
        written.append(name)
        return ws.metric(scope, name)

    view = ws.view()
    table = view.table if scope == MASTER else lambda name: view.batch_table(name, scope)
    users, channels, reactions = table("user_data"), table("channel_data"), table("reaction_data")
    zone, country = (ws.reference("zone"), ws.reference("country")) if dialect.geo else (None, None)

    if scope == MASTER:
        # By day; only days which new batches touch are written.
        refresh(ws, view)
        written += ["conversation_data", "tag_data"]
        conversation, tag = ws.metric(scope, "conversation_data"), ws.metric(scope, "tag_data")
    else:
        threads = table("thread_data") if dialect.threads else None
        conversation = put(
            "conversation_data",
            posts.conversations(table("message_data"), threads, users, zone, country, dialect),
        )
        tag = put("tag_data", tags.extract_tags(conversation, users, dialect))
    put("useractive_data", members.user_activity(users, conversation, reactions, dialect))
    bounds = replies.post_bounds(conversation)
    put("conversation_timediff_data", replies.timediff_conversations(conversation, bounds))
    if dialect.threads:
        put("threads_timediff_data", replies.timediff_threads(conversation, bounds))
    put("users_timediff_data", replies.timediff_users(conversation, bounds, dialect))
    put("node_data", graph.nodes(users, channels, zone, country, dialect))
    if dialect.threads:
        put("edge_data", graph.edges(conversation, reactions, tag))
    else:
        put("edge_data", graph.edges_untimed(conversation, reactions, tag))
        put("interact_data", graph.edges_interacts_b(conversation, dialect))
    return written


def derive_counts(ws: Workspace, scope: str) -> list[str]:
    if not ws.dialect.counts:
        return []
    conversation = ws.metric(scope, "conversation_data")
    table = ws.tables(scope)
    users, channels = table("user_data"), table("channel_data")
    frames: dict[str, Callable[[], DataFrame]] = {
        "aggr_by_channel": lambda: counts.count_by_channel(conversation),
        "aggr_by_channel_user": lambda: counts.count_by_channel_user(conversation),
        "number_channel_user": lambda: counts.users_per_channel(conversation),
        "max_by_channel_user": lambda: counts.top_users_per_channel(conversation, users, channels),
        "aggr_by_thread": lambda: counts.count_by_thread(conversation),
        "aggr_by_thread_user": lambda: counts.count_by_thread_user(conversation),
    }
    for name, frame in frames.items():
        write_table(frame(), ws.metric_path(scope, name))
    return list(frames)


# -- runs -----------------------------------------------------------------------------------------


def run(
    ws: Workspace,
    batch: str | None = None,
    stage: int | None = None,
    poll_channel: str | None = None,
    redact: bool = False,
) -> list[str]:
    """Names of the tables written. Without a batch: stages 3 and 4 over the master."""
    scope = batch or MASTER
    first = (stage or 1) if batch else 3
    done: list[str] = []
    if first <= 1:
        done += load_batch(ws, batch, poll_channel, redact)
    if first <= 2:
        done += merge_batch(ws, batch)
    if first <= 3:
        done += derive_metrics(ws, scope)
    if first <= 4:
        done += derive_counts(ws, scope)
    return done


def run_batch_then_master(
    ws: Workspace,
    batch: str | None = None,
    poll_channel: str | None = None,
    redact: bool = False,
) -> list[str]:
    """One batch, the newest by default, and then the metrics of the master."""
    batch = batch or list_batches(ws.spark, ws.home)[-1]
    return run(ws, batch, poll_channel=poll_channel, redact=redact) + run(ws)


def replay_all(
    ws: Workspace,
    poll_channel: str | None = None,
    redact: bool = False,
    batch_metrics: bool = True,
) -> list[str]:
    """All batches from their raw pages, one master over them, and its metrics."""
    for batch in list_batches(ws.spark, ws.home):
        load_batch(ws, batch, poll_channel, redact)
        if batch_metrics:
            derive_metrics(ws, batch)
            derive_counts(ws, batch)
    return merge_all(ws) + run(ws)
