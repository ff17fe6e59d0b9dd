"""Batches merged as they arrive, instead of by a timer."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from parley.plans.loading import add_step
from parley.plans.runs import merge_batches
from parley.plans.workspace import Workspace


# Fixed by the file source.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arrivals(ws: Workspace) -> DataFrame:
    """A stream of (batch_id, file_name, value) of new page files; the content is read only
    where ``value`` is asked for."""
    source = ws.spark.readStream.format("binaryFile").schema(_FILES)
    files = source.option("pathGlobFilter", "*.json").load(f"{ws.home}/*/api")
    batch = F.regexp_extract("path", r"/(\d{14})/api/", 1)
    name = F.element_at(F.split("path", "/"), -1)
    value = F.col("content").cast("string").alias("value")
    return files.select(batch.alias("batch_id"), name.alias("file_name"), value).where(F.col("batch_id") != "")


def ingest_stream(
    ws: Workspace,
    checkpoint: str,
    poll_channel: str | None = None,
    redact: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Load and merge the batches which got new pages.

    Each arrival is one step for all its batches: new pages are read, decoded and parsed once,
    and only the rows which they bring are added. The master orders batches by id, so late
    batches, late pages and steps which are repeated after a failure all give the same one.
    """

    def merge(new: DataFrame, number: int) -> None:
        # Without the content: only the paths are listed.
        touched = sorted(r["batch_id"] for r in new.select("batch_id").distinct().collect())
        if touched:
            add_step(ws, new, f"{_query_id(ws, checkpoint)}-{number}", touched, poll_channel, redact)
            merge_batches(ws, touched)

    writer = arrivals(ws).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _query_id(ws: Workspace, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to: a new checkpoint counts from 0 again, and
    its steps must not take the place of earlier ones."""
    return json.loads(ws.spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
