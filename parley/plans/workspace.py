"""Where the tables of a workspace lie.

    <home>/<batch>/api        raw pages
    <home>/<batch>/given      entity tables as CSV, used instead of those from pages
    <home>/<batch>/metrics    metrics of the batch
    <home>/pages              decoded pages, a partition for each batch, step and kind of page
    <home>/typed/<kind>       pages of posts and replies, parsed, by batch and step
    <home>/tables/<table>     rows of the entity tables, by batch and step
    <home>/master/manifest    what happened to the batches: loaded, merged (see ``manifest``)
    <home>/master/base        the master over some batches, in buckets (see ``base``)
    <home>/metrics            metrics of the master
    <home>/references         zone, country and channel_ref files

The master is what sequential upserts of all merged batches in the order of their ids would
give, whatever the order in which they were merged: a merge only writes that the batch belongs
to it, and a reader replays the tables of the batches. So a merge copies no row, no batch can be
lost, and a batch counts with all its tables or not at all. A base holds the replay of some
batches with the first and last batch of each row, so batches of any age can follow; it counts
only as long as those batches have not been loaded again.

What a reader needs to know of all batches is in the manifest and the log of the base, which
``Workspace.view`` reads by one job each; all tables can be planned from one view.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parley.dialect import THREADED, Dialect
from parley.operators.feed import change_feed
from parley.operators.merge import FLAT_ENTITIES, SPECS, THREADED_ENTITIES, replay
from parley.plans.base import Version, joined, read_base, read_versions, version_name
from parley.plans.manifest import Manifest, read_manifest
from parley.schemas import BY_DAY, ENTITIES, REFERENCES
from parley.sources.files import exists
from parley.sources.tables import read_reference

MASTER = "master"


def chosen_steps(steps: Mapping[str, Iterable[str]]) -> Column:
    """The partitions of some steps of some batches."""
    pairs = [f"{batch}/{step}" for batch, of in steps.items() for step in of]
    return F.concat_ws("/", "batch_id", "step").isin(pairs)


@dataclass(frozen=True)
class Workspace:
    spark: SparkSession
    home: str
    dialect: Dialect = THREADED
    # Zone of the wall-clock times made out of epoch seconds.
    zone: str = "UTC"

    @property
    def entities(self) -> tuple[str, ...]:
        return THREADED_ENTITIES if self.dialect.threads else FLAT_ENTITIES

    # -- paths --------------------------------------------------------------------------------

    @property
    def pages_root(self) -> str:
        return f"{self.home}/pages"

    def pages_path(self, batch: str) -> str:
        return f"{self.pages_root}/batch_id={batch}"

    def typed_root(self, kind: str) -> str:
        return f"{self.home}/typed/{kind}"

    def table_root(self, name: str) -> str:
        return f"{self.home}/tables/{name}"

    def metric_path(self, scope: str, name: str) -> str:
        folder = self.home if scope == MASTER else f"{self.home}/{scope}"
        return f"{folder}/metrics/{name}"

    @property
    def manifest_path(self) -> str:
        return f"{self.home}/{MASTER}/manifest"

    @property
    def base_path(self) -> str:
        return f"{self.home}/{MASTER}/base"

    # -- reading ------------------------------------------------------------------------------

    def is_written(self, path: str) -> bool:
        """Whether a table is there; one left behind by a failed write is an error."""
        if exists(self.spark, f"{path}/_SUCCESS"):
            return True
        if exists(self.spark, path):
            raise RuntimeError(f"{path} is incomplete: run its batch again")
        return False

    def manifest(self) -> Manifest:
        return read_manifest(self.spark, self.manifest_path)

    def view(self) -> View:
        """The master as it is now. Two jobs; planning its tables then starts none."""
        return View(self, self.manifest(), tuple(read_versions(self.spark, self.base_path)))

    def merged(self) -> list[str]:
        """The batches of the master, oldest first."""
        return self.manifest().merged()

    def stamp(self, batch: str) -> str | None:
        """The stamp of the last load of a batch, if it is complete."""
        return self.manifest().state(batch).stamp

    def base_of(self, batches: list[str]) -> tuple[str | None, list[str]]:
        """The newest base made of some of these batches as they are now, and those batches."""
        version = self.view().base_of(batches)
        return (version_name(version.number), sorted(version.stamps)) if version else (None, [])

    def master(self, name: str, before: str | None = None) -> DataFrame:
        """A table of the master, or of the master over the batches before one."""
        return self.view().table(name, before)

    def delta(self, name: str, batch: str, change: str) -> DataFrame:
        """Rows which a batch inserts into, or updates in, the master over the batches before."""
        feed = self.view().feed(name, [batch])
        return feed.where(F.col("change") == change).drop("batch_id", "change")

    def table(self, scope: str, name: str) -> DataFrame:
        """An entity table of a batch, or of the master."""
        return self.tables(scope)(name)

    def tables(self, scope: str) -> Callable[[str], DataFrame]:
        """The entity tables of a batch, or of the master as it is now, by name."""
        view = self.view()
        return view.table if scope == MASTER else lambda name: view.batch_table(name, scope)

    def metric(self, scope: str, name: str) -> DataFrame:
        if not self.is_written(self.metric_path(scope, name)):
            raise RuntimeError(f"{self.metric_path(scope, name)} is not there: derive it first")
        # A table in partitions may have no file to take its schema from.
        reader = self.spark.read.schema(BY_DAY[name]) if name in BY_DAY else self.spark.read
        return reader.parquet(self.metric_path(scope, name)).drop("day")

    def reference(self, name: str) -> DataFrame:
        return read_reference(self.spark, self.home, name, REFERENCES[name])


@dataclass(frozen=True)
class View:
    """The master of a workspace at a moment."""

    ws: Workspace
    manifest: Manifest
    versions: tuple[Version, ...]

    def base_of(self, batches: list[str]) -> Version | None:
        """The newest base made of some of these batches as they are now."""
        for version in self.versions:
            if set(version.stamps) <= set(batches) and all(self.manifest.state(b).stamp == s for b, s in version.stamps.items()):
                return version
        return None

    def rows(self, name: str, batches: list[str], steps: Mapping[str, Iterable[str]] | None = None) -> DataFrame | None:
        """The rows of a table over batches, with ``batch_id``; None where no batch has it. Of
        all steps that the tables show, or of those given."""
        shown = {b: (steps or {}).get(b, self.manifest.state(b).shown) for b in batches if name in self.manifest.state(b).tables}
        if not any(shown.values()) or not exists(self.ws.spark, self.ws.table_root(name)):
            return None
        schema = StructType([*ENTITIES[name].fields]).add("batch_id", "string").add("step", "string")
        rows = self.ws.spark.read.schema(schema).parquet(self.ws.table_root(name)).where(chosen_steps(shown))
        return rows.withColumn("batch_id", F.col("batch_id").cast("bigint")).drop("step")

    def batch_table(self, name: str, batch: str) -> DataFrame:
        """A table of one batch."""
        state, rows = self.manifest.state(batch), self.rows(name, [batch])
        if rows is None:
            if state.pending and state.stamp is None:
                raise RuntimeError(f"batch {batch} is incomplete: load it again")
            return self.ws.spark.createDataFrame([], ENTITIES[name])
        rows = rows.drop("batch_id")
        # Steps may bring the same reaction by pages of both kinds.
        return rows.distinct() if name == "reaction_data" and len(state.shown) > 1 else rows

    def table(self, name: str, before: str | None = None) -> DataFrame:
        """A table of the master, or of the master over the batches before one."""
        spec, spark = SPECS[name], self.ws.spark
        batches = [b for b in self.manifest.merged() if before is None or b < before]
        version = self.base_of(batches)
        base = version.tables.get(name) if version else None
        late = self.rows(name, [b for b in batches if not base or b not in version.stamps])
        if late is None:
            rows = read_base(spark, base) if base else spark.createDataFrame([], ENTITIES[name])
        elif base is None:
            return replay(late, spec)
        else:
            rows = joined(spark, base, late, spec)
        return rows.select(*spec.columns)

    def feed(self, name: str, of: list[str] | None = None) -> DataFrame:
        """(batch_id, change, columns): what all batches of the master, or some, changed in a
        table. Those asked for need not be merged; of others only keys are read."""
        rows = self.rows(name, sorted({*self.manifest.merged(), *(of or [])}))
        if rows is None:
            rows = self.ws.spark.createDataFrame([], StructType([*ENTITIES[name].fields]).add("batch_id", "long"))
        return change_feed(rows, SPECS[name], of=None if of is None else [int(b) for b in of])
