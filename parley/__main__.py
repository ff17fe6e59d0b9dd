"""Command line: ``spark-submit parley/__main__.py run HOME [BATCH] [STAGE]`` and others."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from parley.dialect import FLAT, THREADED
from parley.plans import exports, runs
from parley.plans.workspace import MASTER, Workspace
from parley.sinks.jdbc import jdbc_options
from parley.streaming.arrivals import ingest_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="parley", description="Team-chat analytics on Spark")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("home", help="data home: batches, master, metrics, references")
        sub.add_argument("--flat", action="store_true", help="the product with flat records")
        sub.add_argument("--zone", default="UTC", help="zone of the wall-clock times")
        return sub

    def loading(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--poll-channel", help="read polls of this channel only")
        sub.add_argument("--redact", action="store_true", help="empty posts of private channels")

    run = command("run", "one batch, or the metrics of the master")
    run.add_argument("batch", nargs="?")
    run.add_argument("stage", nargs="?", type=int, choices=(1, 2, 3, 4))
    run.add_argument("--csv", action="store_true", help="also export the results as CSV")
    run.add_argument("--numbered", action="store_true", help="number the rows of exported tables")
    run.add_argument("--deltas", action="store_true", help="also export what the batch inserts and updates")
    loading(run)
    loading(command("newest", "the newest batch, then the master"))
    loading(command("replay", "all batches, then the master"))
    watch = command("watch", "merge batches as they arrive")
    watch.add_argument("checkpoint", help="folder for the progress of the stream")
    watch.add_argument("--once", action="store_true", help="stop when nothing new is left")
    loading(watch)
    compact = command("compact", "make a base of all merged batches for readers")
    compact.add_argument("--whole", action="store_true", help="write all buckets, not only those with late keys")
    command("changes", "what each batch inserted into the master and updated there, as CSV")
    load = command("load", "the master and its metrics into a database")
    load.add_argument("properties", help="file with database.url, driver, user and password")
    load.add_argument("section", help="section of that file")
    load.add_argument("--sized", action="store_true", help="VARCHAR columns sized by content")
    return top


def main(arguments: Sequence[str] | None = None) -> list[str]:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName("parley").getOrCreate()
    ws = Workspace(spark, args.home, FLAT if args.flat else THREADED, args.zone)
    if args.command == "run":
        done = runs.run(ws, args.batch, args.stage, args.poll_channel, args.redact)
        if args.csv:
            scope = args.batch or MASTER
            entities = [name for name in done if name in ws.entities]
            exports.export_tables(ws, scope, args.numbered)
            exports.export_metrics(ws, [name for name in done if name not in entities], scope)
        if args.deltas and args.batch:
            done += exports.export_deltas(ws, args.batch)
        return done
    if args.command == "compact":
        return [runs.compact(ws, args.whole) or ""]
    if args.command == "changes":
        return exports.export_changes(ws)
    if args.command == "newest":
        return runs.run_batch_then_master(ws, None, args.poll_channel, args.redact)
    if args.command == "replay":
        return runs.replay_all(ws, args.poll_channel, args.redact)
    if args.command == "watch":
        query = ingest_stream(ws, args.checkpoint, args.poll_channel, args.redact, args.once)
        query.awaitTermination()
        return []
    # Read through Spark: the file may lie where only the cluster can see it.
    text = spark.read.text(args.properties, wholetext=True).first()["value"]
    return exports.load_database(ws, jdbc_options(text, args.section), args.sized)


if __name__ == "__main__":
    main()
