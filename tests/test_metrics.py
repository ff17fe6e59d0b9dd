"""Conversations and tags by day: what a batch does not touch stays as it is."""

import random

import pytest
from pyspark.sql import functions as F

from parley.plans import loading, metrics, runs
from parley.plans.manifest import LOADED, LOADING, record
from parley.plans.workspace import MASTER, Workspace
from parley.schemas import ENTITIES

BATCHES = [f"2020010{i}000000" for i in range(1, 6)]
_DAY = 86_400


def _post(day, n, user, text):
    seconds = 1_577_836_800 + day * _DAY + n
    return ("C1", "message", None, f"{seconds}.000100", f"{seconds}.000100", seconds, None, user, text)


def _load(ws, batch, users, posts, step="all", fresh=True):
    spark = ws.spark
    record(spark, ws.manifest_path, LOADING, [batch])
    schema = "channel string, type string, subtype string, ts string, thread_ts string, time long, reply_count int, user_id string, text string"
    said = spark.createDataFrame(posts, schema).withColumn("time", F.timestamp_seconds("time").cast("timestamp_ntz"))
    tables = {
        "message_data": said,
        "thread_data": said.where("false").drop("reply_count"),
        "user_data": spark.createDataFrame([(u, n, n.title(), tz, "", batch[:8]) for u, n, tz in users], ENTITIES["user_data"]),
    }
    for name, frame in tables.items():
        loading.write_table(frame.withColumns({"batch_id": F.lit(batch), "step": F.lit(step)}), ws.table_root(name), "batch_id", "step")
    shown = {step} if fresh else ws.manifest().state(batch).shown | {step}
    record(spark, ws.manifest_path, LOADED, [batch], f"{batch} {step} {len(posts)}", list(tables), {batch: shown}, {batch: shown})


@pytest.fixture
def ws(spark, tmp_path):
    references = tmp_path / "references"
    references.mkdir()
    (references / "zone.csv").write_text("ISO,TZ\nJP,Asia/Tokyo\n")
    (references / "country.csv").write_text("ISO2,COUNTRY\nJP,Japan\n")
    return Workspace(spark, str(tmp_path))


def _files(tmp_path):
    found = {}
    for name in ("conversation_data", "tag_data"):
        for file in (tmp_path / "metrics" / name).rglob("*.parquet"):
            found.setdefault((name, file.parent.name), {})[file.name] = (file.stat().st_mtime_ns, file.read_bytes())
    return found


def _changed(before, after):
    return {key for key in before.keys() | after.keys() if before.get(key) != after.get(key)}


def _refresh(ws):
    return metrics.refresh(ws, ws.view())


USERS = [("U1", "ann", "Asia/Tokyo"), ("U2", "bob", "")]


def test_only_touched_days_are_written(ws, tmp_path, rows):
    _load(ws, BATCHES[0], USERS, [_post(d, 1, f"U{1 + d % 2}", f"day {d} <@U2>" if d == 3 else f"day {d}") for d in range(4)])
    runs.merge_batch(ws, BATCHES[0])
    assert _refresh(ws) == {"conversation_data": None, "tag_data": None}
    before = _files(tmp_path)
    assert {day for name, day in before if name == "conversation_data"} == {f"day=2020-01-0{d}" for d in range(1, 5)}

    # the same users again, a changed post and a new one
    _load(ws, BATCHES[1], USERS, [_post(1, 1, "U2", "edited <@U1>"), _post(7, 1, "U1", "new")])
    runs.merge_batch(ws, BATCHES[1])
    assert _refresh(ws)["conversation_data"] == ["2020-01-02", "2020-01-08"]
    after = _files(tmp_path)
    assert _changed(before, after) == {("conversation_data", "day=2020-01-02"), ("conversation_data", "day=2020-01-08"), ("tag_data", "day=2020-01-02")}
    assert rows(ws.metric(MASTER, "conversation_data"), "text")[-2:] == [("edited <@U1>",), ("new",)]
    assert "day" not in ws.metric(MASTER, "conversation_data").columns

    # nothing new: nothing is written
    assert _refresh(ws) == {"conversation_data": [], "tag_data": []}
    assert _files(tmp_path) == after

    # a user with a new name: the days of their posts, and those of tags which name them
    _load(ws, BATCHES[2], [("U2", "robert", ""), USERS[0]], [])
    runs.merge_batch(ws, BATCHES[2])
    assert _refresh(ws) == {"conversation_data": ["2020-01-02", "2020-01-04"], "tag_data": ["2020-01-02", "2020-01-04"]}
    assert rows(ws.metric(MASTER, "tag_data").where("tag like '%U2'"), "nice_tag") in ([("Robert",)], [(None,)])

    # other zone tables: all days
    (tmp_path / "references" / "country.csv").write_text("ISO2,COUNTRY\nJP,Nippon\n")
    assert _refresh(ws)["conversation_data"] is None
    assert ("Nippon",) in rows(ws.metric(MASTER, "conversation_data"), "country")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_equals_the_whole_derivation(ws, rows, seed):
    dice = random.Random(seed)
    for i, batch in enumerate(dice.sample(BATCHES, 4)):
        users = [(u, f"{u}{dice.randrange(2)}", dice.choice(["", "Asia/Tokyo"])) for u in dice.sample(["U1", "U2", "U3"], 2)]
        posts = [_post(d, n, dice.choice(["U1", "U2", "U3", None]), f"{batch} <@U{1 + n}>") for d, n in {(dice.randrange(6), dice.randrange(2)) for _ in range(4)}]
        _load(ws, batch, users, posts)
        if i == 3:
            _load(ws, batch, [], [_post(9, 0, "U1", "one more step")], step="more", fresh=False)
        runs.merge_batch(ws, batch)
        _refresh(ws)
    got = {name: rows(ws.metric(MASTER, name)) for name in ("conversation_data", "tag_data")}
    metrics.refresh(ws, ws.view(), whole=True)
    assert got == {name: rows(ws.metric(MASTER, name)) for name in ("conversation_data", "tag_data")}
    assert any(day == "none" or day for day in got)


def test_a_batch_loaded_again_derives_all(ws, rows):
    _load(ws, BATCHES[0], USERS, [_post(0, 1, "U1", "one"), _post(1, 1, "U1", "two")], step="a")
    runs.merge_batch(ws, BATCHES[0])
    _refresh(ws)
    _load(ws, BATCHES[0], USERS, [_post(1, 1, "U1", "two")], step="b")
    assert _refresh(ws)["conversation_data"] is None
    assert rows(ws.metric(MASTER, "conversation_data"), "text") == [("two",)]
