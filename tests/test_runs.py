"""Whole runs over raw page files, by batch, by replay and as a stream."""

import itertools
import shutil

import pytest

from parley.dialect import FLAT
from parley.plans import loading, runs
from parley.plans.manifest import LOADING, record
from parley.plans.workspace import MASTER, Workspace
from parley.schemas import ENTITIES
from parley.streaming.arrivals import ingest_stream

FIRST, SECOND, THIRD = "20200501101112", "20200601101112", "20210601101112"


def _write(home, batch, prefix, key, clock, content):
    folder = home / batch / "api"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{prefix}-{key}-{clock:016d}.json").write_text(str(content), encoding="utf-8")


def _export(home, batch, users, messages, replies=(), files=()):
    clock = 1588327872000000
    members = [{"id": u, "name": n, "tz": "Asia/Tokyo", "real_name": n.title(), "profile": {}} for u, n in users]
    _write(home, batch, "user_list", "all", clock, {"members": members})
    channel = {"id": "C1", "name": "general", "is_channel": True, "is_private": False, "is_archived": False}
    _write(home, batch, "conversation_list", "all", clock, {"channels": [channel]})
    _write(home, batch, "conversation_history", "C1", clock, {"messages": messages})
    for parent, answers in replies:
        _write(home, batch, "conversation_replies", f"C1_{parent}", clock, {"messages": answers})
    _write(home, batch, "files_list", "all", clock, {"files": list(files)})


def _message(ts, user, text, **more):
    return {"type": "message", "ts": ts, "user": user, "text": text, **more}


@pytest.fixture
def home(tmp_path):
    references = tmp_path / "references"
    references.mkdir()
    (references / "zone.csv").write_text("ISO,TZ\nJP,Asia/Tokyo\n")
    (references / "country.csv").write_text("ISO2,COUNTRY\nJP,Japan\n")
    root = _message("1588000000.000100", "U1", "hi <@U2> <#C1|general>", reply_count=1, thread_ts="1588000000.000100")
    answer = _message("1588000060.000100", "U2", "yes", thread_ts="1588000000.000100")
    react = [{"name": "tada", "users": ["U1", "U2"]}]
    _export(
        tmp_path, FIRST, [("U1", "ann"), ("U2", "bob")],
        [root, _message("1588000120.000100", "U1", "alone", reactions=react)],
        [("1588000000.000100", [root, answer])],
        [{"id": "F1", "name": "f", "timestamp": 1588000000, "user": "U1", "channels": ["C1"]}],
    )
    react = [{"name": "tada", "users": ["U2"]}]
    _export(
        tmp_path, SECOND, [("U2", "bobby"), ("U3", "cy")],
        [_message("1588000120.000100", "U1", "changed", reactions=react), _message("1588000200.000100", "U3", "new")],
    )
    _write(tmp_path, SECOND, "conversation_history", "C1", 1588327872000001, "{'broken': ")
    _export(tmp_path, THIRD, [("U1", "anna")], [_message("1588000300.000100", "U1", "late")])
    return tmp_path


def _master(ws, rows):
    return {name: rows(ws.master(name)) for name in ws.entities}


def test_batch_after_batch(spark, home, rows):
    ws = Workspace(spark, str(home))
    done = runs.run(ws, FIRST)
    assert done[:7] == list(ws.entities) and done[-1] == "aggr_by_thread_user"
    assert rows(ws.master("user_data"), "id", "name", "batch") == [
        ("U1", "ann", "1588204800"), ("U2", "bob", "1588204800"),
    ]
    runs.load_batch(ws, SECOND)
    runs.merge_batch(ws, SECOND)
    assert rows(ws.master("user_data"), "id", "name", "batch") == [
        ("U1", "ann", "1588204800"), ("U2", "bobby", "1588204800"), ("U3", "cy", "1590883200"),
    ]
    assert rows(ws.master("reaction_data"), "ts", "user_id") == [("1588000120.000100", "U2")]
    assert rows(ws.delta("message_data", SECOND, "insert"), "text") == [("new",)]
    assert rows(ws.delta("message_data", SECOND, "update"), "text") == [("changed",)]
    assert rows(ws.table(SECOND, "message_data"), "text") == [("changed",), ("new",)]
    assert rows(runs.unreadable(ws, SECOND)) == [("conversation_history-C1-1588327872000001.json", "undecodable")]

    before = _master(ws, rows)
    runs.merge_batch(ws, SECOND)
    assert _master(ws, rows) == before, "merging a batch again must not change the master"

    runs.run(ws)
    edges = ws.metric(MASTER, "edge_data")
    # The answer has no parent left among threaded activity but its root, written by U1.
    assert rows(edges, "source", "target", "relate") == [
        ("U1", "C1", "interacts"), ("U1", "U2", "reacts"), ("U1", "U2", "refers"),
        ("U2", "U1", "interacts"), ("U3", "C1", "interacts"),
    ]
    assert rows(ws.metric(MASTER, "conversation_timediff_data"), "text", "diff") == [
        ("changed", 60.0), ("hi <@U2> <#C1|general>", 0.0), ("new", 80.0), ("yes", 60.0),
    ]
    assert rows(ws.metric(MASTER, "max_by_channel_user")) == [("C1", "general", "U1", "Ann", 2)]
    assert rows(ws.metric(MASTER, "conversation_data"), "country", "city", "iso")[0] == ("Japan", "Tokyo", "JP")
    assert ws.metric(FIRST, "conversation_data").count() == 3


def test_stages(monkeypatch):
    names = ("load_batch", "merge_batch", "derive_metrics", "derive_counts")
    for name in names:
        monkeypatch.setattr(runs, name, lambda ws, scope, *_, name=name: [(name, scope)])
    ws = Workspace(None, "home")
    for stage in (None, 1, 2, 3, 4):
        assert runs.run(ws, FIRST, stage) == [(n, FIRST) for n in names[(stage or 1) - 1 :]]
    for stage in (None, 1, 4):
        assert runs.run(ws, stage=stage) == [(n, MASTER) for n in names[2:]], "the master has no pages"


def test_newest_batch_then_master(spark, home, monkeypatch):
    monkeypatch.setattr(runs, "run", lambda ws, batch=None, poll_channel=None, redact=False: [(batch, poll_channel)])
    ws = Workspace(spark, str(home))
    assert runs.run_batch_then_master(ws, poll_channel="C1") == [(THIRD, "C1"), (None, None)]
    assert runs.run_batch_then_master(ws, FIRST) == [(FIRST, None), (None, None)]


def test_replay_equals_merging(spark, home, rows):
    ws = Workspace(spark, str(home))
    for batch in (FIRST, SECOND, THIRD):
        runs.load_batch(ws, batch)
        runs.merge_batch(ws, batch)
    merged = _master(ws, rows)
    assert "edge_data" in runs.replay_all(ws, batch_metrics=False)
    assert _master(ws, rows) == merged


def test_stream_equals_merging(spark, home, tmp_path_factory, rows):
    ws = Workspace(spark, str(home))
    for batch in (FIRST, SECOND, THIRD):
        runs.load_batch(ws, batch)
        runs.merge_batch(ws, batch)
    merged = _master(ws, rows)

    # The second batch arrives last.
    late = tmp_path_factory.mktemp("stream")
    checkpoint = str(tmp_path_factory.mktemp("checkpoint"))
    stream = Workspace(spark, str(late))
    for arriving in ([FIRST], [THIRD], [SECOND], []):
        for batch in arriving:
            (late / batch / "api").mkdir(parents=True)
            for page in (home / batch / "api").iterdir():
                (late / batch / "api" / page.name).write_text(page.read_text())
        query = ingest_stream(stream, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
    assert _master(stream, rows) == merged


def test_second_product(spark, tmp_path, rows):
    clock = 1588327872000000
    users = [{"id": str(i), "name": f"n{i}", "real_name": f"r{i}", "tz": "", "email": "", "batch": FIRST} for i in (1, 2)]
    channels = [{"id": "7", "name": "c", "type": "text", "class": "public", "is_archived": False, "is_private": False}]
    messages = [
        {"channel": "7", "type": "message", "subtype": "default", "ts": str(175928847299117063 + i), "thread_ts": "",
         "time": f"2020-05-01T10:11:1{i}.000", "reply_count": "", "user": str(1 + i % 2), "text": f"<@!{2 - i % 2}> {i}"}
        for i in range(3)
    ]
    _write(tmp_path, FIRST, "user_list", "all", clock, users)
    _write(tmp_path, FIRST, "conversation_list", "all", clock, channels)
    _write(tmp_path, FIRST, "message_list", "7", clock, messages)
    _write(tmp_path, FIRST, "files_list", "all", clock, [])
    ws = Workspace(spark, str(tmp_path), FLAT)
    done = runs.run_batch_then_master(ws, FIRST)
    assert "threads_timediff_data" not in done and "aggr_by_channel" not in done
    assert rows(ws.metric(MASTER, "edge_data"), "source", "target", "relate") == [
        ("1", "2", "refers"), ("1", "2", "refers"), ("1", "7", "teams"), ("1", "7", "teams"),
        ("2", "1", "refers"), ("2", "7", "teams"),
    ]
    assert rows(ws.metric(MASTER, "interact_data"), "source", "targets", "edges") == [("1", 1, 2), ("2", 1, 2)]
    assert rows(ws.metric(MASTER, "users_timediff_data"), "user_id", "diff") == [("1", 0.0), ("1", 2.0), ("2", 0.0)]


def test_exports(spark, home, monkeypatch):
    from parley.plans import exports
    from parley.sinks import jdbc

    ws = Workspace(spark, str(home))
    for batch in (FIRST, SECOND):
        runs.load_batch(ws, batch)
        runs.merge_batch(ws, batch)
    numbered = exports.numbered(ws, "user_data")
    assert numbered.columns[0] == "index"
    assert [r.id for r in numbered.orderBy("index").collect()] == ["U1", "U2", "U3"]

    runs.run(ws)
    exports.export_metrics(ws, ["tag_data"])
    header = {f.read_text().splitlines()[0] for f in (home / "metrics" / "csv" / "tag_data.csv").glob("part-*")}
    assert header == {'"channel","ts","tag","nice_tag","type"'}

    loaded = {}
    monkeypatch.setattr(jdbc, "load_table", lambda df, spec, options, sized, existing: loaded.update({spec.table: df.columns}))
    (home / "references" / "channel_ref.csv").write_text("id,index,category_name,category_index\nC1,0,a,1\n")
    done = exports.load_database(ws, {"url": "jdbc:x"})
    assert set(done) == set(loaded) == set(jdbc.LOADS)
    assert loaded["reaction_data"] == ["index", "channel", "ts", "thread_ts", "user_id", "reaction"]
    assert loaded["edge_data"] == ["channel", "source", "target", "time", "relate"]
    assert not list((home / "master" / "sorted").glob("*")), "no sorted rows are left"

    # Sized columns are told what the database holds.
    asked = []
    monkeypatch.setattr(exports, "database_table", lambda ws, options, name: asked.append(name))
    exports.load_database(ws, {"url": "jdbc:x"}, sized=True)
    assert asked == [name for name, spec in jdbc.LOADS.items() if spec.sized]

    assert "message_data_update" in exports.export_deltas(ws, SECOND)
    changed = [f.read_text() for f in (home / SECOND / "csv" / "message_data_update.csv").glob("part-*")]
    assert any('"changed"' in text for text in changed)
    exports.export_tables(ws, index=True)
    first = sorted(f.read_text() for f in (home / "master" / "csv" / "user_data.csv").glob("part-*"))
    assert first[0].startswith('"index","id"')
    assert not (home / "master" / "csv" / "user_data.csv-sorted").exists()


def test_redacted_load(spark, tmp_path, rows):
    clock = 1588327872000000
    poll = [{"block_id": "poll-a-0123456789menu", "text": {"text": "Lunch?"}}, {"block_id": "poll-x", "text": {"text": "Soup `3`"}}]
    for channel in ("C1", "C2"):
        history = [_message("1588000000.000100", "U1", "said", reply_count=1, blocks=poll)]
        _write(tmp_path, FIRST, "conversation_history", channel, clock, {"messages": history})
        _write(tmp_path, FIRST, "conversation_replies", f"{channel}_1588000000.000100", clock, {"messages": history})
    listed = [{"id": "C1", "is_channel": True}, {"id": "C2", "is_channel": True, "is_private": True}]
    _write(tmp_path, FIRST, "conversation_list", "all", clock, {"channels": listed})
    ws = Workspace(spark, str(tmp_path))
    runs.load_batch(ws, FIRST, redact=True)
    for name in ("message_data", "thread_data"):
        assert rows(ws.table(FIRST, name), "channel", "text") == [("C1", "said"), ("C2", "")]
    assert rows(ws.table(FIRST, "poll_data"), "vote_item") == [("Soup",)]
    runs.load_batch(ws, FIRST)
    assert ws.table(FIRST, "poll_data").count() == 2


def test_a_failed_write_is_no_empty_table(spark, tmp_path):
    ws = Workspace(spark, str(tmp_path))
    assert ws.table(FIRST, "user_data").count() == 0
    record(spark, ws.manifest_path, LOADING, [FIRST])
    with pytest.raises(RuntimeError, match="incomplete"):
        ws.table(FIRST, "user_data")
    (tmp_path / "metrics" / "tag_data").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="incomplete"):
        ws.metric(MASTER, "tag_data")


def _texts(ws, rows):
    return [text for (text,) in rows(ws.master("message_data"), "text")]


def _three(home):
    """Three batches with a post of each and one which all of them change."""
    for i, batch in enumerate((FIRST, SECOND, THIRD)):
        posts = [_message("1588000000.000100", "U1", f"said in {i}"), _message(f"158800000{i + 1}.000100", "U1", f"only {i}")]
        _export(home, batch, [("U1", f"ann {i}")], posts)
    return home


@pytest.fixture
def three(tmp_path):
    return _three(tmp_path)


@pytest.fixture(scope="module")
def three_loaded(spark, tmp_path_factory):
    home = _three(tmp_path_factory.mktemp("loaded"))
    for batch in (FIRST, SECOND, THIRD):
        runs.load_batch(Workspace(spark, str(home)), batch)
    return home


@pytest.fixture
def loaded(three_loaded, tmp_path):
    """A copy of the workspace with the three batches loaded."""
    return shutil.copytree(three_loaded, tmp_path / "home")


@pytest.mark.parametrize("order", list(itertools.permutations((FIRST, SECOND, THIRD))))
def test_any_order_of_merging_gives_one_master(spark, loaded, rows, order):
    ws = Workspace(spark, str(loaded))
    for i, batch in enumerate(order):
        runs.merge_batch(ws, batch)
        assert len(_texts(ws, rows)) == i + 2, "no batch is lost"
        if i == 1:
            runs.compact(ws)
    assert _texts(ws, rows) == ["only 0", "only 1", "only 2", "said in 2"]
    assert rows(ws.master("user_data"), "name", "batch") == [("ann 2", "1588204800")]


def test_a_batch_counts_with_all_its_tables_or_not_at_all(spark, three, rows, monkeypatch):
    ws = Workspace(spark, str(three))
    runs.run(ws, FIRST, 1)
    write = loading.write_table

    def failing(df, path, *by):
        if path.endswith("/message_data"):
            raise OSError("lost")
        write(df, path, *by)

    monkeypatch.setattr(loading, "write_table", failing)
    with pytest.raises(OSError, match="lost"):
        runs.load_batch(ws, SECOND)
    with pytest.raises(RuntimeError, match="not loaded completely"):
        runs.merge_batch(ws, SECOND)
    assert ws.merged() == [FIRST]
    assert rows(ws.master("user_data"), "name") == [("ann 0",)]
    monkeypatch.undo()
    runs.load_batch(ws, SECOND)
    runs.merge_batch(ws, SECOND)
    assert _texts(ws, rows) == ["only 0", "only 1", "said in 1"]


def test_a_base_with_a_batch_that_changed_does_not_count(spark, loaded, rows):
    three, ws = loaded, Workspace(spark, str(loaded))
    for batch in (FIRST, THIRD):
        runs.merge_batch(ws, batch)
    assert runs.compact(ws) == "v-00000001"
    assert ws.base_of(ws.merged())[0] == "v-00000001"
    _write(three, FIRST, "conversation_history", "C1", 1588327872000009, {"messages": [_message("1588000009.000100", "U1", "more")]})
    runs.load_batch(ws, FIRST)
    assert ws.base_of(ws.merged())[0] is None
    assert _texts(ws, rows) == ["more", "only 0", "only 2", "said in 2"]
    assert runs.compact(ws) == "v-00000002"
    assert ws.base_of(ws.merged())[0] == "v-00000002"
    assert _texts(ws, rows) == ["more", "only 0", "only 2", "said in 2"]


def test_a_merge_copies_no_row(spark, loaded):
    ws = Workspace(spark, str(loaded))
    for batch in (FIRST, SECOND):
        runs.merge_batch(ws, batch)
    assert not list((loaded / "master").rglob("*.parquet"))


def test_a_failed_reload_leaves_the_batch_as_it_was(spark, three, rows, monkeypatch):
    ws = Workspace(spark, str(three))
    runs.load_batch(ws, FIRST)
    runs.merge_batch(ws, FIRST)
    write = loading.write_table

    def failing(df, path, *by):
        if path.endswith("/thread_data"):
            raise OSError("lost")
        write(df, path, *by)

    _write(three, FIRST, "conversation_history", "C1", 1588327872000009, {"messages": [_message("1588000009.000100", "U1", "more")]})
    monkeypatch.setattr(loading, "write_table", failing)
    with pytest.raises(OSError, match="lost"):
        runs.load_batch(ws, FIRST)
    assert _texts(ws, rows) == ["only 0", "said in 0"]
    monkeypatch.undo()
    runs.load_batch(ws, FIRST)
    assert _texts(ws, rows) == ["more", "only 0", "said in 0"]
    runs.load_batch(ws, FIRST)
    steps = list((three / "tables" / "message_data" / f"batch_id={FIRST}").glob("step=*"))
    assert len(steps) == 2, "what the failure left behind is gone, the load before stays for its readers"


def test_late_pages_after_a_late_batch(spark, three, tmp_path_factory, rows):
    """First and third batch, then the second, then one more page of the third."""
    home = tmp_path_factory.mktemp("stream")
    checkpoint = str(tmp_path_factory.mktemp("checkpoint"))
    ws = Workspace(spark, str(home))
    for arriving in ((FIRST, THIRD), (SECOND,), ()):
        for batch in arriving:
            (home / batch / "api").mkdir(parents=True)
            for page in (three / batch / "api").iterdir():
                (home / batch / "api" / page.name).write_text(page.read_text())
        if not arriving:
            more = {"messages": [_message("1588000009.000100", "U1", "more")]}
            _write(home, THIRD, "conversation_history", "C1", 1588327872000009, more)
        query = ingest_stream(ws, checkpoint)
        query.awaitTermination(120)
        assert query.exception() is None
    assert _texts(ws, rows) == ["more", "only 0", "only 1", "only 2", "said in 2"]
    decoded = spark.read.parquet(ws.pages_path(THIRD))
    assert decoded.count() == decoded.select("file_name").distinct().count()
    assert decoded.select("step").distinct().count() == 2, "old pages are not decoded again"


def test_pages_of_another_shape_are_reported(spark, tmp_path, rows):
    clock = 1588327872000000
    _write(tmp_path, FIRST, "conversation_history", "C1", clock, {"ok": False, "error": "ratelimited"})
    _write(tmp_path, FIRST, "conversation_history", "C2", clock, {"messages": []})
    _write(tmp_path, FIRST, "user_list", "all", clock, {"members": None})
    _write(tmp_path, FIRST, "files_list", "all", clock, "{'files': ")
    root = _message("1588000000.000100", "U1", "hi", reply_count="1")
    _write(tmp_path, FIRST, "conversation_history", "C3", clock, {"messages": [root]})
    _write(tmp_path, FIRST, "conversation_replies", "C3_1588000000.000100", clock, {"messages": [root, _message("1588000060.000100", "U2", "yes")]})
    ws = Workspace(spark, str(tmp_path))
    runs.load_batch(ws, FIRST)
    assert rows(runs.unreadable(ws, FIRST)) == [
        ("conversation_history-C1-1588327872000000.json", "no list of messages"),
        ("files_list-all-1588327872000000.json", "undecodable"),
        ("user_list-all-1588327872000000.json", "no list of members"),
    ]
    # A count given as text announces its replies.
    assert rows(ws.table(FIRST, "thread_data"), "text") == [("hi",), ("yes",)]
    assert rows(ws.table(FIRST, "message_data"), "reply_count") == [(1,)]


def test_second_product_from_csv(spark, tmp_path, rows):
    """Roles and reactions of the second product come as CSV and reach the edges."""
    folder = tmp_path / FIRST / "given"
    folder.mkdir(parents=True)
    (folder / "user_data.csv").write_text(f"id,name,real_name,tz,email,batch\n1,a,A,,,{FIRST}\n2,b,B,,,{FIRST}\n")
    (folder / "reaction_data.csv").write_text('channel,ts,thread_ts,user_id,reaction\n7,175928847299117063,,2,"up"\n')
    (folder / "role_data.csv").write_text(",".join(ENTITIES["role_data"].names) + "\n" + ",".join(["9"] * len(ENTITIES["role_data"].names)) + "\n")
    message = {"channel": "7", "type": "message", "subtype": "default", "ts": "175928847299117063", "thread_ts": "",
               "time": "2020-05-01T10:11:12.000", "reply_count": "", "user": "1", "text": "hi"}
    _write(tmp_path, FIRST, "message_list", "7", 1588327872000000, [message])
    ws = Workspace(spark, str(tmp_path), FLAT)
    runs.run_batch_then_master(ws, FIRST)
    assert ws.master("role_data").count() == 1
    assert ("1", "2", "reacts") in rows(ws.metric(MASTER, "edge_data"), "source", "target", "relate")
    assert (tmp_path / FIRST / "metadata").exists()
