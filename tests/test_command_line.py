import pytest

from parley import FLAT, THREADED
from parley import __main__ as command_line


@pytest.fixture
def calls(spark, monkeypatch):
    seen = []

    def record(name, result):
        def call(ws, *arguments):
            seen.append((name, ws.home, ws.dialect, *arguments))
            return result

        return call

    for name in ("run", "run_batch_then_master", "replay_all"):
        monkeypatch.setattr(command_line.runs, name, record(name, ["user_data", "tag_data"]))
    monkeypatch.setattr(command_line.runs, "compact", record("compact", "v-00000001"))
    for name in ("export_tables", "export_metrics", "export_deltas", "export_changes", "load_database"):
        monkeypatch.setattr(command_line.exports, name, record(name, []))
    return seen


def test_runs(calls):
    command_line.main(["run", "home"])
    command_line.main(["run", "home", "20200501101112", "3", "--flat", "--redact"])
    command_line.main(["newest", "home", "--poll-channel", "C1"])
    command_line.main(["replay", "home"])
    assert calls == [
        ("run", "home", THREADED, None, None, None, False),
        ("run", "home", FLAT, "20200501101112", 3, None, True),
        ("run_batch_then_master", "home", THREADED, None, "C1", False),
        ("replay_all", "home", THREADED, None, False),
    ]


def test_csv(calls):
    command_line.main(["run", "home", "20200501101112", "--csv"])
    assert calls[1:] == [
        ("export_tables", "home", THREADED, "20200501101112", False),
        ("export_metrics", "home", THREADED, ["tag_data"], "20200501101112"),
    ]


def test_numbered_and_deltas(calls):
    command_line.main(["run", "home", "20200501101112", "--csv", "--numbered", "--deltas"])
    assert ("export_tables", "home", THREADED, "20200501101112", True) in calls
    assert calls[-1] == ("export_deltas", "home", THREADED, "20200501101112")


def test_compact(calls):
    assert command_line.main(["compact", "home"]) == ["v-00000001"]
    command_line.main(["compact", "home", "--whole"])
    assert calls == [("compact", "home", THREADED, False), ("compact", "home", THREADED, True)]


def test_changes(calls):
    command_line.main(["changes", "home", "--flat"])
    assert calls == [("export_changes", "home", FLAT)]


def test_load(calls, tmp_path):
    file = tmp_path / "database.properties"
    file.write_text("[db]\ndatabase.url=jdbc:x\ndatabase.driver=d\ndatabase.user=u\ndatabase.password=p\n")
    command_line.main(["load", "home", str(file), "db", "--sized"])
    options = {"url": "jdbc:x", "driver": "d", "user": "u", "password": "p"}
    assert calls == [("load_database", "home", THREADED, options, True)]


def test_unknown_stage_is_refused():
    with pytest.raises(SystemExit):
        command_line.main(["run", "home", "20200501101112", "5"])
