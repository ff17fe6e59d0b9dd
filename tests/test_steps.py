"""Loading by steps: any way of cutting the pages of some batches into steps gives the same tables."""

import random

import pytest
from pyspark.sql import functions as F

from parley.plans import loading, runs
from parley.plans.loading import add_step
from parley.plans.workspace import Workspace

FIRST, SECOND = "20200501101112", "20200601101112"
_CLOCK = 1588327872000000


def _post(n, **more):
    return {"type": "message", "ts": f"15880000{n:02d}.000100", "user": f"U{n % 3}", "text": f"post {n}", **more}


def _pages():
    """(batch, file name, content): replies whose parents are announced on other pages."""
    react = [{"name": "tada", "users": ["U1", "U2"]}]
    made = []
    for batch in (FIRST, SECOND):
        root = _post(1, reply_count=2, thread_ts="1588000001.000100", reactions=react)
        other = _post(5, reply_count=1, thread_ts="1588000005.000100")
        menu = [{"block_id": "poll-a-0123456789menu", "text": {"text": "Lunch?"}}, {"block_id": "poll-x", "text": {"text": "Soup `3`"}}]
        contents = {
            "user_list-all": {"members": [{"id": "U1", "name": f"ann {batch}", "real_name": "A", "tz": "", "profile": {}}]},
            "conversation_list-all": {"channels": [{"id": "C1", "name": "general", "is_channel": True}]},
            "conversation_list-more": {"channels": [{"id": "C2", "name": "closed", "is_channel": True, "is_private": True}]},
            "conversation_history-C1": {"messages": [root, _post(2, reactions=react, blocks=menu)]},
            "conversation_history-C2": {"messages": [_post(3), other]},
            # the same parent once more, on a later page
            "conversation_history-C1_b": {"messages": [root, _post(4)]},
            "conversation_replies-C1_1588000001.000100": {"messages": [root, _post(6, thread_ts="1588000001.000100", reactions=react)]},
            "conversation_replies-C2_1588000005.000100": {"messages": [other, _post(7, thread_ts="1588000005.000100")]},
            "conversation_replies-C2_1588000003.000100": {"messages": [_post(3), _post(8, thread_ts="1588000003.000100")]},
            "files_list-all": {"files": [{"id": "F1", "name": "f", "timestamp": 1588000000, "user": "U1", "channels": ["C1"]}]},
        }
        made += [(batch, f"{name}-{_CLOCK + i:016d}.json", str(content)) for i, (name, content) in enumerate(contents.items())]
    return made


def _frame(spark, pages):
    return spark.createDataFrame(pages, "batch_id string, file_name string, value string")


def _content(ws, rows, batch):
    tables = ws.tables(batch)
    return {name: rows(tables(name).distinct() if name in ("message_data", "thread_data", "reaction_data") else tables(name)) for name in ws.entities}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """The tables of full loads, with and without redaction."""
    found = {}
    for redact in (False, True):
        ws = Workspace(spark, str(tmp_path_factory.mktemp("whole")))
        for batch in (FIRST, SECOND):
            add_step(ws, _frame(spark, [p for p in _pages() if p[0] == batch]), f"load-{batch}", [batch], redact=redact, fresh=True)
        found[redact] = ws
    return found


@pytest.mark.parametrize(("seed", "redact"), [(1, False), (2, False), (3, True)])
def test_steps_equal_a_full_load(spark, tmp_path, rows, whole, seed, redact):
    dice = random.Random(seed)
    pages = _pages()
    dice.shuffle(pages)
    cuts = sorted(dice.sample(range(1, len(pages)), 2))
    ws = Workspace(spark, str(tmp_path))
    for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(pages)])):
        # a page that is sent again is no new page
        part = pages[a:b] + (pages[:2] if a else [])
        add_step(ws, _frame(spark, part), f"s-{i}", sorted({p[0] for p in part}), redact=redact)
    for batch in (FIRST, SECOND):
        got, want = _content(ws, rows, batch), _content(whole[redact], rows, batch)
        assert got == want
        assert len(got["thread_data"]) == 4 and len(got["reaction_data"]) == 6
        if redact:
            assert {text for (text,) in rows(ws.tables(batch)("message_data").where("channel = 'C2'"), "text")} == {""}


def test_a_step_evaluates_each_page_once_and_writes_all_its_batches_together(spark, tmp_path, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def opened(text):
        seen.add(1)
        return text

    pages = _frame(spark, _pages()).withColumn("value", opened("value"))
    writes = []
    write = loading.write_table
    monkeypatch.setattr(loading, "write_table", lambda df, path, *by: (writes.append(path), write(df, path, *by)))
    ws = Workspace(spark, str(tmp_path))
    add_step(ws, pages, "s-0", [FIRST, SECOND])
    assert seen.value == len(_pages()), "the content is read once, whatever the number of batches"
    assert len(writes) == len(set(writes)) == 3 + len(ws.entities)


def test_a_later_step_parses_its_own_pages_only(spark, tmp_path, monkeypatch):
    ws = Workspace(spark, str(tmp_path))
    pages = [p for p in _pages() if p[0] == FIRST]
    add_step(ws, _frame(spark, pages[:-1]), "s-0", [FIRST])
    parsed = []
    write = loading.write_table
    monkeypatch.setattr(loading, "write_table", lambda df, path, *by: (write(df, path, *by), parsed.append((path.split("/")[-1], df.count()))))
    add_step(ws, _frame(spark, pages), "s-1", [FIRST])
    counted = dict(parsed)
    assert counted["pages"] == 1 and counted["messages"] == counted["threads"] == 0
    assert {n: c for n, c in counted.items() if n.endswith("_data") and c} == {"file_data": 1}


def test_a_repeated_step_overwrites_itself_and_an_unfinished_one_does_not_count(spark, tmp_path, rows, monkeypatch):
    ws = Workspace(spark, str(tmp_path))
    pages = [p for p in _pages() if p[0] == FIRST]
    add_step(ws, _frame(spark, pages[:4]), "s-0", [FIRST])
    before = _content(ws, rows, FIRST)
    write = loading.write_table

    def failing(df, path, *by):
        if path.endswith("/reaction_data"):
            raise OSError("lost")
        write(df, path, *by)

    monkeypatch.setattr(loading, "write_table", failing)
    with pytest.raises(OSError, match="lost"):
        add_step(ws, _frame(spark, pages[4:]), "s-1", [FIRST])
    assert _content(ws, rows, FIRST) == before
    monkeypatch.undo()
    for _ in range(2):
        add_step(ws, _frame(spark, pages[4:]), "s-1", [FIRST])
    assert len(_content(ws, rows, FIRST)["thread_data"]) == 4
    assert runs.unreadable(ws, FIRST).count() == 0
