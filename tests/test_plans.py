"""Shape of the plans: what must not appear at scale."""

import re

import pytest
from tables import DATA

from parley.plans.bindings import Tables
from parley.plans.catalog import catalog

DECODING = {
    "decode_literal_pages", "unreadable_pages", "normalize_pages", "process_each_page",
    "users_from_pages", "page_offset_index", "channels_from_pages", "messages_from_pages",
    "threads_from_pages", "reactions_from_messages", "files_from_pages", "polls_from_pages",
    "read_chat_b_users", "read_chat_b_channels", "read_chat_b_messages", "read_chat_b_files",
    "private_channels",
}
# One task sees one row per partition (index), per column set (sizes) or a top list.
ONE_TASK = {"page_offset_index", "row_index", "size_varchar", "users_per_channel_merged"}


def _plan(spark, name):
    return catalog()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog()))
def test_plan(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    python = re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", plan)
    assert not python or name in DECODING
    assert "BatchEvalPython" not in plan
    if name not in ONE_TASK:
        assert "SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = _plan(spark, "upsert_insert_delta")
    assert "PushedFilters: [IsNotNull(o_orderdate)" in plan
    plan = _plan(spark, "count_by_channel_b")
    assert "props" not in plan.split("ReadSchema")[1]


def test_large_sides_are_not_broadcast(spark):
    """Without size estimates small enough, every join shuffles, and keys may be split."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("conversations", "extract_tags", "edges_interacts", "upsert_unique", "replay"):
            assert "BroadcastHashJoin" not in _plan(spark, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_posts_outside_threads_skip_the_parent_join(spark):
    from parley.operators.graph import edges_interacts

    plan = edges_interacts(Tables(spark, DATA).message())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 1 and plan.lstrip().startswith("Union")


def test_unknown_authors_do_not_meet_as_nulls(spark):
    from parley.operators.posts import conversations

    t = Tables(spark, DATA)
    plan = conversations(t.message(), None, t.user(), t.zone(), t.country())
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, \(_author#\d+ = _id#\d+\)", text)


@pytest.mark.parametrize("name", ["threads_from_pages", "reactions_from_messages"])
def test_no_page_is_shuffled_for_replies(spark, name):
    """Beyond the binding, which groups rows to pages, exchanges carry fields of messages only."""
    from parley.sources import page_tables

    rows = spark.createDataFrame([("conversation_history-C1-1588327872000000.json", "{}")], "file_name string, json string")
    replies = spark.createDataFrame([("conversation_replies-C1_1.2-1588327872000000.json", "{}")], "file_name string, json string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = getattr(page_tables, name)(rows, replies)
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = re.findall(r"\) Exchange\s+Input \[\d+\]: \[(.*?)\]\n", text)
    assert exchanges and not any(re.search(r"\b(json|page|value)#", e) for e in exchanges)


def test_a_run_parses_posts_once(spark, tmp_path):
    """Tables read the fields they need of the typed pages, and no JSON."""
    from parley.sources import page_tables

    rows = spark.createDataFrame([("conversation_history-C1-1588327872000000.json", '{"messages": [{"ts": "1.2"}]}')], "file_name string, json string")
    page_tables.typed_pages(rows).write.parquet(str(tmp_path / "typed"))
    typed = spark.read.parquet(str(tmp_path / "typed"))
    plan = page_tables.reactions_from_messages(typed, typed)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan
    schemas = re.findall(r"ReadSchema: (\S+)", plan)
    assert schemas and not any("text" in s or "blocks" in s for s in schemas)
