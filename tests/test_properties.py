"""Laws which hold between the metrics, on the bound test tables."""

import pytest
from tables import DATA
from pyspark.sql import functions as F

from parley.dialect import FLAT
from parley.functions.times import epoch_seconds
from parley.operators import counts, graph, posts, replies, tags
from parley.plans.bindings import Tables


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, DATA)


@pytest.fixture(scope="module")
def said(t):
    return posts.posts(t.message(), t.thread())


def _dict(df, *columns):
    return {r[0]: tuple(r)[1:] for r in df.select(*columns).collect()}


def test_user_counts_add_up_to_channel_counts(said):
    by_user = counts.count_by_channel_user(said).groupBy("channel").agg(F.sum("ts").alias("n"))
    whole = counts.count_by_channel(said.where("user_id is not null"))
    assert _dict(by_user, "channel", "n") == _dict(whole, "channel", "ts")


def test_thread_user_counts_add_up_to_thread_counts(said):
    known = said.where("user_id is not null")
    total = counts.count_by_thread(known).agg(F.sum("ts")).first()[0]
    assert counts.count_by_thread_user(said).agg(F.sum("ts")).first()[0] == total


def test_differences_add_up_to_the_span(said):
    diffs = replies.timediff_conversations(said, []).groupBy("channel").agg(F.sum("diff").cast("bigint").alias("s"))
    seconds = epoch_seconds("time")
    span = said.groupBy("channel").agg((F.max(seconds) - F.min(seconds)).cast("bigint").alias("s"))
    assert _dict(diffs, "channel", "s") == _dict(span, "channel", "s")


def test_slices_change_nothing(said):
    columns = ["channel", "ts", "text", "diff"]
    bounds = replies.post_bounds(said, rows_per_slice=50)
    assert len(bounds) > 10
    for measure in (replies.timediff_conversations, replies.timediff_threads):
        one, many = measure(said, []).select(*columns), measure(said, bounds).select(*columns)
        assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_top_users_have_the_highest_count(t, said):
    top = counts.top_users_per_channel(said, t.user(), t.channel())
    highest = counts.max_per_channel(said)
    assert _dict(top, "channel_id", "ts") == _dict(highest, "channel", "ts")


def test_one_team_edge_per_post(t):
    teams = graph.edges_teams(t.message_b()).groupBy("channel").count()
    assert _dict(teams, "channel", "count") == _dict(counts.count_by_channel(t.message_b(), FLAT), "channel", "ts")


def test_shared_channel_edges_are_symmetric(t):
    edges = graph.edges_interacts_b(t.message_b())
    everyone = t.message_b().select("user_id")
    listed = graph.interacts_of(t.message_b(), everyone.where("user_id is not null"))
    # An unknown author is a target of all, and in turn has all as targets.
    known = edges.where("source is not null").agg(F.sum("edges")).first()[0]
    assert listed.agg(F.sum("weight")).first()[0] == known


def test_a_refers_edge_per_user_tag_of_a_known_author(t):
    only = t.message().where("channel <> 'CX'")
    found = tags.extract_tags(only, t.user())
    authored = tags.mentions(only.where("user_id is not null")).where("type = 'user'").count()
    assert graph.edges_refers(only, found).count() == authored
