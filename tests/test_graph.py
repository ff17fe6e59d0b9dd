from datetime import datetime

import pytest

from parley.dialect import FLAT
from parley.operators import counts, graph, members, posts, tags

POSTS = (
    "channel string, type string, subtype string, ts string, thread_ts string,"
    " time timestamp_ntz, user_id string, text string"
)
USERS = "id string, name string, real_name string, tz string, email string, batch string"
T = datetime(2020, 5, 1)


def _post(channel, ts, user, thread=None, text="x", subtype=None):
    return (channel, "message", subtype, ts, thread, T, user, text)


@pytest.fixture
def table(spark):
    return lambda *rows: spark.createDataFrame(list(rows), POSTS)


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [
            ("U1", "ann", "Ann A", "Asia/Tokyo", "", "100"),
            ("U2", "bob", "Bob B", "UTC", "", "5"),
            ("U3", "cy", "Cy C", None, "", "7"),
            ("U4", "di", "Di D", "America/Indiana/Knox", "", "x"),
        ],
        USERS,
    )


@pytest.fixture
def places(spark):
    zone = spark.createDataFrame([("JP", "Asia/Tokyo"), ("XX", "Mars/Base")], "ISO string, TZ string")
    country = spark.createDataFrame([("JP", "Japan")], "ISO2 string, COUNTRY string")
    return zone, country


def test_geography_falls_back_to_the_zone_text(users, places, rows):
    geo = posts.user_geo(users, *places)
    assert rows(geo, "id", "country", "city", "iso") == [
        ("U1", "Japan", "Tokyo", "JP"), ("U2", "UTC", None, None),
        ("U3", None, None, None), ("U4", "America", "Indiana", None),
    ]
    flat = posts.user_geo(users, dialect=FLAT)
    assert rows(flat, "country", "city", "iso") == [("", "", "")] * 4


def test_conversation_keeps_copies_that_differ(table, users, places, rows):
    message = table(_post("C1", "1", "U1"), _post("C1", "1", "U1"), _post("C1", "2", None))
    thread = table(_post("C1", "1", "U1"), _post("C1", "2", "U9"))
    both = posts.conversations(message, thread, users, *places)
    assert rows(both, "ts", "user_id", "name") == [("1", "U1", "ann"), ("2", "U9", None), ("2", None, None)]
    one = posts.conversations(message, thread, users, *places, prefer_thread=True)
    assert rows(one, "ts", "user_id") == [("1", "U1"), ("2", "U9")]


def test_interacts(table, rows):
    active = table(
        _post("C1", "1", "U1", "1"),  # root of a thread: its parent is itself, no edge
        _post("C1", "2", "U2", "1"),  # reply to U1
        _post("C1", "3", "U1", "1"),  # self reply, no edge
        _post("C1", "4", "U3"),  # no thread: edge to the channel
        _post("C1", "5", "U3", "99"),  # parent unknown: edge to the channel
        _post("C1", "6", None),  # unknown author: edge from null
        _post("C1", "7", None, "7"),  # null differs from null
        _post("C1", "8", "U2", subtype="channel_join"),  # no activity
    )
    assert rows(graph.edges_interacts(active), "source", "target", "relate") == [
        ("U2", "U1", "interacts"), ("U3", "C1", "interacts"), ("U3", "C1", "interacts"),
        (None, "C1", "interacts"), (None, "C1", "interacts"),
    ]


def test_equal_ids_in_two_channels(table, rows):
    active = table(
        _post("C1", "1", "U1", "1"), _post("C2", "1", "U3", "1"), _post("C1", "2", "U2", "1"),
    )
    by_id = rows(graph.edges_interacts(active), "channel", "source", "target")
    assert by_id == [("C1", "U1", "U3"), ("C1", "U2", "U1"), ("C1", "U2", "U3"), ("C2", "U3", "U1")]
    in_channel = graph.edges_interacts(active, join_keys=("channel", "ts"))
    assert rows(in_channel, "channel", "source", "target") == [("C1", "U2", "U1")]


def test_reacts_goes_from_author_to_reactor(spark, table, rows):
    reaction = spark.createDataFrame(
        [("C1", "1", "", "U2", "tada"), ("C1", "1", "", "U1", "eyes"), ("C1", "1", "", None, "x")],
        "channel string, ts string, thread_ts string, user_id string, reaction string",
    )
    edges = graph.edges_reacts(table(_post("C1", "1", "U1"), _post("C1", "2", "U1")), reaction)
    assert rows(edges, "source", "target") == [("U1", "U1"), ("U1", "U2")]


def test_tags(table, users, rows):
    text = "<@U1> <@U1> <@U2|bob> <@> <#C1|general> <#C2> <http://a|A|b> <http://b> <> <!here>\r<@U3\r>"
    found = tags.extract_tags(table(_post("C1", "1", "U1", text=text), _post("C1", "2", "U1", text=None)), users)
    assert rows(found, "type", "tag", "nice_tag") == [
        ("channel", "C1", "general"), ("channel", "C2", None),
        ("link", "!here", None), ("link", "http://a", "A"), ("link", "http://b", None),
        ("user", "", None), ("user", "U1", "Ann A"), ("user", "U1", "Ann A"),
        ("user", "U2|bob", None), ("user", "U3\r", None),
    ]
    plain = table(_post("C1", "1", "U1", text="<@!U1> <@U2> <#C1>", subtype="default"))
    assert rows(tags.extract_tags(plain, users, FLAT), "tag", "nice_tag") == [("U1", "Ann A")]


def test_refers_has_one_edge_per_mention(table, users, rows):
    active = table(_post("C1", "1", "U1", text="<@U2> <@U2> <#C1>"), _post("C1", "2", None, text="<@U2>"))
    found = tags.extract_tags(active, users)
    assert rows(graph.edges_refers(active, found), "source", "target") == [("U1", "U2"), ("U1", "U2")]


def test_nodes(spark, users, places, rows):
    channels = spark.createDataFrame(
        [("C1", "general", "channel", "public", "False", "False"), ("C2", None, "im", "public", "", "True")],
        "id string, name string, type string, class string, is_archived string, is_private string",
    )
    got = graph.nodes(users, channels, *places)
    assert rows(got.where("type = 'channel'"), "id", "label", "name", "channel_type") == [
        ("C1", "general", "general", "channel"), ("C2", "C2", "C2", "im"),
    ]
    assert got.where("type = 'user'").count() == 4


def test_factorized_interactions_equal_all_pairs(table, rows):
    data = [
        _post(c, str(i), u, subtype="default")
        for i, (c, u) in enumerate([("C1", "a")] * 3 + [("C1", "b")] * 2 + [("C1", None)] * 2 + [("C2", "a")])
    ]
    pairs = {}
    for x in data:
        for y in data:
            different = x[6] is None or y[6] is None or x[6] != y[6]
            if x[0] == y[0] and different:
                pairs.setdefault((x[0], x[6]), {}).setdefault(y[6], 0)
                pairs[(x[0], x[6])][y[6]] += 1
    active = table(*data)
    got = {(r.channel, r.source): (r.targets, r.edges) for r in graph.edges_interacts_b(active).collect()}
    assert got == {k: (len(v), sum(v.values())) for k, v in pairs.items()}
    listed = graph.interacts_of(active, active.where("user_id = 'a'"))
    assert rows(listed, "source", "target", "weight") == [("a", "b", 6), ("a", None, 6)]


def test_user_activity(spark, table, users, rows):
    said = table(
        _post("C1", "9", "U1", subtype="channel_join"), _post("C1", "10", "U1"),
        _post("C1", "100", "U1", subtype="thread_broadcast"), _post("C1", "11", "U2", subtype="bot"),
        _post("C1", "12", None),
    )
    reaction = spark.createDataFrame(
        [("C1", "9", "", "U3", "a"), ("C1", "10", "", "U3", "b")],
        "channel string, ts string, thread_ts string, user_id string, reaction string",
    )
    got = members.user_activity(users, said, reaction)
    assert rows(got.drop("name")) == [
        ("U1", "9", "9", 2, "10", "100", None, None, None),
        ("U2", "5", "11", None, None, None, None, None, None),
        ("U3", "7", None, None, None, None, 2, "9", "10"),
        ("U4", "x", None, None, None, None, None, None, None),
    ]


def test_counts_drop_null_keys_and_keep_ties(spark, table, users, rows):
    said = table(
        _post("C1", "1", "U1", "1"), _post("C1", "2", "U2"), _post("C1", "3", None),
        _post("C2", "4", "U1"), _post("C2", "5", "U1"), _post("C2", "6", "U2"),
        _post(None, "7", "U2"), _post("C2", "8", "U2", subtype="bot"),
    )
    assert rows(counts.count_by_channel(said)) == [("C1", 3, 1), ("C2", 3, 0)]
    assert rows(counts.count_by_channel_user(said), "channel", "user_id", "ts") == [
        ("C1", "U1", 1), ("C1", "U2", 1), ("C2", "U1", 2), ("C2", "U2", 1),
    ]
    assert rows(counts.users_per_channel(said)) == [("C1", 2), ("C2", 2)]
    channels = spark.createDataFrame([("C1", "one")], "id string, name string")
    top = counts.top_users_per_channel(said, users, channels)
    assert rows(top) == [
        ("C1", "one", "U1", "Ann A", 1), ("C1", "one", "U2", "Bob B", 1), ("C2", None, "U1", "Ann A", 2),
    ]
    assert rows(counts.count_by_thread(said)) == [("C1", "1", 1)]
