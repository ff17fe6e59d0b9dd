"""Schemas of the decoded pages, the entity tables and the metric tables.

Fixed values: names, order and types of the columns, and the keys of the pages.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType, TimestampNTZType

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "timestamp_ntz": TimestampNTZType()}


def _table(columns: str) -> StructType:
    """A flat schema out of ``name type, name type``, without asking a session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


# -- decoded pages ----------------------------------------------------------------------

MEMBERS_PAGE = """members array<struct<
    id string, name string, tz string, real_name string, profile struct<email string>>>"""

CHANNELS_PAGE = """channels array<struct<
    id string, name string, is_channel boolean, is_mpim boolean, is_im boolean,
    is_private boolean, is_archived boolean>>"""

# History pages and reply pages have the same shape. Each reader parses only its own fields.
_POST_FIELDS = """type string, subtype string, ts string, thread_ts string, reply_count string,
    user string, text string"""
_REACTION_FIELDS = "reactions array<struct<name string, users array<string>>>"
_BLOCK_FIELDS = "blocks array<struct<block_id string, text struct<text string>>>"

POSTS_IN_PAGE = f"messages array<struct<{_POST_FIELDS}>>"
REPLIES_IN_PAGE = "messages array<struct<ts string, reply_count string>>"
REACTIONS_IN_PAGE = f"""messages array<struct<
    ts string, thread_ts string, reply_count string, {_REACTION_FIELDS}>>"""
BLOCKS_IN_PAGE = f"messages array<struct<ts string, {_BLOCK_FIELDS}>>"
MESSAGES_PAGE = f"messages array<struct<{_POST_FIELDS}, {_REACTION_FIELDS}, {_BLOCK_FIELDS}>>"

FILES_PAGE = """files array<struct<
    id string, name string, timestamp string, user string, channels array<string>>>"""

# Pages of the second product are lists of flat records.
FLAT_USERS = "array<struct<id string, name string, real_name string, tz string, email string, batch string>>"
FLAT_CHANNELS = """array<struct<
    id string, name string, type string, class string, is_archived boolean, is_private boolean>>"""
FLAT_MESSAGES = """array<struct<
    channel string, type string, subtype string, ts string, thread_ts string, time string,
    reply_count string, user string, text string>>"""
FLAT_FILES = "array<struct<id string, channel string, name string, time string, user string>>"

# -- entity tables ------------------------------------------------------------------------

ENTITIES = {
    "user_data": _table(
        "id string, name string, real_name string, tz string, email string, batch string"
    ),
    "channel_data": _table(
        "id string, name string, type string, class string, is_archived string, is_private string"
    ),
    "message_data": _table(
        "channel string, type string, subtype string, ts string, thread_ts string,"
        " time timestamp_ntz, reply_count int, user_id string, text string"
    ),
    "thread_data": _table(
        "channel string, type string, subtype string, ts string, thread_ts string,"
        " time timestamp_ntz, user_id string, text string"
    ),
    "reaction_data": _table(
        "channel string, ts string, thread_ts string, user_id string, reaction string"
    ),
    "file_data": _table(
        "id string, channel string, name string, time timestamp_ntz, user_id string"
    ),
    "poll_data": _table(
        "poll_id string, ts string, time timestamp_ntz, text string,"
        " vote_item string, vote_count int"
    ),
    "role_data": _table("id string, name string, user_id string"),
}

REFERENCES = {
    "channel_ref": _table("id string, index int, category_name string, category_index int"),
    "zone": _table("ISO string, TZ string"),
    "country": _table("ISO2 string, COUNTRY string"),
}

# Columns shared by messages and thread replies.
POST_COLUMNS = ["channel", "type", "subtype", "ts", "thread_ts", "time", "user_id", "text"]

CONVERSATION_COLUMNS = [
    "channel", "type", "subtype", "ts", "thread_ts", "ts_int", "time", "user_id",
    "real_name", "name", "text", "city", "country", "iso",
]

# Metrics of the master which lie in partitions by day.
BY_DAY = {
    "conversation_data": _table(
        "channel string, type string, subtype string, ts string, thread_ts string, ts_int double,"
        " time timestamp_ntz, user_id string, real_name string, name string, text string,"
        " city string, country string, iso string"
    ),
    "tag_data": _table("channel string, ts string, tag string, nice_tag string, type string"),
}

NODE_COLUMNS = [
    "id", "label", "type", "name", "iso", "country", "city", "channel_type", "channel_class",
]

EDGE_COLUMNS = ["channel", "source", "target", "time", "relate"]
