"""The registered queries: each operator over the bindings of ``parley.plans.bindings``.

Arrays and typed times are turned to text at the end, so that any engine can compare them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.dialect import FLAT
from parley.functions import times
from parley.operators import counts, feed, graph, members, merge, ordered, posts, replies, states, tags, texts
from parley.operators.filters import activity, threaded
from parley.plans import base
from parley.plans.bindings import Tables, snowflake
from parley.session import require_checkpoint_dir
from parley.sinks import jdbc
from parley.sources import page_tables
from parley.sources.pages import decode_literal, normalize_pages_to_json, page_faults, page_keys, process_pages

Query = Callable[[SparkSession, str], DataFrame]
_CATALOG: dict[str, Query] = {}


def _query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _CATALOG[function.__name__] = lambda spark, folder: function(Tables(spark, folder))
    return function


def catalog() -> dict[str, Query]:
    return dict(_CATALOG)


def _timed(df: DataFrame, column: str = "time") -> DataFrame:
    return df.withColumn(column, times.iso_text(column))


def _conversations(t: Tables) -> DataFrame:
    return posts.conversations(t.message(), t.thread(), t.user(), t.zone(), t.country())


def _posts(t: Tables) -> DataFrame:
    return posts.posts(t.message(), t.thread())


# -- counts -----------------------------------------------------------------------------------


@_query
def count_by_channel(t: Tables) -> DataFrame:
    return counts.count_by_channel(_posts(t))


@_query
def count_by_channel_user(t: Tables) -> DataFrame:
    return counts.count_by_channel_user(_posts(t))


@_query
def users_per_channel(t: Tables) -> DataFrame:
    return counts.users_per_channel(_posts(t))


@_query
def users_per_channel_merged(t: Tables) -> DataFrame:
    """The same from the states of two parts of the posts. Users of the second part who are not
    in the first are numbered on."""
    rows = _posts(t).withColumn("_late", F.pmod(F.xxhash64("channel", "ts"), F.lit(3)) == 0)
    early, late = rows.where(~F.col("_late")), rows.where("_late")
    first = states.number_users(early)
    numbers = states.number_users(late, first)
    state = states.merge_states(states.user_states(early, first), states.user_states(late, numbers))
    return states.users_of_states(state)


@_query
def max_per_channel(t: Tables) -> DataFrame:
    return counts.max_per_channel(_posts(t))


@_query
def top_users_per_channel(t: Tables) -> DataFrame:
    return counts.top_users_per_channel(_posts(t), t.user(), t.channel())


@_query
def count_by_thread(t: Tables) -> DataFrame:
    return counts.count_by_thread(_posts(t))


@_query
def count_by_thread_user(t: Tables) -> DataFrame:
    return counts.count_by_thread_user(_posts(t))


@_query
def count_by_channel_b(t: Tables) -> DataFrame:
    return counts.count_by_channel(t.message_b(), FLAT)


@_query
def top_users_per_channel_b(t: Tables) -> DataFrame:
    return counts.top_users_per_channel(t.message_b(), t.user(), t.channel(), FLAT)


# -- posts and members ------------------------------------------------------------------------


@_query
def activity_posts(t: Tables) -> DataFrame:
    return _timed(activity(_posts(t)))


@_query
def threaded_posts(t: Tables) -> DataFrame:
    return _timed(threaded(_posts(t)))


@_query
def posts_prefer_thread(t: Tables) -> DataFrame:
    return _timed(posts.posts(t.message(), t.thread(), prefer_thread=True))


@_query
def conversations(t: Tables) -> DataFrame:
    return _timed(_conversations(t))


@_query
def conversations_b(t: Tables) -> DataFrame:
    return _timed(posts.conversations(t.message_b(), None, t.user(), dialect=FLAT))


@_query
def user_geo(t: Tables) -> DataFrame:
    return posts.user_geo(t.user(), t.zone(), t.country())


@_query
def user_activity(t: Tables) -> DataFrame:
    return members.user_activity(t.user(), _posts(t), t.reaction())


@_query
def user_activity_b(t: Tables) -> DataFrame:
    return members.user_activity(t.user(), t.message_b(), t.reaction_b(), FLAT)


# -- time differences ---------------------------------------------------------------------------

_DIFF = ["channel", "ts", "thread_ts", "user_id", "text", "diff"]


def _kept(rows: DataFrame) -> DataFrame:
    """Rows as a run has them: stored, as the bounds and the measure read them several times."""
    path = f"{require_checkpoint_dir(rows.sparkSession)}/posts-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@_query
def timediff_conversations(t: Tables) -> DataFrame:
    rows = _kept(_posts(t))
    return replies.timediff_conversations(rows, replies.post_bounds(rows)).select(*_DIFF)


@_query
def timediff_threads(t: Tables) -> DataFrame:
    rows = _kept(_posts(t))
    return replies.timediff_threads(rows, replies.post_bounds(rows)).select(*_DIFF)


@_query
def timediff_users(t: Tables) -> DataFrame:
    rows = _kept(_posts(t))
    return replies.timediff_users(rows, replies.post_bounds(rows)).select(*_DIFF)


@_query
def timediff_users_b(t: Tables) -> DataFrame:
    rows = _kept(t.message_b())
    return replies.timediff_users(rows, replies.post_bounds(rows), FLAT).select(*_DIFF)


@_query
def timediff_sliced(t: Tables) -> DataFrame:
    """The channel measure with its order cut into small slices, as a large channel has it."""
    rows = _kept(_posts(t))
    bounds = replies.post_bounds(rows, rows_per_slice=2000)
    return replies.timediff_conversations(rows, bounds).select(*_DIFF)


@_query
def user_hash(t: Tables) -> DataFrame:
    """Posts by hash: as many, and of as many users, as by the user id itself."""
    hashed = _posts(t).groupBy(replies.user_hash()).agg(
        F.min("user_id").alias("user_id"), F.count("*").alias("rows"), F.countDistinct("user_id").alias("users")
    )
    return hashed.select("user_id", "rows", "users")


# -- tags and graph -----------------------------------------------------------------------------


@_query
def extract_tags(t: Tables) -> DataFrame:
    return tags.extract_tags(_posts(t), t.user())


@_query
def extract_tags_b(t: Tables) -> DataFrame:
    return tags.extract_tags(t.message_b(), t.user(), FLAT)


@_query
def nodes(t: Tables) -> DataFrame:
    return graph.nodes(t.user(), t.channel(), t.zone(), t.country())


@_query
def nodes_b(t: Tables) -> DataFrame:
    return graph.nodes(t.user(), t.channel(), dialect=FLAT)


@_query
def edges_interacts(t: Tables) -> DataFrame:
    return _timed(graph.edges_interacts(t.message()))


@_query
def edges_interacts_in_channel(t: Tables) -> DataFrame:
    return _timed(graph.edges_interacts(t.message(), join_keys=("channel", "ts")))


@_query
def edges_reacts(t: Tables) -> DataFrame:
    return _timed(graph.edges_reacts(t.message(), t.reaction()))


@_query
def edges_refers(t: Tables) -> DataFrame:
    found = tags.extract_tags(t.message(), t.user())
    return _timed(graph.edges_refers(t.message(), found))


@_query
def edges(t: Tables) -> DataFrame:
    """The complete edge table of the first product."""
    found = tags.extract_tags(t.message(), t.user())
    return _timed(graph.edges(t.message(), t.reaction(), found))


@_query
def edges_teams(t: Tables) -> DataFrame:
    return graph.edges_teams(t.message_b())


@_query
def edges_untimed_b(t: Tables) -> DataFrame:
    found = tags.extract_tags(t.message_b(), t.user(), FLAT)
    return graph.edges_untimed(t.message_b(), t.reaction_b(), found)


@_query
def edges_interacts_b(t: Tables) -> DataFrame:
    return graph.edges_interacts_b(t.message_b())


@_query
def interacts_of(t: Tables) -> DataFrame:
    """Co-members of the users who joined a channel last."""
    joined = t.message_b().where(F.col("subtype") == "channel_join")
    latest = joined.groupBy("channel").agg(F.max_by("user_id", times.ts_key("ts")).alias("user_id"))
    return graph.interacts_of(t.message_b(), latest)


# -- merging ------------------------------------------------------------------------------------

_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "batch")
_BY_ORDER = merge.EntitySpec("orders", ("o_orderkey",), _ORDER_COLUMNS, keep_first=("batch",))
_BY_CUSTOMER = merge.EntitySpec("orders", ("o_custkey",), _ORDER_COLUMNS)


@_query
def upsert_unique(t: Tables) -> DataFrame:
    return merge.upsert(*t.order_batches(), _BY_ORDER)


@_query
def upsert_group(t: Tables) -> DataFrame:
    return merge.upsert(*t.order_batches(), _BY_CUSTOMER)


@_query
def upsert_insert_delta(t: Tables) -> DataFrame:
    return merge.insert_delta(*t.order_batches(), _BY_ORDER)


@_query
def upsert_update_delta(t: Tables) -> DataFrame:
    return merge.update_delta(*t.order_batches(), _BY_ORDER)


@_query
def merge_counts(t: Tables) -> DataFrame:
    return merge.merge_counts(merge.changes(*t.order_batches(), _BY_ORDER))


_ORDERS_OF_CUSTOMERS = merge.EntitySpec("orders", ("o_custkey",), ("o_custkey", "o_orderkey", "o_orderstatus"))


def _order_years(t: Tables) -> DataFrame:
    """Orders whose year is the batch; the key, a customer, is a group."""
    return t.read("orders").withColumn("batch_id", F.year("o_orderdate"))


@_query
def replay(t: Tables) -> DataFrame:
    """Orders of the last year of each customer."""
    return merge.replay(_order_years(t), _ORDERS_OF_CUSTOMERS)


_LINES = merge.EntitySpec(
    "lines", ("l_orderkey",), ("l_orderkey", "state", "part", "first_part"), keep_first=("first_part",)
)


def _line_batches(t: Tables) -> DataFrame:
    return (
        t.read("lineitem")
        .groupBy("l_orderkey", F.col("l_linenumber").alias("batch_id"))
        .agg(F.max("l_linestatus").alias("state"), F.max("l_partkey").alias("part"))
        .withColumn("first_part", F.col("part"))
    )


@_query
def replay_first_seen(t: Tables) -> DataFrame:
    """One row per order out of its line items: the last state, the first part seen."""
    return merge.replay(_line_batches(t), _LINES)


@_query
def change_feed(t: Tables) -> DataFrame:
    """What each year of orders inserted and updated."""
    return feed.change_feed(_order_years(t), _ORDERS_OF_CUSTOMERS)


@_query
def change_feed_first_seen(t: Tables) -> DataFrame:
    """What each line item of an order changed; an update carries the first part."""
    return feed.change_feed(_line_batches(t), _LINES)


@_query
def feed_counts(t: Tables) -> DataFrame:
    return feed.feed_counts(feed.change_feed(_order_years(t), _ORDERS_OF_CUSTOMERS))


def _orders_as_reactions(t: Tables) -> DataFrame:
    """Three batches of orders as reactions to a post: a group for each customer."""
    year = F.year("o_orderdate")
    batch_id = F.when(year < 1994, 1).when(year < 1996, 2).otherwise(3)
    return t.read("orders").select(
        F.col("o_orderpriority").alias("channel"), F.col("o_custkey").cast("string").alias("ts"),
        F.lit("").alias("thread_ts"), F.col("o_orderkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("reaction"), batch_id.alias("batch_id"), batch_id.alias("first_id"),
    )


@_query
def master_of_batches(t: Tables) -> DataFrame:
    """The first and the third batch are compacted to a base, and the second comes late."""
    return _late_batch(_orders_as_reactions(t), merge.SPECS["reaction_data"])


@_query
def master_from_base(t: Tables) -> DataFrame:
    """The same with a stored base in buckets, to which the third batch is compacted."""
    spec, rows = merge.SPECS["reaction_data"], _orders_as_reactions(t)
    home = f"{require_checkpoint_dir(t.spark)}/base-{uuid.uuid4().hex}"
    state = merge.replay(rows.where("batch_id = 1"), spec, first="first_id", state=True)
    table = base.write_base(t.spark, home, spec, state, 1, buckets=int(t.spark.conf.get("spark.sql.shuffle.partitions")))
    table = base.update_base(t.spark, table, rows.where("batch_id = 3").drop("first_id"), spec, 2)
    return base.joined(t.spark, table, rows.where("batch_id = 2").drop("first_id"), spec).select(*spec.columns)


@_query
def master_of_users(t: Tables) -> DataFrame:
    """The same for one row per customer and batch as users, who keep their first-seen batch."""
    year = F.year("o_orderdate")
    batch_id = F.when(year < 1994, 1).when(year < 1996, 2).otherwise(3)
    rows = t.read("orders").groupBy("o_custkey", batch_id.alias("batch_id")).agg(F.max("o_orderkey").alias("last"))
    user = rows.select(
        F.col("o_custkey").cast("string").alias("id"), F.col("last").cast("string").alias("name"),
        *[F.lit("").alias(c) for c in ("real_name", "tz", "email")], F.col("batch_id").cast("string").alias("batch"),
        "batch_id", F.col("batch_id").alias("first_id"),
    )
    return _late_batch(user, merge.SPECS["user_data"])


def _late_batch(rows: DataFrame, spec: merge.EntitySpec) -> DataFrame:
    base = merge.replay(rows.where("batch_id <> 2"), spec, first="first_id", state=True)
    return merge.replay(base.unionByName(rows.where("batch_id = 2")), spec, first="first_id")


# -- raw pages ------------------------------------------------------------------------------------


@_query
def decode_literal_pages(t: Tables) -> DataFrame:
    """History pages through the decoder: one row per page with its keys and its length."""
    decoded = page_keys(decode_literal(t.history_pages()))
    size = F.size(F.from_json("json", "messages array<struct<ts string>>")["messages"])
    return decoded.select("channel", "page_clock", size.cast("bigint").alias("messages"))


@_query
def reply_page_keys(t: Tables) -> DataFrame:
    return page_keys(t.reply_pages()).select("file_name", "channel", "parent_ts", "page_clock")


@_query
def unreadable_pages(t: Tables) -> DataFrame:
    """Among good pages of messages: raw web pages, which are no literals, and pages of users,
    which hold no messages."""
    raw = t.read("pages").select(F.col("page_id").cast("string").alias("file_name"), F.col("html").alias("value"))
    pages = t.history_pages().unionByName(raw).unionByName(t.user_pages())
    return page_faults(decode_literal(pages).withColumn("kind", F.lit("messages")))


@_query
def normalize_pages(t: Tables) -> DataFrame:
    """Normalized pages read back as JSON: ids and texts of all messages."""
    pages = normalize_pages_to_json(t.history_pages())
    m = page_tables.page_messages(pages)
    return m.select("channel", "m.ts", "m.text")


@_query
def process_each_page(t: Tables) -> DataFrame:
    """A user function per page: number of messages and of known authors."""

    def measure(infile: str, result: dict, field: str) -> pd.DataFrame:
        known = [m for m in result["messages"] if m[field] is not None]
        return pd.DataFrame(
            {"file_name": [infile], "messages": [len(result["messages"])], "known": [len(known)]}
        )

    schema = "file_name string, messages bigint, known bigint"
    return process_pages(t.history_pages(), measure, schema, field="user")


@_query
def users_from_pages(t: Tables) -> DataFrame:
    return page_tables.users_from_pages(decode_literal(t.user_pages()), "20240203040506")


@_query
def page_offset_index(t: Tables) -> DataFrame:
    placed = page_tables.users_from_pages(decode_literal(t.user_pages()), "20240203040506", place=True)
    return page_tables.page_offset_index(placed).select("index", "id")


@_query
def channels_from_pages(t: Tables) -> DataFrame:
    return page_tables.channels_from_pages(decode_literal(t.channel_pages()))


@_query
def messages_from_pages(t: Tables) -> DataFrame:
    return _timed(page_tables.messages_from_pages(decode_literal(t.history_pages())))


@_query
def threads_from_pages(t: Tables) -> DataFrame:
    history, answers = decode_literal(t.history_pages()), decode_literal(t.reply_pages())
    return _timed(page_tables.threads_from_pages(history, answers))


@_query
def reactions_from_messages(t: Tables) -> DataFrame:
    history, answers = decode_literal(t.history_pages()), decode_literal(t.reply_pages())
    return page_tables.reactions_from_messages(history, answers)


@_query
def files_from_pages(t: Tables) -> DataFrame:
    return _timed(page_tables.files_from_pages(decode_literal(t.file_pages())))


@_query
def polls_from_pages(t: Tables) -> DataFrame:
    return _timed(page_tables.polls_from_pages(decode_literal(t.history_pages())))


@_query
def read_chat_b_users(t: Tables) -> DataFrame:
    return page_tables.flat_users(decode_literal(t.flat_user_pages()))


@_query
def read_chat_b_channels(t: Tables) -> DataFrame:
    return page_tables.flat_channels(decode_literal(t.flat_channel_pages()))


@_query
def read_chat_b_messages(t: Tables) -> DataFrame:
    return _timed(page_tables.flat_messages(decode_literal(t.flat_message_pages())))


@_query
def read_chat_b_files(t: Tables) -> DataFrame:
    return _timed(page_tables.flat_files(decode_literal(t.flat_file_pages())))


@_query
def redact_private(t: Tables) -> DataFrame:
    private = t.channel().where("type in ('mpim', 'im') or is_private = 'True'")
    hidden = page_tables.redact_private(t.message(), private.select(F.col("id").alias("channel")))
    return _timed(hidden)


@_query
def private_channels(t: Tables) -> DataFrame:
    return page_tables.private_channels(decode_literal(t.channel_pages()))


@_query
def channel_class_b(t: Tables) -> DataFrame:
    return page_tables.channel_class_b(t.overwrites()).drop("roles")


# -- scalars and sinks ------------------------------------------------------------------------------


def _milliseconds(time: Column) -> Column:
    return (times.epoch_seconds(time) * 1000).cast("bigint")


@_query
def snowflake_time(t: Tables) -> DataFrame:
    ids = t.base().select("event_id", snowflake("seconds", "event_id").alias("snowflake"))
    created = _milliseconds(times.snowflake_time("snowflake"))
    return ids.withColumn("created_ms", created)


@_query
def invite_epoch(t: Tables) -> DataFrame:
    """The invite date of a batch exported at the time of each order."""
    batch = F.translate(F.substring(F.col("o_orderdate").cast("string"), 1, 19), "-: ", "")
    return t.read("orders").select("o_orderkey", times.invite_epoch(batch).alias("invite"))


@_query
def size_varchar(t: Tables) -> DataFrame:
    """Column types for the documents, no narrower than a table of turns that is there."""
    existing = t.read("conversations").select("text", F.col("role").alias("lang"), F.lit(None).cast("string").alias("source"))
    documents = t.read("documents")
    types = jdbc.size_varchar(documents, ["text", "lang", "source"], existing)
    return documents.sparkSession.range(1).select(F.lit(types).alias("types"))


@_query
def row_index(t: Tables) -> DataFrame:
    """Merged orders with their place in the key order, as an export numbers them."""
    merged = merge.upsert(*t.order_batches(), _BY_ORDER)
    return ordered.row_index(merged, ["o_orderkey"]).select("index", "o_orderkey")


# -- texts ------------------------------------------------------------------------------------------


@_query
def token_frequency(t: Tables) -> DataFrame:
    return texts.token_frequency(t.read("documents"))


@_query
def token_frequency_chats(t: Tables) -> DataFrame:
    return texts.token_frequency(t.read("conversations"))


@_query
def word_forms(t: Tables) -> DataFrame:
    return texts.word_forms(t.gratitude())


@_query
def word_stems(t: Tables) -> DataFrame:
    """The vocabulary with stems out of a table, which knows the tokens that end in s."""
    words = texts.word_counts(t.gratitude())
    table = words.where(F.col("token").endswith("s")).select("token", F.regexp_replace("token", "s$", "").alias("stem"))
    return texts.forms_from_table(words, table, "stem")


@_query
def thank_you_posts(t: Tables) -> DataFrame:
    thanks = texts.thank_you_posts(t.gratitude())
    return thanks.select("doc_id", F.concat_ws(" ", F.coalesce("lemmas", F.array())).alias("lemmas"))
