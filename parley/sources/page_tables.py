"""Entity tables out of decoded pages ``(file_name, json)``: parse by schema, then unnest.

Everything stays inside one page row until it is exploded, so none of these operators moves
a page to another task; only the reply routing joins by message key. Pages of several batches
carry ``batch_id``, which their rows keep, and which is part of every key then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley import schemas
from parley.functions.times import invite_epoch, parse_iso, wall_clock
from parley.operators.filters import has_replies
from parley.operators.ordered import row_index
from parley.sources.pages import (
    decode_literal,
    page_channel,
    page_clock,
    page_parent,
    read_pages,
)

# Block ids of a poll are poll-<id> plus a suffix of 15 characters.
POLL_PREFIX = "poll-"
POLL_MENU = "menu"
POLL_SUFFIX_LENGTH = 15
_WHITESPACE = " \t\n\r\x0b\x0c"


def _batch(pages: DataFrame) -> list[str]:
    return [c for c in ("batch_id",) if c in pages.columns]


def _parsed(pages: DataFrame, schema: str) -> DataFrame:
    """Pages with the struct ``page``; pages which have one already are taken as they are."""
    if "page" in pages.columns:
        return pages
    return pages.withColumn("page", F.from_json("json", schema))


def typed_pages(pages: DataFrame) -> DataFrame:
    """History or reply pages (file_name, page) with all fields that any table reads. Once they
    are stored, each table reads only its own fields of them."""
    return _parsed(pages, schemas.MESSAGES_PAGE).select("file_name", "page", *_batch(pages))


def users_from_pages(
    pages: DataFrame, batch: Column | str, place: bool = False
) -> DataFrame:
    """Workspace members. ``batch`` is the batch id; the table holds the day before it."""
    batch = F.lit(batch) if isinstance(batch, str) else batch
    rows = _parsed(pages, schemas.MEMBERS_PAGE).select(
        page_clock().alias("page_clock"),
        invite_epoch(batch).alias("batch"),
        *_batch(pages),
        F.posexplode("page.members").alias("position", "m"),
    )
    columns = [
        "m.id", "m.name", "m.real_name", "m.tz",
        F.coalesce("m.profile.email", F.lit("")).alias("email"), "batch",
    ]
    return rows.select(*columns, *_batch(pages), *(["page_clock", "position"] if place else []))


def channels_from_pages(pages: DataFrame, place: bool = False) -> DataFrame:
    rows = _parsed(pages, schemas.CHANNELS_PAGE).select(
        page_clock().alias("page_clock"),
        *_batch(pages),
        F.posexplode("page.channels").alias("position", "c"),
    )
    kind = (
        F.when(F.col("c.is_im"), "im")
        .when(F.col("c.is_mpim"), "mpim")
        .when(F.col("c.is_channel"), "channel")
        .otherwise("")
    )
    columns = [
        F.col("c.id").alias("id"),
        F.coalesce("c.name", F.lit("")).alias("name"),
        kind.alias("type"),
        F.when(F.col("c.is_private"), "confidential").otherwise("public").alias("class"),
        F.coalesce(_flag("c.is_archived"), F.lit("")).alias("is_archived"),
        # A channel without the flag counts as private here although its class is public.
        F.coalesce(_flag("c.is_private"), F.lit("True")).alias("is_private"),
    ]
    return rows.select(*columns, *_batch(pages), *(["page_clock", "position"] if place else []))


def _flag(column: str) -> Column:
    return F.when(F.col(column), "True").when(~F.col(column), "False")


def page_offset_index(placed: DataFrame) -> DataFrame:
    """Running 0-based index over all pages of a list, in page order."""
    return row_index(placed, ["page_clock", "position"]).drop("page_clock", "position")


def page_messages(pages: DataFrame, schema: str = schemas.MESSAGES_PAGE) -> DataFrame:
    """History or reply pages to one row per raw message: keys of the page and struct m.

    Only the fields of ``schema`` are parsed.
    """
    return _parsed(pages, schema).select(
        page_channel().alias("channel"),
        page_parent().alias("parent_ts"),
        *_batch(pages),
        F.explode("page.messages").alias("m"),
    )


def _reply_count() -> Column:
    """The count of replies, which pages give as a number or as text."""
    return F.col("m.reply_count").try_cast("int")


def _post_columns(zone: str) -> dict[str, Column]:
    return {
        "channel": F.col("channel"),
        "type": F.col("m.type"),
        "subtype": F.col("m.subtype"),
        "ts": F.col("m.ts"),
        "thread_ts": F.col("m.thread_ts"),
        "time": wall_clock("m.ts", zone),
        "reply_count": _reply_count(),
        "user_id": F.col("m.user"),
        "text": F.col("m.text"),
    }


def messages_from_pages(history: DataFrame, zone: str = "UTC") -> DataFrame:
    columns = _post_columns(zone)
    rows = page_messages(history, schemas.POSTS_IN_PAGE)
    return rows.select(*[c.alias(n) for n, c in columns.items()], *_batch(history))


def _answered(history: DataFrame) -> DataFrame:
    """(channel, ts) of messages which announce replies: only their reply pages count."""
    return (
        page_messages(history, schemas.REPLIES_IN_PAGE)
        .where(has_replies(_reply_count()))
        .select("channel", F.col("m.ts").alias("parent_ts"), *_batch(history))
        .distinct()
    )


def _visited_replies(history: DataFrame, replies: DataFrame, schema: str, known: DataFrame | None = None) -> DataFrame:
    """The messages of reply pages whose parent announces replies. They are parsed before the
    join, so that only the fields in use are shuffled and no page; a semi join would be moved
    below the parsing. Announcements of the pages ``known`` do not count."""
    answered = _answered(history)
    keys = ["channel", "parent_ts", *_batch(history)]
    if known is not None:
        answered = answered.join(_answered(known), keys, "left_anti")
    return page_messages(replies, schema).join(answered, keys)


def threads_from_pages(
    history: DataFrame, replies: DataFrame, zone: str = "UTC", known: DataFrame | None = None
) -> DataFrame:
    columns = _post_columns(zone)
    del columns["reply_count"]
    rows = _visited_replies(history, replies, schemas.POSTS_IN_PAGE, known)
    return rows.select(*[c.alias(n) for n, c in columns.items()], *_batch(history))


def reactions_of(messages: DataFrame) -> DataFrame:
    """messages x reactions[] x users[], from the rows of ``page_messages``."""
    by_reaction = messages.select(
        "channel",
        F.col("m.ts").alias("ts"),
        F.coalesce("m.thread_ts", F.lit("")).alias("thread_ts"),
        *_batch(messages),
        F.explode("m.reactions").alias("r"),
    )
    return by_reaction.select(
        "channel", "ts", "thread_ts",
        F.explode("r.users").alias("user_id"), F.col("r.name").alias("reaction"), *_batch(messages),
    )


def reactions_from_messages(history: DataFrame, replies: DataFrame) -> DataFrame:
    """A message with replies gives its reactions through its reply pages, any other itself.

    A post shown in both kinds of page is read twice, hence the distinct.
    """
    fields = schemas.REACTIONS_IN_PAGE
    own = page_messages(history, fields).where(~has_replies(_reply_count()))
    return reactions_of(own).unionByName(reactions_of_replies(history, replies)).distinct()


def reactions_of_replies(history: DataFrame, replies: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The reactions to messages of reply pages whose parent announces replies."""
    answered = _visited_replies(history, replies, schemas.REACTIONS_IN_PAGE, known)
    return reactions_of(answered.where(F.size("m.reactions") > 0))


def files_from_pages(pages: DataFrame, zone: str = "UTC") -> DataFrame:
    """One row per file and channel; a file shared nowhere gives none."""
    rows = _parsed(pages, schemas.FILES_PAGE).select(F.explode("page.files").alias("f"), *_batch(pages))
    return rows.select("f", F.explode("f.channels").alias("channel"), *_batch(pages)).select(
        "f.id", "channel", "f.name",
        wall_clock("f.timestamp", zone).alias("time"), F.col("f.user").alias("user_id"), *_batch(pages),
    )


def polls_from_pages(
    history: DataFrame, channel: str | None = None, zone: str = "UTC"
) -> DataFrame:
    """Votes of poll messages. A menu block names the poll; the votes after it in the page,
    also in later messages, belong to it.

    The page is one row, and nothing is shuffled. Its blocks are cut at the menus, each of which
    takes the votes up to the next one, so the work follows the size of the page.
    """
    if channel is not None:
        history = history.where(page_channel() == channel)
    blocks = F.flatten(
        F.transform(
            F.col("page.messages"),
            lambda m: F.transform(
                F.filter(m["blocks"], lambda b: b["block_id"].startswith(POLL_PREFIX)),
                lambda b: F.struct(
                    b["block_id"].alias("block_id"),
                    b["text"]["text"].alias("text"),
                    m["ts"].alias("ts"),
                ),
            ),
        )
    )
    # A message without blocks gives null, which would make the flattened array null.
    with_blocks = F.filter(F.col("page.messages"), lambda m: m["blocks"].isNotNull())
    pages = _parsed(history, schemas.BLOCKS_IN_PAGE).withColumn(
        "page", F.struct(with_blocks.alias("messages"))
    )
    numbered = pages.select(
        *_batch(history),
        F.transform(
            blocks,
            lambda b, i: F.struct(
                i.alias("position"),
                b["block_id"].endswith(POLL_MENU).alias("is_menu"),
                b["block_id"].alias("block_id"),
                b["text"].alias("text"),
                b["ts"].alias("ts"),
            ),
        ).alias("blocks")
    )
    menus = F.transform(
        F.filter("blocks", lambda b: b["is_menu"]),
        lambda b: F.struct(b["position"].alias("position"), b["block_id"].alias("block_id"), b["text"].alias("text")),
    )
    none = F.lit(None).cast("string")
    # Votes before any menu belong to none.
    before = F.array(F.struct(F.lit(-1).alias("position"), none.alias("block_id"), none.alias("text")))
    opened = numbered.select(*_batch(history), "blocks", F.concat(before, menus).alias("menus"))
    taken = F.transform(
        "menus",
        lambda m, k: F.struct(
            m.alias("menu"),
            F.slice(
                F.col("blocks"),
                m["position"] + 2,
                F.coalesce(F.get("menus", k + 1)["position"], F.size("blocks")) - m["position"] - 1,
            ).alias("votes"),
        ),
    )
    polls = opened.select(*_batch(history), F.explode(taken).alias("poll"))
    split = polls.select(*_batch(history), "poll.menu", F.explode("poll.votes").alias("vote"))
    menu = F.col("menu")
    parts = F.split(F.col("vote.text"), "`", -1)
    id_length = F.greatest(F.length(menu["block_id"]) - POLL_SUFFIX_LENGTH, F.lit(0))
    # One part means no vote yet; a count that is no number spoils only its own row.
    count = F.when(F.size(parts) > 1, F.btrim(F.get(parts, F.lit(1)), F.lit(_WHITESPACE)).try_cast("int"))
    return split.select(
        F.substring(menu["block_id"], F.lit(1), id_length).alias("poll_id"),
        F.col("vote.ts").alias("ts"),
        wall_clock("vote.ts", zone).alias("time"),
        menu["text"].alias("text"),
        F.btrim(F.get(parts, F.lit(0)), F.lit(_WHITESPACE)).alias("vote_item"),
        F.when(F.size(parts) > 1, count).otherwise(F.lit(0)).alias("vote_count"),
        *_batch(history),
    )


# -- pages of the second product: lists of flat records -------------------------------------


def _flat(pages: DataFrame, schema: str) -> DataFrame:
    return pages.select(F.explode(F.from_json("json", schema)).alias("r"), *_batch(pages))


def flat_users(pages: DataFrame) -> DataFrame:
    return _flat(pages, schemas.FLAT_USERS).select("r.*", *_batch(pages))


def flat_channels(pages: DataFrame) -> DataFrame:
    return _flat(pages, schemas.FLAT_CHANNELS).select(
        "r.id", "r.name", "r.type", "r.class",
        _flag("r.is_archived").alias("is_archived"), _flag("r.is_private").alias("is_private"),
        *_batch(pages),
    )


def flat_messages(pages: DataFrame) -> DataFrame:
    empty_to_null = lambda name: F.nullif(F.col(f"r.{name}"), F.lit(""))
    return _flat(pages, schemas.FLAT_MESSAGES).select(
        "r.channel", "r.type", "r.subtype", "r.ts",
        empty_to_null("thread_ts").alias("thread_ts"),
        parse_iso("r.time").alias("time"),
        F.col("r.reply_count").try_cast("int").alias("reply_count"),
        F.col("r.user").alias("user_id"), "r.text", *_batch(pages),
    )


def flat_files(pages: DataFrame) -> DataFrame:
    return _flat(pages, schemas.FLAT_FILES).select(
        "r.id", "r.channel", "r.name", parse_iso("r.time").alias("time"),
        F.col("r.user").alias("user_id"), *_batch(pages),
    )


def read_chat_b(spark: SparkSession, home: str, batch: str) -> dict[str, DataFrame]:
    """The tables of a batch of the second product, straight from its raw pages."""
    readers = {
        "user_data": ("users", flat_users),
        "channel_data": ("channels", flat_channels),
        "message_data": ("flat_messages", flat_messages),
        "file_data": ("files", flat_files),
    }
    return {
        name: reader(decode_literal(read_pages(spark, home, batch, kind)))
        for name, (kind, reader) in readers.items()
    }


# -- privacy ----------------------------------------------------------------------------------


def private_channels(pages: DataFrame) -> DataFrame:
    """Ids of direct, group and private channels, from channel list pages."""
    channel = _parsed(pages, schemas.CHANNELS_PAGE).select(F.explode("page.channels").alias("c"), *_batch(pages))
    flags = [F.coalesce(f"c.{f}", F.lit(False)) for f in ("is_mpim", "is_im", "is_private")]
    private = channel.where(flags[0] | flags[1] | flags[2])
    return private.select(F.col("c.id").alias("channel"), *_batch(pages)).distinct()


def redact_private(messages: DataFrame, private: DataFrame) -> DataFrame:
    """Empty the text, and the nested content where present, of posts in private channels.

    ``private`` holds the ids of such channels in ``channel``.
    """
    batch = _batch(messages) if "batch_id" in private.columns else []
    listed = private.select(F.col("channel").alias("_private"), *[F.col(b).alias(f"_{b}") for b in batch]).distinct()
    # By null-safe equality the join shuffles both sides itself instead of taking over the
    # partitions of the distinct, and only such a join lets AQE split a large channel.
    same = F.col("channel").eqNullSafe(F.col("_private"))
    for name in batch:
        same = same & (F.col(name) == F.col(f"_{name}"))
    out = messages.join(listed, same, "left")
    hide = F.col("_private").isNotNull()
    if "text" in messages.columns:
        hidden = F.when(hide & F.col("text").isNotNull(), F.lit("")).otherwise(F.col("text"))
        out = out.withColumn("text", hidden)
    for name in ("blocks", "files", "attachments"):
        if name in messages.columns:
            empty = F.slice(F.col(name), 1, 0)
            out = out.withColumn(name, F.when(hide, empty).otherwise(F.col(name)))
    return out.select(*messages.columns)


def pages_of_others(history: DataFrame, private: DataFrame) -> DataFrame:
    """History pages of channels which are not in ``private``."""
    hidden = private.withColumnRenamed("channel", "_channel")
    keyed = history.withColumn("_channel", page_channel())
    return keyed.join(hidden, ["_channel", *_batch(hidden)], "left_anti").select(*history.columns)


def channel_class_b(overwrites: DataFrame) -> DataFrame:
    """Class of a channel by its permission overwrites, ``roles`` in their given order.

    The first decisive ``@everyone`` role counts; none decisive means protected.
    """
    verdicts = F.transform(
        F.filter("roles", lambda r: r["name"] == "@everyone"),
        lambda r: F.when(
            ((r["allow_value"] == 0) & (r["deny_value"] == 0)) | r["allow_view"], "public"
        ).when(r["deny_view"], "private"),
    )
    first = F.get(F.filter(verdicts, lambda v: v.isNotNull()), F.lit(0))
    cls = F.when(F.coalesce(F.size("roles"), F.lit(0)) <= 0, "public").otherwise(
        F.coalesce(first, F.lit("protected"))
    )
    return overwrites.withColumn("class", cls).withColumn(
        "is_private", F.col("class") == "private"
    )
