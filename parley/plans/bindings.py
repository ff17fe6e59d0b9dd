"""The chat tables and raw pages, derived from the generic test tables.

Every binding covers the whole of its source table. A third of all posts falls into one
channel, some authors are unknown, purchases are posted to a second channel under the same
message id, and replies seen in a thread may differ from the copy in the channel history.
``parley.plans.oracles`` states the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.functions.times import epoch_seconds
from parley.schemas import POST_COLUMNS

PAGE_POSTS = 20


class Tables:
    """Lazy access to the tables under one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- posts ------------------------------------------------------------------------------

    def base(self) -> DataFrame:
        """One post per event; each run of 20 events is a thread within one channel."""
        block = F.expr(f"event_id div {PAGE_POSTS}")
        thread = Window.partitionBy("block")
        channel = F.when(F.col("block") % 3 == 0, "C0").otherwise(
            F.concat(F.lit("C"), (F.col("block") % 41).cast("string"))
        )
        subtype = (
            F.when(F.col("event_type") == "signup", "channel_join")
            .when(F.col("event_type") == "error", "bot_message")
            .when(F.col("event_type") == "purchase", "thread_broadcast")
        )
        apart = (F.col("event_type") == "view") & (F.col("event_id") % PAGE_POSTS != 0)
        label = F.when(F.col("value") > 20, "|general").otherwise("")
        number = lambda c: c.cast("string")
        markup = F.concat(
            F.lit("hi <@U"), number(F.col("event_id") * 7 % 1500),
            F.lit("> and <@U"), number(F.col("user_id")), F.lit("> in <#"), F.col("channel"),
            label, F.lit("> see <https://x.y/"), number(F.col("event_id")),
            F.lit("|doc> or <https://x.y/"), number(F.col("user_id")), F.lit(">"),
        )
        text = (
            F.when(F.col("event_type") == "view", F.concat(F.lit("note "), F.col("props")))
            .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
            .otherwise(markup)
        )
        author = F.when(F.col("event_id") % 97 != 0, F.concat(F.lit("U"), number(F.col("user_id"))))
        posts = (
            self.read("events")
            .withColumn("block", block)
            .withColumns(
                {
                    "channel": channel,
                    "subtype": subtype,
                    "post_time": F.col("ts"),
                    "seconds": epoch_seconds("ts"),
                    "root_ts": F.min("ts").over(thread),
                    "answers": F.count(F.when(~apart, 1)).over(thread) - 1,
                }
            )
            .withColumns({"ts": number(F.col("seconds")), "root": number(epoch_seconds("root_ts"))})
        )
        return posts.withColumns(
            {
                "type": F.lit("message"),
                "thread_ts": F.when(~apart, F.col("root")),
                "time": _whole_seconds("post_time"),
                "reply_count": F.when(
                    (F.col("event_id") % PAGE_POSTS == 0), F.col("answers").cast("int")
                ),
                "member": F.concat(F.lit("U"), number(F.col("user_id"))),
                "text": text,
                "user_id": author,
            }
        )

    def message(self) -> DataFrame:
        copies = F.when(
            F.col("event_type") == "purchase", F.array(F.col("channel"), F.lit("CX"))
        ).otherwise(F.array("channel"))
        return self.base().withColumn("channel", F.explode(copies)).select(*POST_COLUMNS)

    def thread(self) -> DataFrame:
        edited = F.when(F.col("value") > 100, " (edited)").otherwise("")
        replies = self.base().where(F.col("thread_ts").isNotNull())
        return replies.withColumn("text", F.concat("text", edited)).select(*POST_COLUMNS)

    def reaction(self) -> DataFrame:
        """Each event also is a reaction to the first post of its thread."""
        return self.base().select(
            "channel", F.col("root").alias("ts"), F.col("root").alias("thread_ts"),
            F.col("member").alias("user_id"), F.col("event_type").alias("reaction"),
        )

    # -- members and places -----------------------------------------------------------------

    def user(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        placed = (
            self.read("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )
        area = F.concat_ws("/", "r_name", "n_name")
        tz = (
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
            .when(F.col("c_mktsegment") == "AUTOMOBILE", "UTC")
            .when(F.col("c_mktsegment") == "MACHINERY", F.concat(area, F.lit("/East")))
            .otherwise(area)
        )
        key = F.col("c_custkey").cast("string")
        return placed.select(
            F.concat(F.lit("U"), key).alias("id"), F.col("c_name").alias("name"),
            F.concat("c_mktsegment", F.lit(" "), key).alias("real_name"), tz.alias("tz"),
            F.lit("").alias("email"),
            (F.lit(1704067200) + F.col("c_custkey") * 3600).cast("string").alias("batch"),
        )

    def zone(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ISO"),
            F.concat_ws("/", "r_name", "n_name").alias("TZ"),
        )

    def country(self) -> DataFrame:
        return self.read("nation").select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("ISO2"),
            F.col("n_name").alias("COUNTRY"),
        )

    def channel(self) -> DataFrame:
        kind = (
            F.when(F.col("id") == "CX", "mpim").when(F.col("id").endswith("7"), "im").otherwise("channel")
        )
        return (
            self.message()
            .select(F.col("channel").alias("id"))
            .distinct()
            .select(
                "id",
                F.when(F.col("id") != "C4", F.concat(F.lit("name-"), F.col("id"))).alias("name"),
                kind.alias("type"),
                F.when(F.col("id").endswith("3"), "confidential").otherwise("public").alias("class"),
                F.lit("False").alias("is_archived"),
                F.when(F.col("id").endswith("3"), "True").otherwise("False").alias("is_private"),
            )
        )

    # -- second product ---------------------------------------------------------------------

    def message_b(self) -> DataFrame:
        copies = F.when(
            F.col("event_type") == "purchase", F.array(F.col("channel"), F.lit("CX"))
        ).otherwise(F.array("channel"))
        return (
            self.base()
            .withColumns(
                {
                    "ts": snowflake("seconds", "event_id").cast("string"),
                    "thread_ts": F.lit(None).cast("string"),
                    "subtype": F.coalesce("subtype", F.lit("default")),
                    "text": F.replace("text", F.lit("<@"), F.lit("<@!")),
                }
            )
            .withColumn("channel", F.explode(copies))
            .select(*POST_COLUMNS)
        )

    def reaction_b(self) -> DataFrame:
        first = F.col("block") * PAGE_POSTS
        root = snowflake(epoch_seconds("root_ts"), first).cast("string")
        return self.base().select(
            "channel", root.alias("ts"), F.lit("").alias("thread_ts"),
            F.col("member").alias("user_id"), F.col("event_type").alias("reaction"),
        )

    # -- batches ----------------------------------------------------------------------------

    def order_batches(self) -> tuple[DataFrame, DataFrame]:
        """A master up to mid 1998 and a batch from 1997 on, with other states."""
        rows = self.read("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
        )
        date = F.col("o_orderdate")
        master = rows.where(date < F.lit("1998-07-01").cast("timestamp_ntz"))
        batch = rows.where(date >= F.lit("1997-01-01").cast("timestamp_ntz")).withColumn(
            "o_orderstatus", F.lower("o_orderstatus")
        )
        return (
            master.withColumn("batch", F.lit("b1")).drop("o_orderdate"),
            batch.withColumn("batch", F.lit("b2")).drop("o_orderdate"),
        )

    # -- raw pages ----------------------------------------------------------------------------

    def _literal_pages(self, rows: DataFrame, page: str, name: Column, key: str, item: Column) -> DataFrame:
        """Rows to page files with Python literals. ``page`` groups a fixed number of rows."""
        items = F.transform(F.array_sort(F.collect_list("pair")), lambda p: p["item"])
        grouped = (
            rows.select(F.col(page).alias("page"), name.alias("file_name"), item.alias("pair"))
            .groupBy("page", "file_name")
            .agg(items.alias(key or "items"))
        )
        body = F.struct(F.col(key)) if key else F.col("items")
        text = F.to_json(body, {"ignoreNullFields": "false"})
        for token, literal in (("null", "None"), ("true", "True"), ("false", "False")):
            text = F.regexp_replace(text, f'":{token}([,}}])', f'":{literal}$1')
        # Printed pages have single quotes, unless a string holds one itself.
        plain = ~text.contains("'") & ~text.contains("\\")
        value = F.when(plain, F.translate(text, '"', "'")).otherwise(text)
        return grouped.select("file_name", value.alias("value"))

    def _posts_in_pages(self) -> DataFrame:
        name = F.col("event_type")
        number = F.col("event_id").cast("string")
        block_id = (
            F.when(name == "purchase", F.concat(F.lit("poll-"), number, F.lit("-0123456789menu")))
            .when(name == "click", F.concat(F.lit("poll-"), number, F.lit("-vote")))
            .otherwise(F.concat(F.lit("other-"), number))
        )
        block_text = (
            F.when(name == "purchase", F.concat(F.lit("Poll "), number))
            .when(F.col("value") > 20, F.concat(F.lit("Option "), number, F.lit(" `3` votes")))
            .otherwise(F.concat(F.lit("Option "), number))
        )
        block = F.struct(
            block_id.alias("block_id"), F.struct(block_text.alias("text")).alias("text")
        )
        blocks = F.when(name.isin("purchase", "click", "error"), F.array(block))
        users = F.array(F.col("member"), F.lit("U0"))
        reactions = F.when(
            name != "view", F.array(F.struct(name.alias("name"), users.alias("users")))
        )
        return self.base().withColumns({"blocks": blocks, "reactions": reactions})

    @staticmethod
    def _post_item() -> Column:
        post = F.struct(
            "type", "subtype", "ts", "thread_ts", "reply_count",
            F.col("user_id").alias("user"), "text", "reactions", "blocks",
        )
        return F.struct(F.col("event_id").alias("place"), post.alias("item"))

    @staticmethod
    def _clock() -> Column:
        return F.regexp_replace("root", "[.]", "")

    def history_pages(self) -> DataFrame:
        name = F.concat(F.lit("conversation_history-"), F.col("channel"), F.lit("-"), self._clock(), F.lit(".json"))
        return self._literal_pages(self._posts_in_pages(), "block", name, "messages", self._post_item())

    def reply_pages(self) -> DataFrame:
        name = F.concat(
            F.lit("conversation_replies-"), F.col("channel"), F.lit("_"), F.col("root"),
            F.lit("-"), self._clock(), F.lit(".json"),
        )
        replies = self._posts_in_pages().where(F.col("thread_ts").isNotNull())
        return self._literal_pages(replies, "block", name, "messages", self._post_item())

    def _numbered_name(self, prefix: str, page: str) -> Column:
        clock = F.lpad((F.lit(1704067200000000) + F.col(page)).cast("string"), 16, "0")
        return F.concat(F.lit(prefix + "-all-"), clock, F.lit(".json"))

    def user_pages(self) -> DataFrame:
        rows = (
            self.user()
            .withColumn("place", F.substring("id", 2, 20).cast("bigint"))
            .withColumn("page", F.expr("place div 100"))
        )
        member = F.struct(
            "id", "name", "tz", "real_name",
            F.struct(F.concat("id", F.lit("@x.y")).alias("email")).alias("profile"),
        )
        pair = F.struct("place", member.alias("item"))
        return self._literal_pages(rows, "page", self._numbered_name("user_list", "page"), "members", pair)

    def channel_pages(self) -> DataFrame:
        nation = F.col("s_nationkey")
        rows = self.read("supplier").withColumn("page", F.expr("s_suppkey div 10"))
        channel = F.struct(
            F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("id"),
            F.when(nation != 4, F.col("s_name")).alias("name"),
            (nation < 18).alias("is_channel"),
            (nation >= 12).alias("is_mpim"),
            (nation >= 20).alias("is_im"),
            F.when(nation != 7, nation % 2 == 0).alias("is_private"),
            (F.col("s_acctbal") < 0).alias("is_archived"),
        )
        pair = F.struct(F.col("s_suppkey").alias("place"), channel.alias("item"))
        name = self._numbered_name("conversation_list", "page")
        return self._literal_pages(rows, "page", name, "channels", pair)

    def file_pages(self) -> DataFrame:
        key = F.col("page_id")
        rows = self.read("pages").withColumn("page", F.expr("page_id div 50"))
        channels = (
            F.when(F.col("url").startswith("http:"), F.array().cast("array<string>"))
            .when(F.col("url").contains("#"), F.lit(None).cast("array<string>"))
            .otherwise(F.array(F.lit("C1"), F.concat(F.lit("C"), (key % 41).cast("string"))))
        )
        item = F.struct(
            F.concat(F.lit("F"), key.cast("string")).alias("id"),
            F.col("url").alias("name"),
            (F.lit(1704067200) + key * 61).alias("timestamp"),
            F.concat(F.lit("U"), (key % 150).cast("string")).alias("user"),
            channels.alias("channels"),
        )
        pair = F.struct(key.alias("place"), item.alias("item"))
        return self._literal_pages(rows, "page", self._numbered_name("files_list", "page"), "files", pair)

    def flat_message_pages(self) -> DataFrame:
        """Message pages of the second product: lists of flat records."""
        item = F.struct(
            "channel", "type", F.coalesce("subtype", F.lit("default")).alias("subtype"),
            snowflake("seconds", "event_id").cast("string").alias("ts"),
            F.lit("").alias("thread_ts"),
            F.concat(F.translate(F.substring(F.col("time").cast("string"), 1, 19), " ", "T"), F.lit(".000")).alias("time"),
            F.lit("").alias("reply_count"), F.col("member").alias("user"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        name = F.concat(F.lit("message_list-"), F.col("channel"), F.lit("-"), self._clock(), F.lit(".json"))
        pair = F.struct(F.col("event_id").alias("place"), item.alias("item"))
        return self._literal_pages(self.base(), "block", name, "", pair)

    def flat_user_pages(self) -> DataFrame:
        rows = (
            self.user()
            .withColumn("place", F.substring("id", 2, 20).cast("bigint"))
            .withColumn("page", F.expr("place div 100"))
        )
        item = F.struct(
            "id", "name", "real_name", F.lit("").alias("tz"), "email",
            F.lit("20240201000000").alias("batch"),
        )
        pair = F.struct("place", item.alias("item"))
        return self._literal_pages(rows, "page", self._numbered_name("user_list", "page"), "", pair)

    def flat_channel_pages(self) -> DataFrame:
        rows = self.read("supplier").withColumn("page", F.expr("s_suppkey div 10"))
        secret = F.col("s_nationkey") >= 12
        item = F.struct(
            F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
            F.lit("text").alias("type"),
            F.when(secret, "private").otherwise("public").alias("class"),
            F.lit(False).alias("is_archived"), secret.alias("is_private"),
        )
        pair = F.struct(F.col("s_suppkey").alias("place"), item.alias("item"))
        name = self._numbered_name("conversation_list", "page")
        return self._literal_pages(rows, "page", name, "", pair)

    def flat_file_pages(self) -> DataFrame:
        key = F.col("page_id")
        rows = self.read("pages").withColumn("page", F.expr("page_id div 50"))
        item = F.struct(
            key.alias("id"), (key % 41).alias("channel"), F.col("url").alias("name"),
            F.lit("2024-01-01T00:00:00.000").alias("time"), (key % 150).alias("user"),
        )
        pair = F.struct(key.alias("place"), item.alias("item"))
        return self._literal_pages(rows, "page", self._numbered_name("files_list", "page"), "", pair)

    def overwrites(self) -> DataFrame:
        """Permission overwrites of one channel per customer."""
        nation = F.col("c_nationkey").cast("bigint")
        zero, no = F.lit(0).cast("bigint"), F.lit(False)

        def role(name: str, allow: Column, see: Column, deny: Column, hide: Column) -> Column:
            return F.struct(
                F.lit(name).alias("name"), allow.alias("allow_value"), see.alias("allow_view"),
                deny.alias("deny_value"), hide.alias("deny_view"),
            )

        roles = F.array(
            role("mods", nation, nation > 3, zero, no),
            role("@everyone", nation % 3, nation % 4 == 1, nation % 5, nation % 6 == 2),
            role("@everyone", nation, nation % 7 == 3, nation, nation % 7 == 4),
        )
        empty = F.slice(roles, 1, 0)
        return self.read("customer").select(
            F.col("c_custkey").cast("string").alias("channel_id"),
            F.when(F.col("c_mktsegment") == "BUILDING", empty).otherwise(roles).alias("roles"),
        )

    # -- texts ------------------------------------------------------------------------------

    def gratitude(self) -> DataFrame:
        """Documents as posts; those of one language and of one source end in thanks."""
        ending = (
            F.when(F.col("lang") == "en", " Thanks, I can't thank you enough.")
            .when(F.col("source") == "src3", " thx cannot wait")
            .otherwise("")
        )
        return self.read("documents").select("doc_id", F.concat("text", ending).alias("text"))


def _whole_seconds(column: str) -> Column:
    """Wall-clock time without its fraction, without a detour over the session zone."""
    return F.substring(F.col(column).cast("string"), 1, 19).cast("timestamp_ntz")


def snowflake(seconds: Column | str, number: Column | str) -> Column:
    seconds = F.col(seconds) if isinstance(seconds, str) else seconds
    number = F.col(number) if isinstance(number, str) else number
    millis = F.floor(seconds * 1000).cast("bigint")
    return (millis - F.lit(1420070400000)) * F.lit(4194304) + number % 4096
