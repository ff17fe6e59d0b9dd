"""A key with most of the rows must be split by AQE in every join which can meet one.

Thresholds are lowered so that small data counts as skewed; a split join shows ``skew=true``
in its final plan.
"""

import pytest
from pyspark.sql import functions as F

from parley.operators import counts, graph, merge, posts, tags
from parley.operators.merge import SPECS, EntitySpec
from parley.sources import page_tables

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}
ROWS = 40_000


@pytest.fixture(autouse=True)
def _small_thresholds(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def _hot(column, hot):
    return F.when(F.col("id") % 10 < 6, hot).otherwise(F.concat(F.lit(hot + "-"), column.cast("string")))


@pytest.fixture
def said(spark):
    """Posts of which most belong to one author, one thread and mention one user."""
    n = F.col("id")
    return spark.range(0, ROWS, numPartitions=8).select(
        F.lit("C1").alias("channel"),
        F.lit("message").alias("type"), F.lit(None).cast("string").alias("subtype"),
        F.concat(n.cast("string"), F.lit(".000001")).alias("ts"),
        F.when(n % 10 < 6, "7.000001").otherwise(F.concat((n - n % 10).cast("string"), F.lit(".000001"))).alias("thread_ts"),
        F.timestamp_add("SECOND", n, F.expr("timestamp_ntz'2020-01-01'")).alias("time"),
        _hot(n % 1000, "U").alias("user_id"),
        F.concat(F.lit("<@"), _hot(n % 1000, "U"), F.lit("> "), F.sha2(n.cast("string"), 256)).alias("text"),
    )


@pytest.fixture
def users(spark):
    ids = spark.range(1000).select(F.concat(F.lit("U-"), F.col("id").cast("string")).alias("id"))
    ids = ids.unionByName(spark.range(1).select(F.lit("U").alias("id")))
    return ids.select("id", *[F.lit(c).alias(c) for c in ("name", "real_name", "tz", "email", "batch")])


def _is_split(df):
    # An aggregate over all columns shows its final plan, and nothing is pruned away.
    whole = df.agg(F.max(F.xxhash64(*df.columns)))
    whole.collect()
    return "skew=true" in whole._jdf.queryExecution().executedPlan().toString()


def test_hot_author(said, users, spark):
    zone = spark.createDataFrame([], "ISO string, TZ string")
    country = spark.createDataFrame([], "ISO2 string, COUNTRY string")
    assert _is_split(posts.conversations(said, None, users, zone, country))


def test_hot_mention(said, users):
    assert _is_split(tags.extract_tags(said, users))


def test_hot_thread(said):
    assert _is_split(graph.edges_interacts(said))


def test_hot_message_gets_most_reactions(said):
    given = said.select(
        "channel", F.col("thread_ts").alias("ts"), "thread_ts",
        F.col("ts").alias("user_id"), F.lit("tada").alias("reaction"),
    )
    assert _is_split(graph.edges_reacts(said, given))


def _reactions(said):
    return said.select(
        "channel", F.col("thread_ts").alias("ts"), F.lit("").alias("thread_ts"),
        F.col("ts").alias("user_id"), F.sha2("ts", 256).alias("reaction"),
    )


def test_hot_group_in_a_merge(said):
    master = _reactions(said)
    incoming = master.where("user_id like '%5.000001'")
    assert _is_split(merge.upsert(master, incoming, SPECS["reaction_data"], distinct_master=True))


def test_hot_group_in_a_replay(said):
    batches = _reactions(said).withColumn("batch_id", F.lit(1))
    assert _is_split(merge.replay(batches, SPECS["reaction_data"]))


def test_hot_key_in_deltas(said):
    spec = EntitySpec("r", ("ts",), ("channel", "ts", "thread_ts", "user_id", "reaction"))
    master = _reactions(said)
    assert _is_split(merge.insert_delta(master, master, spec))
    assert _is_split(merge.update_delta(master, master, spec))


def test_channel_with_most_users(said, users, spark):
    channels = spark.createDataFrame([("C1", "c")], "id string, name string")
    many = said.withColumn("user_id", F.col("ts"))
    assert _is_split(counts.top_users_per_channel(many, users, channels))


def test_private_channel_with_most_posts(said):
    rows = said.withColumn("channel", F.col("user_id"))
    private = said.select(F.col("user_id").alias("channel"))
    assert _is_split(page_tables.redact_private(rows, private))


def test_channel_with_most_members(said):
    rows = said.withColumns({"user_id": F.col("ts"), "subtype": F.lit("default")})
    rows = rows.withColumn("channel", F.concat(F.lit("C"), F.col("thread_ts")))
    assert _is_split(graph.edges_interacts_b(rows))


def test_post_with_most_copies(said):
    copies = said.withColumn("ts", F.col("thread_ts"))
    assert _is_split(posts.posts(copies, copies, prefer_thread=True))
