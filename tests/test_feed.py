"""The deltas of all batches against merging one batch after the other."""

import random

import pytest

from parley.operators import merge
from parley.operators.feed import change_feed, feed_counts
from parley.operators.merge import SPECS, EntitySpec

SPEC = EntitySpec("t", ("a", "b"), ("a", "b", "value", "first"), keep_first=("first",))
SCHEMA = "batch_id long, a string, b string, value string, first string"


def _fold(spark, rows, spec):
    """The deltas of each batch by the merge operators."""
    master = spark.createDataFrame([], SCHEMA).drop("batch_id")
    found = []
    for batch in sorted({r[0] for r in rows}):
        incoming = spark.createDataFrame([r for r in rows if r[0] == batch], SCHEMA).drop("batch_id")
        for change, delta in (("insert", merge.insert_delta), ("update", merge.update_delta)):
            found += [(batch, change, *r) for r in delta(master, incoming, spec).collect()]
        master = merge.upsert(master, incoming, spec)
        master = spark.createDataFrame(master.collect(), master.schema)
    return found


def _key(row):
    return [(v is None, str(v)) for v in row]


@pytest.mark.parametrize("seed", range(4))
def test_feed_equals_the_fold(spark, rows, seed):
    dice = random.Random(seed)
    some = ["x", "y", None]
    made = [
        (dice.choice([1, 2, 5, 9]), dice.choice(some), dice.choice(some), dice.choice("vw"), dice.choice(["p", "q", None]))
        for _ in range(dice.choice([5, 40]))
    ]
    feed = change_feed(spark.createDataFrame(made, SCHEMA), SPEC)
    assert feed.columns == ["batch_id", "change", "a", "b", "value", "first"]
    want = sorted(_fold(spark, made, SPEC), key=_key)
    assert sorted(map(tuple, feed.collect()), key=_key) == want
    counted = {(b, c): sum(r[:2] == (b, c) for r in want) for b in {r[0] for r in want} for c in ("insert", "update")}
    assert rows(feed_counts(feed)) == sorted((b, counted[b, "insert"], counted[b, "update"]) for b in {r[0] for r in want})


def test_some_batches_equal_their_part_of_the_feed(spark):
    made = [(b, k, None, f"{b}{k}", str(b)) for b in (1, 2, 3) for k in "xyz"[:b]]
    batches = spark.createDataFrame([*made, (None, "x", "x", "", "")], SCHEMA)
    whole = sorted(map(tuple, change_feed(batches, SPEC).collect()), key=_key)
    assert len(whole) == 6
    for of in ([1], [2], [3], [1, 3], [7]):
        part = sorted(map(tuple, change_feed(batches, SPEC, of=of).collect()), key=_key)
        assert part == [r for r in whole if r[0] in of]


def test_empty(spark):
    assert change_feed(spark.createDataFrame([], SCHEMA), SPEC).count() == 0


def test_whole_rows_are_shuffled_once(spark, tmp_path):
    """With twenty batches as with one; what else is shuffled are keys."""
    spec = SPECS["message_data"]
    from parley.schemas import ENTITIES

    schema = ENTITIES["message_data"]
    path = str(tmp_path / "rows")
    spark.createDataFrame([], schema).selectExpr("*", "1L AS batch_id").write.parquet(path)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        plan = change_feed(spark.read.parquet(path), spec)._jdf.queryExecution().executedPlan()
        found, nodes = [], [plan.initialPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan]
        while nodes:
            node = nodes.pop()
            if node.nodeName() == "Exchange":
                found.append(node.output().mkString(","))
            nodes += [node.children().apply(i) for i in range(node.children().size())]
    finally:
        spark.conf.set(limit, before)
    assert sum("text#" in output for output in found) == 1, found
    assert len(found) == 3


def test_a_key_with_most_rows_is_spread(spark):
    made = spark.range(20_000).selectExpr(
        "cast(id % 3 AS bigint) AS batch_id", "if(id % 10 < 7, 'hot', cast(id AS string)) AS a", "'b' AS b", "cast(id AS string) AS value", "'f' AS first"
    )
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        feed = change_feed(made, SPEC)
        sizes = [r["n"] for r in feed.selectExpr("spark_partition_id() AS p").groupBy("p").agg({"*": "count"}).toDF("p", "n").collect()]
    finally:
        spark.conf.set(limit, before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 14_000
