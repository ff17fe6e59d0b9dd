"""Slices and indexes must not change a result, also if one key holds nearly all rows."""

import random

from pyspark.sql import functions as F

from parley.operators.ordered import order_bounds, row_index, with_previous
from parley.operators.replies import timediff_conversations, timediff_threads, timediff_users
from parley.functions.times import ts_key


def _posts(spark, rows=3000, seed=5):
    dice = random.Random(seed)
    data = []
    for i in range(rows):
        channel = "hot" if dice.random() < 0.9 else f"c{dice.randrange(4)}"
        # Half of the posts fall into one burst.
        second = dice.randrange(100) if dice.random() < 0.5 else dice.randrange(10_000_000)
        ts = f"{1588000000 + second}.{i:06d}"
        user = None if dice.random() < 0.2 else f"u{dice.randrange(3)}"
        thread = None if dice.random() < 0.3 else f"t{dice.randrange(2)}"
        data.append((channel, ts, thread, user, f"text {i}"))
    posts = spark.createDataFrame(data, "channel string, ts string, thread_ts string, user_id string, text string")
    seconds = F.floor(F.col("ts").cast("double")).cast("bigint")
    time = F.timestamp_add("SECOND", seconds, F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return posts.withColumn("time", time), data


def _expected(data, key, keep=lambda r: True):
    last, out = {}, {}
    for row in sorted((r for r in data if keep(r)), key=lambda r: float(r[1])):
        group = key(row)
        second = int(row[1].split(".")[0])
        known = group is not None and group in last
        out[row[1]] = float(second - last[group]) if known else 0.0
        if group is not None:
            last[group] = second
    return out


def _diffs(df):
    return {r["ts"]: r["diff"] for r in df.select("ts", "diff").collect()}


def test_bounds_split_a_burst(spark):
    posts, _ = _posts(spark)
    bounds = order_bounds(posts, ts_key("ts"), rows_per_slice=300)
    assert len(bounds) == 9 and bounds == sorted(bounds)
    assert order_bounds(posts, ts_key("ts"), rows_per_slice=5000) == []


def test_sliced_measures_equal_the_sequential_ones(spark):
    posts, data = _posts(spark)
    for rows_per_slice in (10_000, 300, 20):
        bounds = order_bounds(posts, ts_key("ts"), rows_per_slice)
        assert _diffs(timediff_conversations(posts, bounds)) == _expected(data, lambda r: r[0])
        threaded = lambda r: r[2] is not None
        assert _diffs(timediff_threads(posts, bounds)) == _expected(data, lambda r: (r[0], r[2]), threaded)
        assert _diffs(timediff_users(posts, bounds=bounds)) == _expected(data, lambda r: r[3], threaded)


def test_building_a_measure_runs_no_job(spark):
    posts, _ = _posts(spark, rows=50)
    context = spark.sparkContext
    context.setJobGroup("measures", "plans only")
    timediff_conversations(posts, [])
    timediff_threads(posts, [1588000050.0])
    timediff_users(posts, [1588000050.0])
    assert list(context.statusTracker().getJobIdsForGroup("measures")) == []
    context.setLocalProperty("spark.jobGroup.id", None)


def test_unordered_rows_come_first(spark):
    rows = spark.createDataFrame(
        [("k", None, 1), ("k", 5.0, 2), ("k", 9.0, 3), (None, 1.0, 4), (None, 2.0, 5)],
        "key string, place double, value int",
    )
    for bounds in ([], [7.0], [2.0, 7.0]):
        order = F.col("place").cast("decimal(38,6)")
        got = with_previous(rows, ["key"], order, "value", "previous", bounds=bounds)
        pairs = {r["value"]: r["previous"] for r in got.collect()}
        assert pairs == {1: None, 2: 1, 3: 2, 4: None, 5: None}


def test_sliced_window_has_no_group_by_key_alone(spark):
    posts, _ = _posts(spark)
    plan = timediff_conversations(posts, [1588000050.0, 1588005000.0])._jdf.queryExecution().toString()
    windows = [line for line in plan.splitlines() if "Window [lag(time" in line]
    assert windows and all("_slice" in line for line in windows)


def test_row_index_shuffles_no_row_after_the_sort(spark, tmp_path):
    rows = spark.range(0, 5000, numPartitions=7).select((F.lit(4999) - F.col("id")).alias("v"))
    plan = row_index(rows, ["v"], folder=str(tmp_path / "sorted"))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan or "Join" in plan
    assert "hashpartitioning(_part" not in plan.split("BroadcastExchange")[0]


def test_row_index_is_the_global_order(spark):
    rows = spark.range(0, 5000, numPartitions=7).select((F.lit(4999) - F.col("id")).alias("v"))
    indexed = row_index(rows, ["v"])
    assert indexed.where("index <> v").count() == 0 and indexed.count() == 5000
