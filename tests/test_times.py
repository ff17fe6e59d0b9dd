from datetime import datetime

from pyspark.sql import functions as F

from parley.functions import times


def _one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_epoch_text_to_wall_clock_cuts_the_fraction(spark):
    wall = times.wall_clock(F.lit("1588327872.999900"))
    assert _one(spark, wall, times.iso_text(wall)) == (
        datetime(2020, 5, 1, 10, 11, 12), "2020-05-01T10:11:12.000",
    )


def test_wall_clock_of_another_zone(spark):
    wall = times.wall_clock(F.lit("1588327872"), "Australia/Sydney")
    assert _one(spark, wall) == (datetime(2020, 5, 1, 20, 11, 12),)


def test_wall_clock_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        wall = times.wall_clock(F.lit("1583651400"))  # a local time New York skips
        assert _one(spark, times.iso_text(wall)) == ("2020-03-08T07:10:00.000",)
        back = times.epoch_seconds(times.parse_iso(F.lit("2020-03-08T02:30:00.000")))
        assert _one(spark, back.cast("bigint")) == (1583634600,)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unreadable_epoch_is_null(spark):
    assert _one(spark, times.wall_clock(F.lit("")), times.wall_clock(F.lit("x"))) == (None, None)


def test_batch_and_invite(spark):
    batch = F.lit("20200501101112")
    assert _one(spark, times.batch_time(batch), times.invite_epoch(batch)) == (
        datetime(2020, 5, 1, 10, 11, 12), str(1588204800),
    )


def test_snowflake(spark):
    created = times.snowflake_time(F.lit("175928847299117063"))
    assert _one(spark, created) == (datetime(2016, 4, 30, 11, 18, 25, 796000),)


def test_message_ids_order_by_number(spark):
    ids = spark.createDataFrame([("9",), ("10",), ("100.5",), ("100.25",)], "ts string")
    ordered = [r.ts for r in ids.orderBy(times.ts_key("ts")).collect()]
    assert ordered == ["9", "10", "100.25", "100.5"]
