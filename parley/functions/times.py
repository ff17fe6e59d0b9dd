"""Time conversions. All of them stay in wall-clock (NTZ) arithmetic, so that the result
depends on the zone named by the caller and not on the zone of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BATCH_FORMAT = "yyyyMMddHHmmss"

# Fixed value: first millisecond of the snowflake clock (2015-01-01 UTC).
SNOWFLAKE_EPOCH_MS = 1420070400000

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_key(ts: Column | str) -> Column:
    """Numeric order of a message id: epoch text with micros, or a snowflake of any length."""
    return _col(ts).try_cast("decimal(38,6)")


def wall_clock(epoch: Column | str, zone: str = "UTC") -> Column:
    """Epoch seconds (text or number) to wall-clock time, the fraction cut off."""
    seconds = F.floor(_col(epoch).try_cast("decimal(18,6)")).cast("bigint")
    utc = F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def epoch_seconds(time: Column | str) -> Column:
    """Wall-clock time, read as UTC, to epoch seconds with micros."""
    passed = _col(time) - F.expr(_EPOCH)
    return passed.cast("interval second").cast("decimal(18,6)")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (later - earlier).cast("interval second").cast("decimal(18,6)").cast("double")


def iso_text(time: Column | str) -> Column:
    """Wall-clock time as ISO text, whole seconds, with the constant fraction .000."""
    seconds = F.substring(_col(time).cast("string"), 1, 19)
    return F.concat(F.translate(seconds, " ", "T"), F.lit(".000"))


def parse_iso(text: Column | str) -> Column:
    return _col(text).try_cast("timestamp_ntz")


def batch_time(batch: Column | str) -> Column:
    """Batch id ``yyyyMMddHHmmss`` to wall-clock time."""
    return F.to_timestamp_ntz(_col(batch), F.lit(BATCH_FORMAT))


def epoch_text(time: Column | str) -> Column:
    """Wall-clock time to whole epoch seconds as text."""
    return F.floor(epoch_seconds(time)).cast("bigint").cast("string")


def invite_epoch(batch: Column | str) -> Column:
    """Midnight before the day of the batch minus one day, as epoch text."""
    day = F.date_sub(batch_time(batch).cast("date"), 1)
    return epoch_text(day.cast("timestamp_ntz"))


def snowflake_time(snowflake: Column | str) -> Column:
    """Creation time of a snowflake id, as wall-clock UTC with milliseconds."""
    millis = F.shiftright(_col(snowflake).cast("bigint"), 22) + F.lit(SNOWFLAKE_EPOCH_MS)
    return F.timestamp_add(
        "MICROSECOND", millis * F.lit(1000), F.expr(_EPOCH)
    )
