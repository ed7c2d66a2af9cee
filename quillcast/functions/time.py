"""Event time and time buckets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the post timestamp, "Mon Oct 29 14:45:07 +0000 2018". Spark parses no
# weekday names, so the pattern starts behind the first blank.
CREATED_AT = "MMM d H:m:s Z yyyy"
CREATED_AT_OUT = "EEE MMM dd HH:mm:ss Z yyyy"


def created_at_ts(created_at: Column) -> Column:
    """Event time of a post; text that is no date becomes the epoch, never NULL."""
    after_weekday = F.substring(created_at, F.instr(created_at, " ") + 1, F.length(created_at))
    return F.coalesce(
        F.try_to_timestamp(after_weekday, F.lit(CREATED_AT)), F.timestamp_millis(F.lit(0))
    )


def minute_bucket(ts: Column, minutes: int) -> Column:
    """Floor to ``minutes`` within the hour; the last bucket of an hour may be shorter."""
    if not 1 <= minutes <= 60:
        raise ValueError("a bucket lies within one hour")
    second = _epoch_seconds(ts)
    into_hour = F.pmod(second, F.lit(3600))
    return F.timestamp_seconds(second - into_hour % (minutes * 60))


def minute_of_day(ts: Column, minutes: int = 15) -> Column:
    """Time of day as minutes after midnight UTC, floored to ``minutes`` within the hour.

    Taken from the epoch, so neither the session's zone nor its clock changes matter.
    """
    minute = F.pmod(F.floor(_epoch_seconds(ts) / 60), F.lit(1440))
    return (minute - minute % 60 % minutes).cast("int")


def _epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts)


def scale_window(window: str, factor: int) -> str:
    """``scale_window('15 minutes', 4)`` is ``'60 minutes'``."""
    count, unit = window.split(maxsplit=1)
    return f"{int(count) * factor} {unit}"


# Seconds of the units that windows come in.
_UNITS = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600, "day": 86_400, "week": 604_800}


def window_seconds(window: str) -> float:
    """``window_seconds('15 minutes')`` is 900."""
    count, unit = window.split(maxsplit=1)
    return int(count) * _UNITS[unit.strip().lower().removesuffix("s")]
