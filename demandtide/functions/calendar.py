"""Time buckets and calendar features on wall-clock timestamps.

Buckets are integers counted from 1970-01-01 00:00 wall-clock time. They do not
depend on the session time zone, they group and sort faster than timestamps, and
the distance of two buckets is a subtraction.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = ("minute", "hour", "day")


def parse_timestamp(col: Column) -> Column:
    """Any timestamp-like column as TIMESTAMP_NTZ; what cannot be read becomes NULL."""
    return col.try_cast("timestamp_ntz")


def bucket_number(ts: Column, bucket: str = "hour") -> Column:
    """Number of whole buckets between 1970-01-01 00:00 and ``ts``."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    if bucket == "day":
        return days
    if bucket == "hour":
        return days * 24 + F.hour(ts)
    if bucket == "minute":
        return days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    raise ValueError(f"bucket must be one of {BUCKETS}, not {bucket!r}")


def bucket_start(number: Column, bucket: str = "hour") -> Column:
    """Inverse of ``bucket_number``: the TIMESTAMP_NTZ at which a bucket opens."""
    n = number.cast("int")
    step = {
        "day": lambda: F.make_dt_interval(days=n),
        "hour": lambda: F.make_dt_interval(hours=n),
        "minute": lambda: F.make_dt_interval(mins=n),
    }[bucket]()
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + step


def floor_to_bucket(ts: Column, bucket: str = "hour") -> Column:
    return bucket_start(bucket_number(ts, bucket), bucket)


def monday_first(ts: Column) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(ts)


def _wave(fn, phase: Column, period: int) -> Column:
    return fn(F.lit(2 * math.pi) * phase / F.lit(float(period)))


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The nine calendar features, in the order of the feature table."""
    hour, dow = F.hour(ts), monday_first(ts)
    return {
        "hour": hour,
        "day_of_week": dow,
        "day_of_month": F.day(ts),
        "month": F.month(ts),
        "is_weekend": (dow >= 5).cast("int"),
        "hour_sin": _wave(F.sin, hour, 24),
        "hour_cos": _wave(F.cos, hour, 24),
        "day_sin": _wave(F.sin, dow, 7),
        "day_cos": _wave(F.cos, dow, 7),
    }


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")
