"""Event time, processing time and durations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(duration: str) -> int:
    """Whole seconds of a duration such as ``"10 seconds"``, ``"1 HOUR"`` or ``"1 hour 30 minutes"``."""
    parts = duration.lower().split()
    amounts, units = parts[::2], [unit.removesuffix("s") for unit in parts[1::2]]
    if not parts or len(parts) % 2 or not all(a.isdecimal() for a in amounts) or not set(units) <= set(_UNIT_SECONDS):
        raise ValueError(f"not a duration in whole {', '.join(u + 's' for u in _UNIT_SECONDS)}: {duration!r}")
    return sum(int(amount) * _UNIT_SECONDS[unit] for amount, unit in zip(amounts, units))


def interval(duration: str) -> Column:
    """A duration as an interval literal."""
    return F.expr(f"INTERVAL '{duration_seconds(duration)}' SECOND")


def event_timestamp(event_time: Column) -> Column:
    """Epoch seconds with a fraction -> timestamp of the whole second, cut toward zero."""
    return F.timestamp_seconds(event_time.cast("bigint"))


def processing_time() -> Column:
    """Processing time; one value for all rows of a micro-batch."""
    return F.current_timestamp()


def with_event_time(df: DataFrame, delay: str) -> DataFrame:
    """Add ``event_ts`` and watermark it. The watermark does nothing on batch input."""
    return df.withColumn("event_ts", event_timestamp(F.col("event_time"))).withWatermark("event_ts", delay)
