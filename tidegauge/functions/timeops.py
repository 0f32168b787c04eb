"""Time arithmetic on epoch milliseconds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE

# "No watermark yet": below every timestamp, with room to subtract.
NO_WATERMARK = -9223372036854775807

Assigner = Callable[[Column], tuple[Column, Column]]


def floor_to(timestamp: Column, size_ms: int) -> Column:
    return timestamp - F.pmod(timestamp, F.lit(size_ms))


def window_end(timestamp: Column, size_ms: int) -> Column:
    return floor_to(timestamp, size_ms) + F.lit(size_ms)


def whole_div(number: Column, size: int) -> Column:
    """Floor of number / size in whole numbers."""
    return F.call_function("div", number - F.pmod(number, F.lit(size)), F.lit(size))


def tumbling(size_ms: int) -> Assigner:
    """A window assigner: one window ``[t - t % size, + size)`` per record."""
    def assign(timestamp: Column) -> tuple[Column, Column]:
        start = floor_to(timestamp, size_ms)
        return start, start + F.lit(size_ms)

    return assign


def with_event_time(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    return df.withColumn("event_time", F.timestamp_millis(F.col(timestamp)))
