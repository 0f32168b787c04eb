"""Aggregates over tumbling windows.

The same calls take recorded and live input. Live input is grouped by Spark's
own ``window``, so that the watermark evicts closed windows; recorded input is
grouped by the window's end as one whole number, which shuffles less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timeops import SECOND, Assigner, tumbling
from tidegauge.operators.transforms import celsius, words


def window_aggregate(
    df: DataFrame,
    size_ms: int,
    aggregates: dict[str, Column],
    key: str = "id",
    time: str = "timestamp",
    event_time: str = "event_time",
) -> DataFrame:
    """``key, end_ts`` and the aggregates per tumbling window of ``size_ms``."""
    if df.isStreaming:
        span = F.window(event_time, f"{size_ms} milliseconds")
        grouped = df.groupBy(key, span).agg(*[a.alias(n) for n, a in aggregates.items()])
        return grouped.select(key, F.unix_millis("window.end").alias("end_ts"), *aggregates)
    return assigned_aggregate(df, tumbling(size_ms), aggregates, key, time)


def assigned_aggregate(
    df: DataFrame,
    assign: Assigner,
    aggregates: dict[str, Column],
    key: str = "id",
    time: str = "timestamp",
) -> DataFrame:
    """The same for windows of any assigner, a function of the time column."""
    _, end = assign(F.col(time))
    grouped = df.groupBy(key, end.alias("end_ts"))
    return grouped.agg(*[a.alias(n) for n, a in aggregates.items()])


def window_min(readings: DataFrame, size_ms: int = 15 * SECOND) -> DataFrame:
    return window_aggregate(readings, size_ms, {"temperature": F.min("temperature")})


def window_max(readings: DataFrame, size_ms: int = 10 * SECOND) -> DataFrame:
    return window_aggregate(readings, size_ms, {"temperature": F.max("temperature")})


def window_avg(readings: DataFrame, size_ms: int = 15 * SECOND) -> DataFrame:
    return window_aggregate(readings, size_ms, {"temperature": F.avg("temperature")})


def window_minmax(readings: DataFrame, size_ms: int = 5 * SECOND) -> DataFrame:
    return window_aggregate(
        readings, size_ms, {"min": F.min("temperature"), "max": F.max("temperature")}
    )


def window_count(readings: DataFrame, size_ms: int = 10 * SECOND) -> DataFrame:
    return window_aggregate(readings, size_ms, {"cnt": F.count(F.lit(1))})


def avg_celsius(readings: DataFrame, size_ms: int = SECOND) -> DataFrame:
    """Mean Celsius temperature; the output's timestamp is the window's end."""
    means = window_avg(celsius(readings), size_ms)
    return means.select("id", F.col("end_ts").alias("timestamp"), "temperature")


def word_counts(
    lines: DataFrame, separator: tuple[str, str], size_ms: int = 5 * SECOND, time: str = "arrival"
) -> DataFrame:
    """Words per window of arrival time.

    Recorded lines carry arrival as epoch milliseconds; live lines carry a
    timestamp stamped at ingest.
    """
    return window_aggregate(
        words(lines, separator),
        size_ms,
        {"count": F.sum("count")},
        key="word",
        time=time,
        event_time=time,
    )
