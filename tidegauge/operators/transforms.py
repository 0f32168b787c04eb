"""Filters, projections and per-row transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import (
    FREEZING_TEXT,
    LATE_TEXT,
    ONE_SPACE,
    exceeds,
    split_words,
    to_celsius,
)


def filter_by_threshold(
    readings: DataFrame, threshold: float = 25, inclusive: bool = False
) -> DataFrame:
    return readings.filter(exceeds(F.col("temperature"), threshold, inclusive))


def project_id(readings: DataFrame) -> DataFrame:
    return readings.select("id")


def split_id(ids: DataFrame) -> DataFrame:
    """One row per part of the id."""
    return ids.select(F.explode(F.split("id", "_")).alias("part"))


def filter_project_split(
    readings: DataFrame, threshold: float = 25, inclusive: bool = False
) -> DataFrame:
    """Filter, project and split in one plan."""
    return split_id(project_id(filter_by_threshold(readings, threshold, inclusive)))


def celsius(readings: DataFrame) -> DataFrame:
    return readings.withColumn("temperature", to_celsius(F.col("temperature")))


def words(lines: DataFrame, separator: tuple[str, str] = ONE_SPACE) -> DataFrame:
    """``(word, 1)`` for each word of column ``value``; other columns are kept."""
    others = [c for c in lines.columns if c != "value"]
    return lines.select(
        *others,
        F.explode(split_words(F.col("value"), separator)).alias("word"),
        F.lit(1).alias("count"),
    )


def upper_names(names: DataFrame) -> DataFrame:
    return names.withColumn("value", F.upper("value"))


def late_messages(late: DataFrame) -> DataFrame:
    return late.select(F.concat(F.lit(LATE_TEXT), F.col("id")).alias("message"))


def monitor_freezing(
    readings: DataFrame, below: float = 32.0
) -> tuple[DataFrame, DataFrame]:
    """All readings unchanged, and an alarm text for each freezing one."""
    alarms = readings.filter(F.col("temperature") < below).select(
        F.concat(F.lit(FREEZING_TEXT), F.col("id")).alias("message")
    )
    return readings, alarms
