"""Values per key that every input row updates and emits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.transforms import upper_names
from tidegauge.plans.running import (
    DEFAULT,
    Tuning,
    add_running,
    first_value,
    running_count,
    running_max,
    running_sum,
)


def rolling_sum(
    triples: DataFrame, order: str | Sequence[str] = "seq", tuning: Tuning = DEFAULT
) -> DataFrame:
    """Running sum of ``f1`` per ``f0``; ``f2`` stays that of the key's first row."""
    scans = {"f1": running_sum(F.col("f1")), "f2": first_value(F.col("f2"))}
    return add_running(triples, ["f0"], order, scans, tuning=tuning).select("f0", "f1", "f2")


def rolling_max_record(readings: DataFrame, tuning: Tuning = DEFAULT) -> DataFrame:
    """The hottest reading of the key so far; of equals, the newest."""
    record = F.struct("temperature", "seq", "timestamp")
    best = add_running(readings, ["id"], "seq", {"best": running_max(record)}, tuning=tuning)
    return best.select(
        "seq",
        "id",
        F.col("best.timestamp").alias("timestamp"),
        F.col("best.temperature").alias("temperature"),
    )


def name_counts(names: DataFrame, tuning: Tuning = DEFAULT) -> DataFrame:
    """The running count of each upper-cased name."""
    counted = add_running(
        upper_names(names), ["value"], "seq", {"count": running_count()}, tuning=tuning
    )
    return counted.select("seq", F.col("value").alias("name"), "count")
