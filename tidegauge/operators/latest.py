"""The latest value of each key, to look up and to show."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import round_half_up


def latest_per_key(results: DataFrame, time: str = "end_ts") -> DataFrame:
    """The temperature of each key's newest window result."""
    return results.groupBy("id").agg(F.max_by("temperature", time).alias("temperature"))


def lookup(latest: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The rows of the ids asked for; ids without a value are absent."""
    return latest.filter(F.col("id").isin(list(ids)))


def dashboard(
    latest: DataFrame,
    ids: Sequence[str],
    rounding: Callable[[Column], Column] = round_half_up,
) -> DataFrame:
    """One row with a column per id, rounded for display."""
    shown = lookup(latest, ids).withColumn("temperature", rounding(F.col("temperature")))
    cells = [F.max(F.when(F.col("id") == i, F.col("temperature"))).alias(i) for i in ids]
    return shown.agg(*cells)
