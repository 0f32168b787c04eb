"""Readings steered by a second, control stream.

Both streams are put in one arrival order, and the control state each reading
meets is a running value over it. So neither side has to be small, and a busy
key is cut into slices like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import FIRE_TEXT, reading_text, exceeds
from tidegauge.plans.running import DEFAULT, Tuning, add_running, last_known, running_max


def fire_alerts(
    readings: DataFrame,
    smoke_levels: DataFrame,
    above: float = 100,
    tuning: Tuning = DEFAULT,
) -> DataFrame:
    """An alert for each hot reading that arrives while the smoke level is HIGH.

    The level is shared by all keys and LOW until the first control row. Only
    readings hot enough to matter are put in order.
    """
    hot = readings.filter(exceeds(F.col("temperature"), above)).select(
        "seq", "id", "timestamp", "temperature", F.lit(None).cast("string").alias("level")
    )
    levels = smoke_levels.select(
        "seq",
        F.lit(None).cast("string").alias("id"),
        "timestamp",
        F.lit(None).cast("double").alias("temperature"),
        "level",
    )
    steered = add_running(
        hot.unionByName(levels), [], "seq", {"level": last_known(F.col("level"))}, tuning=tuning
    )
    alerting = steered.filter(F.col("temperature").isNotNull() & (F.col("level") == "HIGH"))
    text = reading_text(F.col("id"), F.col("timestamp"), F.col("temperature"))
    return alerting.select(F.concat(F.lit(FIRE_TEXT), text).alias("message"), "timestamp")


def forward_switched(
    readings: DataFrame, switches: DataFrame, tuning: Tuning = DEFAULT
) -> DataFrame:
    """Readings that arrive while their key is switched on.

    A switch turns its key on for ``duration_ms`` from its own time; a later end
    extends the time, an earlier one changes nothing. So the key is on up to the
    highest end seen so far. ``timestamp`` is the clock, and rises with ``seq``.
    Of a switch and a reading with one number, the switch comes first.
    """
    columns = ["seq", "id", "timestamp", "temperature"]
    both = readings.select(
        *columns, F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("until")
    ).unionByName(
        switches.select(
            "seq",
            "id",
            "timestamp",
            F.lit(None).cast("double").alias("temperature"),
            F.lit(0).alias("kind"),
            (F.col("timestamp") + F.col("duration_ms")).alias("until"),
        )
    )
    steered = add_running(
        both,
        ["id"],
        ["seq", "kind"],
        {"until": running_max(F.col("until"))},
        base=readings.select("id", "seq").unionByName(switches.select("id", "seq")),
        tuning=tuning,
    )
    return steered.filter(
        (F.col("kind") == 1) & (F.col("timestamp") < F.col("until"))
    ).select(*columns)
