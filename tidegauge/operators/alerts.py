"""Alerts that depend on what a key reported before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.scalar import RISE_TEXT, exceeds
from tidegauge.functions.timeops import HOUR, SECOND
from tidegauge.plans.running import (
    DEFAULT,
    Tuning,
    add_running,
    last_known,
    previous,
    running_sum,
)
from tidegauge.session import materialize


def change_alerts(
    readings: DataFrame, threshold: float = 1.7, tuning: Tuning = DEFAULT
) -> DataFrame:
    """``(id, temperature, diff)`` where the reading differs from the key's last.

    The first reading of a key never alerts.
    """
    known = add_running(
        readings.select("seq", "id", "temperature"),
        ["id"],
        "seq",
        {"before": previous(F.col("temperature"))},
        tuning=tuning,
    )
    return _alert(known, F.col("before"), threshold)


def self_cleaning_alerts(
    marked: DataFrame,
    threshold: float = 1.7,
    ttl_ms: int = HOUR,
    tuning: Tuning = DEFAULT,
    base: DataFrame | None = None,
) -> DataFrame:
    """The same, but a key's last reading is forgotten after a while.

    It is gone once the watermark reaches its time plus ``ttl_ms``. ``marked``
    has the watermark ``wm`` before each row; ``base`` may be the readings it
    was made from.
    """
    known = add_running(
        marked.select("seq", "id", "timestamp", "temperature", "wm"),
        ["id"],
        "seq",
        {"before": previous(F.col("temperature")), "seen": previous(F.col("timestamp"))},
        base=base,
        tuning=tuning,
    )
    alive = F.when(F.col("wm") < F.col("seen") + F.lit(ttl_ms), F.col("before"))
    return _alert(known, alive, threshold)


def _alert(known: DataFrame, before, threshold: float) -> DataFrame:
    diff = F.abs(F.col("temperature") - before)
    return known.select("id", "temperature", diff.alias("diff")).filter(
        exceeds(F.col("diff"), threshold)
    )


def rise_warnings(
    readings: DataFrame,
    duration_ms: int = SECOND,
    tuning: Tuning = DEFAULT,
) -> DataFrame:
    """A warning when a key's temperature has not fallen for ``duration_ms``.

    A rise sets a timer unless one is set; a fall cancels it; a timer that comes
    due warns, and the next rise may set another. ``timestamp`` is the clock. The
    last timers are due if the stream's clock has reached them.

    A fall leaves no timer whatever came before, so each climb (the rows between
    two falls) stands alone. A climb shorter than the duration sets one timer, at
    its first rise. In others each timer is set by the first rise not before the
    last one came due, found by repeated doubling of the steps.
    """
    due = F.lit(duration_ms)
    marks = materialize(_climbs(readings, tuning), "climbs")
    clock = readings.agg(F.max("timestamp").alias("clock")).scalar()
    climbs = marks.groupBy("id", "climb").agg(
        F.min("rise").alias("first"),
        F.max("rise").alias("last"),
        F.coalesce(F.max("fall"), clock).alias("ends"),
    )
    climbs = materialize(climbs.filter(F.col("first") + due <= F.col("ends")), "due-climbs")
    single = climbs.filter(F.col("last") < F.col("first") + due).select(
        "id", "ends", F.col("first").alias("set_at")
    )
    several = climbs.filter(F.col("last") >= F.col("first") + due)
    rises = marks.filter(F.col("rise").isNotNull()).select("id", "climb", "rise")
    set_timers = single.unionByName(_timers(rises, several, duration_ms, tuning))

    before, after = RISE_TEXT
    return set_timers.filter(F.col("set_at") + due <= F.col("ends")).select(
        "id",
        (F.col("set_at") + due).alias("timestamp"),
        F.concat(F.lit(before), F.col("id"), F.lit(after)).alias("message"),
    )


def _climbs(readings: DataFrame, tuning: Tuning) -> DataFrame:
    """Rises and falls, each with the number of the climb it belongs to or ends."""
    rows = readings.select("seq", "id", "timestamp", "temperature")
    known = add_running(
        rows,
        ["id"],
        "seq",
        {"before": previous(F.col("temperature"))},
        tuning=tuning,
        keep_slices=True,
    )
    value, before = F.col("temperature"), F.col("before")
    turns = known.filter(value != before).withColumn("fell", (value < before).cast("int"))
    numbered = add_running(
        turns, ["id"], "seq", {"falls": running_sum(F.col("fell"))}, tuning=tuning
    )
    return numbered.select(
        "id",
        (F.col("falls") - F.col("fell")).alias("climb"),
        F.when(F.col("fell") == 0, F.col("timestamp")).alias("rise"),
        F.when(F.col("fell") == 1, F.col("timestamp")).alias("fall"),
    )


def _timers(
    rises: DataFrame, climbs: DataFrame, duration_ms: int, tuning: Tuning
) -> DataFrame:
    """Timers of climbs that may set more than one.

    Each rise gets the rise that sets the next timer after it. Starting from the
    first rise, a round marks one jump ahead of all marked rises and doubles the
    jump, so rounds are few even for very long climbs.
    """
    climb = ["id", "climb"]
    times = materialize(rises.join(climbs.select(*climb), climb).distinct(), "rises")

    # The next rise at or after rise + duration, looked up by walking back in time.
    ahead = times.select(
        *climb, (-F.col("rise")).alias("back"), F.lit(0).alias("asks"), "rise",
        F.col("rise").alias("seen"),
    ).unionByName(
        times.select(
            *climb, (-(F.col("rise") + duration_ms)).alias("back"), F.lit(1).alias("asks"),
            "rise", F.lit(None).cast("bigint").alias("seen"),
        )
    )
    answered = add_running(
        ahead, climb, ["back", "asks"], {"jump": last_known(F.col("seen"))}, tuning=tuning
    ).filter(F.col("asks") == 1)
    steps = answered.join(climbs.select(*climb, "first"), climb).select(
        *climb, "rise", "jump", (F.col("rise") == F.col("first")).alias("sets")
    )
    steps = materialize(steps, "steps")

    while not steps.filter(F.col("sets") & F.col("jump").isNotNull()).isEmpty():
        reached = (
            steps.filter(F.col("sets") & F.col("jump").isNotNull())
            .select(*climb, F.col("jump").alias("rise"), F.lit(True).alias("hit"))
            .distinct()
        )
        farther = steps.select(*climb, F.col("rise").alias("jump"), F.col("jump").alias("farther"))
        doubled = (
            steps.join(reached, [*climb, "rise"], "left")
            .withColumn("sets", F.col("sets") | F.col("hit").isNotNull())
            .join(farther, [*climb, "jump"], "left")
            .select(*climb, "rise", F.col("farther").alias("jump"), "sets")
        )
        steps = materialize(doubled, "steps")
    return (
        steps.filter("sets")
        .join(climbs.select(*climb, "ends"), climb)
        .select("id", "ends", F.col("rise").alias("set_at"))
    )
