"""Early results of a window, each time the watermark passes a tick."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions.timeops import NO_WATERMARK, SECOND, whole_div, window_end
from tidegauge.operators.late import is_closed
from tidegauge.plans.watermarks import DEFAULT_BOUND, raised_by_bounded


def early_window_counts(
    marked: DataFrame,
    bound_ms: int = DEFAULT_BOUND,
    size_ms: int = 30 * SECOND,
    tick_ms: int = SECOND,
) -> DataFrame:
    """Counts so far at each tick, and the final count once the window closes.

    ``marked`` has the bounded watermark ``wm`` in force before each row. A tick
    happens at the row that moves the watermark into a new multiple of
    ``tick_ms``; it evaluates every open window that has rows.

    Ticks are known by their multiple, so a row is first counted at the first
    tick not below ``from_tick``: rows are folded to one count per window and
    tick before anything is joined or ordered, and a window meets no more ticks
    than fit between its first row and its end.
    """
    after = F.greatest(F.col("wm"), raised_by_bounded(bound_ms))
    timed = marked.withColumn("wm_after", after)

    tick_before = whole_div(_known_watermark(), tick_ms)
    tick_after = whole_div(F.col("wm_after"), tick_ms)
    ticks_now = tick_before.isNull() | (tick_after > tick_before)
    ticks = (
        timed.filter(ticks_now)
        .groupBy(tick_after.alias("tick"))
        .agg(F.min("wm_after").alias("eval_time"))
    )

    placed = timed.withColumn("end_ts", window_end(F.col("timestamp"), size_ms))
    accepted = placed.filter(~is_closed(F.col("end_ts")))
    from_tick = F.when(ticks_now, tick_after).otherwise(tick_after + 1)
    arrived = accepted.groupBy("id", "end_ts", from_tick.alias("tick")).agg(
        F.count(F.lit(1)).alias("arrived")
    )

    # Every tick a window can meet, then those that did happen.
    reach = arrived.groupBy("id", "end_ts").agg(
        F.min("tick").alias("low"), F.sum("arrived").alias("cnt")
    )
    last_tick = whole_div(F.col("end_ts") - F.lit(2), tick_ms)
    possible = reach.filter(F.col("low") <= last_tick).select(
        "id", "end_ts", F.explode(F.sequence(F.col("low"), last_tick)).alias("tick")
    )
    met = possible.join(ticks, "tick").filter(F.col("eval_time") < F.col("end_ts") - F.lit(1))

    steps = arrived.select(
        "id", "end_ts", "tick", "arrived", F.lit(None).cast("bigint").alias("eval_time")
    ).unionByName(met.withColumn("arrived", F.lit(0).cast("bigint")))
    so_far = (
        Window.partitionBy("id", "end_ts")
        .orderBy("tick")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    early = (
        steps.withColumn("cnt", F.sum("arrived").over(so_far))
        .filter(F.col("eval_time").isNotNull())
        .select("id", "end_ts", "eval_time", "cnt")
    )

    final = reach.join(_closings(timed, bound_ms, size_ms), "end_ts").select(
        "id", "end_ts", "eval_time", "cnt"
    )
    return early.unionByName(final)


def _closings(timed: DataFrame, bound_ms: int, size_ms: int) -> DataFrame:
    """For each window end, the watermark that first reached it.

    A row closes the ends its watermark passes. Rows before it were no more than
    the bound ahead of the watermark, so an end past the window of such a row has
    nothing in it and is left out, however far the watermark jumps.
    """
    passed = whole_div(_known_watermark() + F.lit(1), size_ms)
    reached = whole_div(F.col("wm_after") + F.lit(1), size_ms)
    filled = whole_div(_known_watermark() + F.lit(bound_ms + 1), size_ms) + 1
    # before the first watermark there is no window with rows to close
    moves = timed.filter(reached > passed)
    closed = F.sequence(passed + 1, F.least(reached, filled))
    multiples = moves.select(
        F.explode(closed).alias("multiple"), F.col("wm_after").alias("eval_time")
    )
    return multiples.select((F.col("multiple") * F.lit(size_ms)).alias("end_ts"), "eval_time")


def _known_watermark() -> Column:
    """The watermark before the row, null if there is none yet."""
    return F.nullif(F.col("wm"), F.lit(NO_WATERMARK))
