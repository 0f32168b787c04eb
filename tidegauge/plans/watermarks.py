"""The watermark in force at each row of a recorded stream.

Arrival order is the ``seq`` column. A row's watermark is what earlier rows have
raised it to, so a row never counts for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timeops import MINUTE, NO_WATERMARK, SECOND, whole_div
from tidegauge.plans.running import DEFAULT, SLICE, Tuning, add_running, carried_in, running_max

DEFAULT_BOUND = 5 * SECOND


def with_watermark_column(
    df: DataFrame,
    raises_to: Column,
    step_rows: int | None = None,
    seq: str = "seq",
    tuning: Tuning = DEFAULT,
) -> DataFrame:
    """Add ``wm``: the highest ``raises_to`` among earlier rows (nulls skipped).

    With ``step_rows`` the watermark moves only between steps of that many
    sequence numbers, as it does between micro-batches.
    """
    if step_rows is None:
        scan = running_max(raises_to, with_current=False)
        marked = add_running(df, [], seq, {"wm": scan}, tuning=tuning)
    else:
        stepped = df.withColumn(SLICE, whole_div(F.col(seq), step_rows))
        folded = stepped.groupBy(SLICE).agg(F.max(raises_to).alias("wm"))
        before = carried_in(folded, [], {"wm": running_max(F.col("wm"), False)}, tuning)
        marked = stepped.join(before, SLICE, "left").drop(SLICE)
    return marked.withColumn("wm", F.coalesce("wm", F.lit(NO_WATERMARK).cast("bigint")))


def bounded_watermark(
    df: DataFrame, bound_ms: int = DEFAULT_BOUND, step_rows: int | None = None, **options
) -> DataFrame:
    """Highest timestamp so far, less the bound, less one millisecond."""
    return with_watermark_column(df, raised_by_bounded(bound_ms), step_rows, **options)


def raised_by_bounded(bound_ms: int) -> Column:
    return F.col("timestamp") - F.lit(bound_ms + 1)


def periodic_watermark(
    df: DataFrame, bound_ms: int = MINUTE, step_rows: int | None = None, **options
) -> DataFrame:
    """Highest timestamp so far, less the bound."""
    return with_watermark_column(df, F.col("timestamp") - F.lit(bound_ms), step_rows, **options)


def punctuated_watermark(
    df: DataFrame,
    marker_id: str = "sensor_1",
    bound_ms: int = MINUTE,
    step_rows: int | None = None,
    **options,
) -> DataFrame:
    """Only rows of the marker key raise the watermark."""
    raised = F.when(F.col("id") == marker_id, F.col("timestamp") - F.lit(bound_ms))
    return with_watermark_column(df, raised, step_rows, **options)
