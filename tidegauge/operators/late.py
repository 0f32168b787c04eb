"""What to do with rows that arrive behind the watermark (column ``wm``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.timeops import SECOND, window_end

# Most results of one window that are generated as one array.
UPDATES_PER_BLOCK = 65_536


def is_late() -> Column:
    return F.col("timestamp") < F.col("wm")


def is_closed(end: Column, lateness_ms: int = 0) -> Column:
    """Whether the window had been given up when the row arrived."""
    return F.col("wm") >= end - F.lit(1) + F.lit(lateness_ms)


def split_late(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows on time, and rows behind the watermark."""
    plain = [c for c in marked.columns if c != "wm"]
    return marked.filter(~is_late()).select(plain), marked.filter(is_late()).select(plain)


def window_count_with_late(
    marked: DataFrame, size_ms: int = 10 * SECOND
) -> tuple[DataFrame, DataFrame]:
    """Counts per window, and the rows that came after their window had closed."""
    placed = marked.withColumn("end_ts", window_end(F.col("timestamp"), size_ms))
    closed = is_closed(F.col("end_ts"))
    counts = placed.filter(~closed).groupBy("id", "end_ts")
    late = placed.filter(closed).select("seq", "id", "timestamp", "temperature")
    return counts.agg(F.count(F.lit(1)).alias("cnt")), late


def updated_window_counts(
    marked: DataFrame, size_ms: int = 10 * SECOND, lateness_ms: int = 5 * SECOND
) -> DataFrame:
    """A ``first`` count per window, and an ``update`` for each late row it accepts.

    Rows later than ``lateness_ms`` after the window's end are dropped. As each
    accepted late row raises the count by one, two counts per window tell all
    results; no window's rows are brought together.
    """
    placed = marked.withColumn("end_ts", window_end(F.col("timestamp"), size_ms))
    accepted = placed.filter(~is_closed(F.col("end_ts"), lateness_ms))
    late = is_closed(F.col("end_ts"))
    counts = accepted.groupBy("id", "end_ts").agg(
        F.count_if(~late).alias("punctual"), F.count_if(late).alias("late")
    )

    # Without a punctual row, the first late one makes the first result.
    results = counts.select(
        "id",
        "end_ts",
        F.greatest(F.col("punctual"), F.lit(1).cast("bigint")).alias("first"),
        (F.col("punctual") + F.col("late")).alias("last"),
    )
    return numbered_results(results.withColumn("opening", F.col("first")))


def numbered_results(results: DataFrame) -> DataFrame:
    """One row (id, end_ts, cnt, tag) per count from ``first`` to ``last`` of a window.

    The count ``opening`` is tagged ``first``, all others ``update``. A window with very
    many updates is dealt out in blocks.
    """
    block = F.lit(UPDATES_PER_BLOCK)
    blocks = results.withColumn("low", F.explode(F.sequence("first", "last", block)))
    high = F.least(F.col("low") + block - F.lit(1), F.col("last"))
    numbered = blocks.repartition("id", "end_ts", "low").withColumn(
        "cnt", F.explode(F.sequence("low", high))
    )
    tag = F.when(F.col("cnt").eqNullSafe(F.col("opening")), "first").otherwise("update")
    return numbered.select("id", "end_ts", "cnt", tag.alias("tag"))
