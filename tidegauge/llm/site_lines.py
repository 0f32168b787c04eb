"""Line dedup by site-relative frequency.

Within each host, the pages that hold a line are divided by the pages of the
host; a line above the boilerplate ratio is dropped from all pages of that host.
By default copies are pages of their own; with ``distinct`` the pages of a host that
have the same text count as one, above and below the line of the fraction, so that
copies of a page never make its lines boilerplate. DataFrame functions only.

A host can have at most (mean distinct lines of a page) / ratio such lines, which
bounds the array that is joined back to its pages. Counts combine before the
shuffle and are keyed by host and line, so a hot host or line spreads; the join
of the pages has two materialised inputs, which adaptive execution may broadcast
or split where a host is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.columns import quoted
from tidegauge.session import materialize

RATIO = 0.1
MIN_PAGES = 3


def _line(said: Column) -> Column:
    return F.xxhash64(F.trim(said))


def boilerplate(
    pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, distinct: bool = False
) -> DataFrame:
    """Rows (host, boilerplate): the hashes of the lines to drop, from rows (host, text).

    Blank lines are never boilerplate. A line must also be on ``min_pages`` pages,
    as on a host of one page every line is on all pages. ``distinct`` counts equal
    texts of a host once; what is shuffled for that are hashes of lines, not texts.
    """
    filled = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x) != "")
    hashed = F.array_distinct(F.transform(filled, _line)).alias("lines")
    if distinct:
        pages = materialize(pages.select("host", F.xxhash64("text").alias("digest"), hashed).distinct(), "pages")
        lines = pages.select("host", F.explode("lines").alias("line"))
    else:
        lines = pages.select("host", F.explode(hashed).alias("line"))
    counts = lines.groupBy("host", "line").count().filter(F.col("count") >= min_pages)
    totals = materialize(pages.groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("pages")), "hosts")
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("_host")))
        .filter(F.col("count") > F.lit(ratio) * F.col("pages"))
        .groupBy("_host")
        .agg(F.collect_set("line").alias("_boilerplate"))
    )


def without_boilerplate(
    documents: DataFrame,
    host: Column | str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    distinct: bool = False,
) -> DataFrame:
    """All rows and columns, the text without boilerplate lines, plus two counts.

    ``n_lines`` and ``n_dropped`` are added (they replace columns of those names).
    Null texts stay null with 0 lines, an empty text is one blank line; rows of
    null host are one host; repeated rows count as pages of their own, unless
    ``distinct`` counts equal texts of a host once.
    """
    host = F.col(host) if isinstance(host, str) else host
    held = documents.select(
        F.struct(*[quoted(c) for c in documents.columns]).alias("_doc"), host.alias("host"), F.col(text).alias("text")
    )
    drop = materialize(boilerplate(held.select("host", "text"), ratio, min_pages, distinct), "boilerplate")
    lines = F.split("text", "\n", -1)
    kept = F.filter(
        lines, lambda x: (F.trim(x) == "") | ~F.array_contains("_boilerplate", _line(x))
    )
    marked = held.join(drop, F.col("host").eqNullSafe(F.col("_host")), "left").withColumn(
        "_kept", F.when(F.col("_boilerplate").isNotNull(), kept)
    )
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(n_lines).cast("bigint")
    n_kept = F.when(F.col("_kept").isNull(), n_lines).otherwise(F.size("_kept")).cast("bigint")
    columns = [
        F.when(F.col("_kept").isNull(), F.col("text")).otherwise(F.array_join("_kept", "\n")).alias(c)
        if c == text
        else F.col("_doc")[c].alias(c)
        for c in documents.columns
        if c not in ("n_lines", "n_dropped")
    ]
    return marked.select(*columns, n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped"))
