"""Running values over ordered rows, per key, that no single key can stall.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task. Here
the rows of a *hot* key are cut into slices of consecutive rows. Each slice is
scanned on its own; one summary row per slice is scanned in turn (again in
slices), and the value carried into a slice is joined back to its rows. Keys
that are not hot stay whole, so that balanced data pays for finding the hot keys
(one aggregate over the key column) and for nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegauge.functions.timeops import whole_div

SLICE = "_slice"
_WIDTH = "_width"
_SPAN = "_span"


@dataclass(frozen=True)
class Tuning:
    """Sizes of the pieces a running computation is cut into.

    ``max_hot_keys`` bounds the hot-key table, which is broadcast: a key is hot
    only with more than 1/max_hot_keys of all rows, so there cannot be more.
    """

    rows_per_slice: int = 4096
    min_hot_rows: int = 4096
    max_hot_keys: int = 100_000


DEFAULT = Tuning()


@dataclass(frozen=True)
class Scan:
    """A running value: how rows fold into one, and how two folds join.

    ``fold(value, order)`` aggregates; ``over(value, frame)`` does the same for
    a window frame; ``join(before, here, here_is_empty)`` puts the value carried
    in from earlier slices and the one of this slice together.
    """

    value: Column
    fold: Callable[[Column, Column], Column]
    over: Callable[[Column, WindowSpec], Column]
    join: Callable[[Column, Column, Column], Column]
    with_current: bool = True


def running_sum(value: Column) -> Scan:
    return Scan(
        value,
        fold=lambda v, _: F.sum(v),
        over=lambda v, w: F.sum(v).over(w),
        join=lambda before, here, _: F.coalesce(before, F.lit(0)) + F.coalesce(here, F.lit(0)),
    )


def running_count() -> Scan:
    return running_sum(F.lit(1).cast("bigint"))


def running_max(value: Column, with_current: bool = True) -> Scan:
    return Scan(
        value,
        fold=lambda v, _: F.max(v),
        over=lambda v, w: F.max(v).over(w),
        join=lambda before, here, _: F.greatest(before, here),
        with_current=with_current,
    )


def previous(value: Column) -> Scan:
    """The value of the row before, null for the first row of a key."""
    return Scan(
        value,
        fold=lambda v, order: F.max_by(v, order),
        over=lambda v, w: F.last(v).over(w),
        join=lambda before, here, empty: F.when(empty, before).otherwise(here),
        with_current=False,
    )


def last_known(value: Column, with_current: bool = True) -> Scan:
    """The latest value that is not null (carried forward)."""
    return Scan(
        value,
        fold=lambda v, order: F.max_by(v, F.when(v.isNotNull(), order)),
        over=lambda v, w: F.last(v, ignorenulls=True).over(w),
        join=lambda before, here, _: F.coalesce(here, before),
        with_current=with_current,
    )


def first_value(value: Column) -> Scan:
    """The earliest value that is not null."""
    return Scan(
        value,
        fold=lambda v, order: F.min_by(v, F.when(v.isNotNull(), order)),
        over=lambda v, w: F.first(v, ignorenulls=True).over(w),
        join=lambda before, here, _: F.coalesce(before, here),
    )


def hot_keys(
    df: DataFrame, keys: Sequence[str], order: str, tuning: Tuning = DEFAULT
) -> DataFrame:
    """Keys too large for one task, with the slice width each needs.

    Fewer than ``tuning.max_hot_keys`` rows by construction.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    known = [F.col(k).isNotNull() for k in keys]
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        (F.max(order) - F.min(order) + F.lit(1)).alias("_spread"),
    )
    for condition in known:
        sizes = sizes.filter(condition)
    limit = F.greatest(F.lit(float(tuning.min_hot_rows)), total / F.lit(tuning.max_hot_keys))
    width = F.ceil(F.col("_spread") * F.lit(float(tuning.rows_per_slice)) / F.col("_n"))
    return sizes.filter(F.col("_n") > limit).select(
        *keys, F.greatest(width, F.lit(1)).cast("bigint").alias(_WIDTH)
    )


def _width(df: DataFrame, order: str, tuning: Tuning) -> Column:
    """Numbers per slice, so that a slice has about ``rows_per_slice`` rows."""
    spread = F.max(order).cast("double") - F.min(order).cast("double") + F.lit(1.0)
    width = F.ceil(spread * F.lit(float(tuning.rows_per_slice)) / F.count(order))
    return df.agg(F.greatest(width, F.lit(1)).cast("bigint").alias("width")).scalar()


def add_running(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    scans: dict[str, Scan],
    base: DataFrame | None = None,
    tuning: Tuning = DEFAULT,
    keep_slices: bool = False,
) -> DataFrame:
    """``df`` with one running column per scan, in ``order`` within ``keys``.

    ``order[0]`` is a whole number; further columns break ties. Without keys few
    rows may share it (as with a sequence number), for slices are runs of that
    number, as wide as its spread over the rows asks for. With keys, ``base`` may name a cheaper relation with the same keys and order
    (such as the bare table scan) to find hot keys in. With ``keep_slices`` the
    result may go into a further call on the same keys, which then needs no new
    shuffle of the rows.
    """
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order)
    if SLICE in df.columns:
        sliced, shared = df, df.filter(F.col(SLICE).isNotNull())
    elif keys:
        hot = F.broadcast(hot_keys(df if base is None else base, keys, order[0], tuning))
        slice_no = F.call_function("div", F.col(order[0]), F.col(_WIDTH))
        sliced = df.join(hot, keys, "left").withColumn(SLICE, slice_no)
        shared = df.join(hot, keys).withColumn(SLICE, slice_no)
    else:
        sliced = df.withColumn(SLICE, F.call_function("div", F.col(order[0]), _width(df, order[0], tuning)))
        shared = sliced

    folded = shared.groupBy(*keys, SLICE).agg(
        *[s.fold(s.value, _order_value(order)).alias(f"_b_{n}") for n, s in scans.items()]
    )
    before = carried_in(folded, keys, {f"_b_{n}": s for n, s in scans.items()}, tuning)

    rows = Window.partitionBy(*keys, SLICE).orderBy(*order)
    to_here = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    to_previous = rows.rowsBetween(Window.unboundedPreceding, -1)
    scanned = sliced.select(
        "*",
        (F.row_number().over(rows) == 1).alias("_first"),
        *[
            s.over(s.value, to_here if s.with_current else to_previous).alias(f"_h_{n}")
            for n, s in scans.items()
        ],
    )
    merged = scanned.join(before, [*keys, SLICE], "left")
    added = {
        n: s.join(
            F.col(f"_b_{n}"),
            F.col(f"_h_{n}"),
            F.lit(False) if s.with_current else F.col("_first"),
        )
        for n, s in scans.items()
    }
    kept = [F.col(c) for c in df.columns if c not in added and c != SLICE]
    if keep_slices:
        kept.append(F.col(SLICE))
    return merged.select(*kept, *[column.alias(n) for n, column in added.items()])


def carried_in(
    folded: DataFrame,
    keys: Sequence[str],
    scans: dict[str, Scan],
    tuning: Tuning = DEFAULT,
) -> DataFrame:
    """For each slice, the fold of all earlier slices of the same key.

    ``folded`` holds one row per (keys, slice) with one column per scan, which
    is replaced by the carried value. Slices are scanned in spans, and spans in
    turn, so that even one key's slices are spread over tasks.
    """
    keys = list(keys)
    spans = folded.withColumn(_SPAN, whole_div(F.col(SLICE), tuning.rows_per_slice))
    totals = spans.groupBy(*keys, _SPAN).agg(
        *[s.fold(F.col(n), F.col(SLICE)).alias(f"{n}_total") for n, s in scans.items()]
    )
    over_spans = (
        Window.partitionBy(*keys).orderBy(_SPAN).rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier = totals.select(
        *keys,
        _SPAN,
        *[s.over(F.col(f"{n}_total"), over_spans).alias(f"{n}_earlier") for n, s in scans.items()],
    )
    in_span = Window.partitionBy(*keys, _SPAN).orderBy(SLICE)
    up_to = in_span.rowsBetween(Window.unboundedPreceding, -1)
    within = spans.select(
        *keys,
        _SPAN,
        SLICE,
        (F.row_number().over(in_span) == 1).alias("_leads"),
        *[s.over(F.col(n), up_to).alias(f"{n}_within") for n, s in scans.items()],
    )
    return within.join(earlier, [*keys, _SPAN], "left").select(
        *keys,
        SLICE,
        *[
            s.join(F.col(f"{n}_earlier"), F.col(f"{n}_within"), F.col("_leads")).alias(n)
            for n, s in scans.items()
        ],
    )


def _order_value(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])
