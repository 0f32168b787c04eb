"""The live operators, as what they make of a micro-batch (see ``micro``)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegauge.functions.scalar import FIRE_TEXT, exceeds, reading_text
from tidegauge.functions.timeops import HOUR, MINUTE, NO_WATERMARK, SECOND, window_end
from tidegauge.operators.late import numbered_results
from tidegauge.operators.transforms import upper_names
from tidegauge.plans.running import (
    DEFAULT,
    Scan,
    Tuning,
    add_running,
    first_value,
    last_known,
    previous,
    running_max,
    running_sum,
)
from tidegauge.plans.watermarks import raised_by_bounded
from tidegauge.streaming.micro import Batch, Live

READING = "seq bigint, id string, timestamp bigint, temperature double"
_PAST = "_past"


def _same(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [one[k].eqNullSafe(other[k]) for k in keys])


def carried(
    schema: str,
    keys: Sequence[str],
    order: Sequence[str],
    scans: dict[str, Scan],
    past: dict[str, tuple[str, Column]],
    results: Callable[[DataFrame, Batch], DataFrame],
    raises: Column | None = None,
    rows_of: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    tuning: Tuning = DEFAULT,
) -> Live:
    """A live operator from running values over the rows of a key.

    ``past`` gives, by column, type and aggregate of the row that stands for all rows of
    a key so far. It comes before the key's rows of a batch, whose running values then
    are what they would be over the whole stream.
    """
    keys = tuple(keys)

    def step(batch: Batch) -> tuple[DataFrame, DataFrame]:
        rows = rows_of(batch.rows).withColumn(_PAST, F.lit(False))
        before = batch.state
        if keys:
            met = rows.select(*keys).distinct()
            before = before.join(met, _same(before, met, keys), "left_semi")
        before = before.withColumn(order[0], F.lit(batch.low).cast("bigint")).withColumn(_PAST, F.lit(True))
        both = rows.unionByName(before, allowMissingColumns=True)
        known = add_running(both, keys, order, scans, tuning=tuning).filter(~F.col(_PAST))
        changes = both.groupBy(*keys).agg(*[a.alias(n) for n, (_, a) in past.items()])
        return results(known, batch), changes.withColumn("gone", F.lit(False))

    return Live(schema, step, keys, _state_schema(keys, past), raises, order[0])


def _state_schema(keys: Sequence[str], past: dict[str, tuple[str, Column]]) -> str:
    kinds = {"id": "string", "value": "string", "f0": "bigint"}
    return ", ".join([f"{k} {kinds[k]}" for k in keys] + [f"{n} {kind}" for n, (kind, _) in past.items()])


def state_after(live: Live, rows: DataFrame) -> DataFrame:
    """The state a live operator has once recorded rows have gone through it in one batch."""
    spark = rows.sparkSession
    none = spark.createDataFrame([], StructType.fromDDL(live.state_schema))
    low, top = rows.agg(
        F.min(live.order), F.lit(None).cast("bigint") if live.raises is None else F.max(live.raises)
    ).first()
    after = NO_WATERMARK if top is None else top
    _, changes = live.step(Batch(rows, none, (low or 0) - 1, NO_WATERMARK, after))
    return changes.filter(~F.col("gone")).drop("gone")


def _last(column: str, order: str = "seq") -> Column:
    return F.max_by(column, order)


def name_counts(tuning: Tuning = DEFAULT) -> Live:
    """Running count of each upper-cased name."""
    return carried(
        "seq bigint, name string, count bigint",
        ["value"],
        ["seq"],
        {"count": running_sum(F.col("n"))},
        {"n": ("bigint", F.sum("n"))},
        lambda known, _: known.select("seq", F.col("value").alias("name"), "count"),
        rows_of=lambda names: upper_names(names).withColumn("n", F.lit(1).cast("bigint")),
        tuning=tuning,
    )


def rolling_sum(order: Sequence[str] = ("seq",), tuning: Tuning = DEFAULT) -> Live:
    """Running sum of ``f1`` per ``f0``; ``f2`` stays that of the key's first row."""
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    return carried(
        "f0 bigint, f1 bigint, f2 int",
        ["f0"],
        order,
        {"f1": running_sum(F.col("f1")), "f2": first_value(F.col("f2"))},
        {
            "f1": ("bigint", F.sum("f1")),
            "f2": ("int", F.min_by("f2", F.when(F.col("f2").isNotNull(), by))),
        },
        lambda known, _: known.select("f0", "f1", "f2"),
        rows_of=lambda t: t.withColumn("f1", F.col("f1").cast("bigint")),
        tuning=tuning,
    )


def rolling_max_record(tuning: Tuning = DEFAULT) -> Live:
    """The hottest reading of the key so far; of equals, the newest."""
    record = F.struct("temperature", "seq", "timestamp")
    best = F.max(record)
    return carried(
        READING,
        ["id"],
        ["seq"],
        {"best": running_max(record)},
        {"timestamp": ("bigint", best["timestamp"]), "temperature": ("double", best["temperature"])},
        lambda known, _: known.select(
            "seq", "id", F.col("best.timestamp").alias("timestamp"), F.col("best.temperature").alias("temperature")
        ),
        tuning=tuning,
    )


def _alerts(known: DataFrame, before: Column, threshold: float) -> DataFrame:
    diff = F.abs(F.col("temperature") - before)
    return known.select("id", "temperature", diff.alias("diff")).filter(exceeds(F.col("diff"), threshold))


def change_alerts(threshold: float = 1.7, tuning: Tuning = DEFAULT) -> Live:
    """Readings that differ from the key's last; the first of a key never alerts."""
    return carried(
        "id string, temperature double, diff double",
        ["id"],
        ["seq"],
        {"before": previous(F.col("temperature"))},
        {"temperature": ("double", _last("temperature"))},
        lambda known, _: _alerts(known, F.col("before"), threshold),
        tuning=tuning,
    )


def self_cleaning_alerts(
    threshold: float = 1.7, ttl_ms: int = HOUR, bound_ms: int = 5 * SECOND, tuning: Tuning = DEFAULT
) -> Live:
    """The same, but a key's last reading is forgotten once the watermark reaches its time and ``ttl_ms``.

    A forgotten reading stays in the state until the key has a new one.
    """

    def results(known: DataFrame, batch: Batch) -> DataFrame:
        alive = F.lit(batch.before) < F.col("seen") + F.lit(ttl_ms)
        return _alerts(known, F.when(alive, F.col("before")), threshold)

    return carried(
        "id string, temperature double, diff double",
        ["id"],
        ["seq"],
        {"before": previous(F.col("temperature")), "seen": previous(F.col("timestamp"))},
        {"temperature": ("double", _last("temperature")), "timestamp": ("bigint", _last("timestamp"))},
        results,
        raised_by_bounded(bound_ms),
        tuning=tuning,
    )


def with_switches(readings: DataFrame, switches: DataFrame) -> DataFrame:
    """Both streams as one: readings of kind 1, switches of kind 0 with the time they end."""
    until = (F.col("timestamp") + F.col("duration_ms")).alias("until")
    ours = readings.select("seq", "id", "timestamp", "temperature", F.lit(1).alias("kind"))
    theirs = switches.select("seq", "id", "timestamp", until, F.lit(0).alias("kind"))
    return ours.unionByName(theirs, allowMissingColumns=True)


def forward_switched(tuning: Tuning = DEFAULT) -> Live:
    """Readings that arrive while their key is switched on, of ``with_switches``."""
    forwarded = (F.col("kind") == 1) & (F.col("timestamp") < F.col("until"))
    return carried(
        READING,
        ["id"],
        ["seq", "kind"],
        {"until": running_max(F.col("until"))},
        {"until": ("bigint", F.max("until"))},
        lambda known, _: known.filter(forwarded).select("seq", "id", "timestamp", "temperature"),
        tuning=tuning,
    )


def with_levels(readings: DataFrame, smoke_levels: DataFrame, above: float = 100) -> DataFrame:
    """Both streams as one: readings hot enough to matter, and levels."""
    text = reading_text(F.col("id"), F.col("timestamp"), F.col("temperature"))
    hot = readings.filter(exceeds(F.col("temperature"), above)).select("seq", "timestamp", text.alias("text"))
    return hot.unionByName(smoke_levels.select("seq", "timestamp", "level"), allowMissingColumns=True)


def fire_alerts(tuning: Tuning = DEFAULT) -> Live:
    """Alerts for hot readings that arrive while the level is HIGH, of ``with_levels``.

    All keys share the level: it is one row of state, and rows meet it slice by slice.
    """
    alerting = F.col("text").isNotNull() & (F.col("level") == "HIGH")
    return carried(
        "message string, timestamp bigint",
        [],
        ["seq"],
        {"level": last_known(F.col("level"))},
        {"level": ("string", F.max_by("level", F.when(F.col("level").isNotNull(), F.col("seq"))))},
        lambda known, _: known.filter(alerting).select(
            F.concat(F.lit(FIRE_TEXT), "text").alias("message"), "timestamp"
        ),
        tuning=tuning,
    )


def tag_late(
    bound_ms: int = 5 * SECOND, size_ms: int | None = None, raises: Column | None = None
) -> Live:
    """Readings with ``is_late``: behind the watermark or, with ``size_ms``, after their window closed.

    Keeps no state but the watermark. ``raises`` is for watermarks of another kind.
    """
    raised = raised_by_bounded(bound_ms) if raises is None else raises

    def step(batch: Batch) -> tuple[DataFrame, None]:
        time = F.col("timestamp")
        last = time if size_ms is None else window_end(time, size_ms)
        late = last < F.lit(batch.before) if size_ms is None else last - 1 <= F.lit(batch.before)
        rows = batch.rows.select("seq", "id", "timestamp", "temperature", late.alias("is_late"))
        return rows, None

    return Live(f"{READING}, is_late boolean", step, raises=raised)


def tag_late_punctuated(marker_id: str = "sensor_1", bound_ms: int = MINUTE) -> Live:
    """The same against a watermark that only rows of one key raise."""
    return tag_late(raises=F.when(F.col("id") == marker_id, F.col("timestamp") - F.lit(bound_ms)))


def _with_arrivals(batch: Batch, size_ms: int, lateness_ms: int) -> DataFrame:
    """The windows of the state and of the batch: cnt before it, and rows ``n`` of it that count."""
    placed = batch.rows.select("id", window_end(F.col("timestamp"), size_ms).alias("end_ts"))
    taken = placed.filter(F.lit(batch.before) < F.col("end_ts") - 1 + lateness_ms)
    arrived = taken.groupBy("id", "end_ts").agg(F.count(F.lit(1)).alias("n"))
    held = [c for c in batch.state.columns if c not in ("id", "end_ts")]
    joined = batch.state.join(arrived, _same(batch.state, arrived, ["id", "end_ts"]), "full")
    return joined.select(
        *[F.coalesce(batch.state[k], arrived[k]).alias(k) for k in ("end_ts",)],
        F.when(arrived["n"].isNotNull(), arrived["id"]).otherwise(batch.state["id"]).alias("id"),
        *[batch.state[c] for c in held],
        F.coalesce(arrived["n"], F.lit(0)).alias("n"),
    )


def updated_window_counts(
    size_ms: int = 10 * SECOND, lateness_ms: int = 5 * SECOND, bound_ms: int = 5 * SECOND
) -> Live:
    """A ``first`` count as a window closes, and an ``update`` for each late row it accepts."""

    def step(batch: Batch) -> tuple[DataFrame, DataFrame]:
        before, after = F.lit(batch.before), F.lit(batch.after)
        end = F.col("end_ts")
        windows = _with_arrivals(batch, size_ms, lateness_ms).select(
            "id", "end_ts", "n",
            F.coalesce("cnt", F.lit(0)).cast("bigint").alias("had"),
            F.coalesce("fired", F.lit(False)).alias("fired"),
        ).withColumn("cnt", F.col("had") + F.col("n"))
        was_closed, is_closed = before >= end - 1, after >= end - 1
        low = F.when(was_closed, F.col("had") + 1).when(is_closed & ~F.col("fired"), F.col("cnt"))
        given = windows.select(
            "id", "end_ts", low.alias("first"), F.col("cnt").alias("last"),
            F.when(~F.col("fired"), low).alias("opening"),
        ).filter(F.col("first") <= F.col("last"))
        changes = windows.filter((F.col("n") > 0) | (is_closed & ~F.col("fired")) | (after >= end - 1 + lateness_ms))
        return numbered_results(given), changes.select(
            "id", "end_ts", "cnt", is_closed.alias("fired"), (after >= end - 1 + lateness_ms).alias("gone")
        )

    return Live(
        "id string, end_ts bigint, cnt bigint, tag string",
        step,
        ("id", "end_ts"),
        "id string, end_ts bigint, cnt bigint, fired boolean",
        raised_by_bounded(bound_ms),
    )


def early_window_counts(
    size_ms: int = 30 * SECOND, tick_ms: int = SECOND, bound_ms: int = 5 * SECOND
) -> Live:
    """Counts of open windows whenever the watermark passes a tick, and final ones as they close."""

    def step(batch: Batch) -> tuple[DataFrame, DataFrame]:
        windows = _with_arrivals(batch, size_ms, 0).select(
            "id", "end_ts", "n", (F.coalesce("cnt", F.lit(0)) + F.col("n")).cast("bigint").alias("cnt")
        )
        closed = F.lit(batch.after) >= F.col("end_ts") - 1
        ticked = batch.after != NO_WATERMARK and (
            batch.before == NO_WATERMARK or (batch.after + 1) // tick_ms > (batch.before + 1) // tick_ms
        )
        given = windows.filter(closed | F.lit(ticked)).select(
            "id", "end_ts", F.lit(batch.after).alias("eval_time"), "cnt"
        )
        changes = windows.filter((F.col("n") > 0) | closed).select("id", "end_ts", "cnt", closed.alias("gone"))
        return given, changes

    return Live(
        "id string, end_ts bigint, eval_time bigint, cnt bigint",
        step,
        ("id", "end_ts"),
        "id string, end_ts bigint, cnt bigint",
        raised_by_bounded(bound_ms),
    )


def changing_window_counts(size_ms: int = 10 * SECOND) -> Live:
    """The count so far of each window a batch adds to; a later result replaces an earlier one."""

    def step(batch: Batch) -> tuple[DataFrame, DataFrame]:
        windows = _with_arrivals(batch, size_ms, 0).filter(F.col("n") > 0).select(
            "id", "end_ts", (F.coalesce("cnt", F.lit(0)) + F.col("n")).cast("bigint").alias("cnt")
        )
        return windows, windows.withColumn("gone", F.lit(False))

    schema = "id string, end_ts bigint, cnt bigint"
    return Live(schema, step, ("id", "end_ts"), schema)


def latest_max(size_ms: int = 10 * SECOND) -> Live:
    """The highest temperature of each key's newest window, kept for look-up."""

    def step(batch: Batch) -> tuple[DataFrame, DataFrame]:
        placed = batch.rows.select("id", window_end(F.col("timestamp"), size_ms).alias("end_ts"), "temperature")
        # a newer window wins, and in one window the higher temperature
        own = placed.groupBy("id").agg(F.max(F.struct("end_ts", "temperature")).alias("own"))
        held = batch.state.select(F.col("id").alias("_id"), F.struct("end_ts", "temperature").alias("held"))
        newest = own.join(held, F.col("id").eqNullSafe(F.col("_id")), "left").select(
            "id", F.greatest("own", "held").alias("new")
        ).select("id", "new.end_ts", "new.temperature")
        return newest, newest.withColumn("gone", F.lit(False))

    schema = "id string, end_ts bigint, temperature double"
    return Live(schema, step, ("id",), schema)
