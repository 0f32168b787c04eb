"""Live operators by micro-batches against the batch forms and the row-by-row machines."""

import machines
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_operators import TINIEST, frame, got, stream

from tidegauge.operators import alerts, control, late, rolling, windows
from tidegauge.plans import running
from tidegauge.session import shared_folder
from tidegauge.sources.readings import READING
from tidegauge.streaming import micro
from tidegauge.streaming import operators as live

STEPS = 3
NAMES = "seq long, value string"
TRIPLES = "seq long, f0 long, f1 int, f2 int"


def width(rows):
    return (len(rows) - 1) // STEPS + 1


def steps_of(rows):
    return [rows[i * width(rows):(i + 1) * width(rows)] for i in range(STEPS)]


@pytest.fixture(scope="module")
def rows():
    """A busy key, some others, and a null key."""
    made = stream(n=150, seed=31, jitter=6_000)
    return [(s, None if k == "k1" else k, t, v) for s, k, t, v in made]


def replayed(df, operator, **options):
    return micro.replay_in_steps(df, STEPS, operator, "micro", **options)


def test_rolling_values(spark, rows):
    readings = frame(spark, rows)
    result = replayed(readings, live.rolling_max_record(TINIEST)).results()
    columns = ["seq", "id", "timestamp", "temperature"]
    assert sorted(map(repr, got_rows(result, columns))) == sorted(
        map(repr, got_rows(rolling.rolling_max_record(readings), columns))
    )
    names = readings.select("seq", F.col("id").alias("value"))
    result = replayed(names, live.name_counts(TINIEST)).results()
    columns = ["seq", "name", "count"]
    assert sorted(map(repr, got_rows(result, columns))) == sorted(
        map(repr, got_rows(rolling.name_counts(names), columns))
    )


def got_rows(df, columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_rolling_sum_by_several_columns(spark):
    triples = [(i // 2, i % 3, (i * 7) % 5, i) for i in range(60)]
    schema = "seq long, f0 long, f1 int, f2 int"
    df = spark.createDataFrame(triples, schema)
    operator = live.rolling_sum(["seq", "f2"], TINIEST)
    got_sums = sorted(got_rows(replayed(df, operator).results(), ["f0", "f1", "f2"]))
    assert got_sums == sorted(got_rows(rolling.rolling_sum(df, ["seq", "f2"]), ["f0", "f1", "f2"]))


def test_change_alerts(spark, rows):
    readings = frame(spark, rows)
    columns = ["id", "temperature", "diff"]
    result = got_rows(replayed(readings, live.change_alerts(3.0, TINIEST)).results(), columns)
    want = got_rows(alerts.change_alerts(readings, 3.0), columns)
    assert want and sorted(map(repr, result)) == sorted(map(repr, want))


def test_self_cleaning_alerts(spark, rows):
    operator = live.self_cleaning_alerts(3.0, 2_000, 1_000, TINIEST)
    result = got_rows(replayed(frame(spark, rows), operator).results(), ["id", "temperature", "diff"])
    last, want = {}, []
    for (_, key, t, v), wm in machines.with_watermarks(rows, 1_000, step=width(rows)):
        before, seen = last.get(key, (None, None))
        if before is not None and wm < seen + 2_000 and abs(v - before) > 3.0:
            want.append((key, v, abs(v - before)))
        last[key] = v, t
    assert want and sorted(map(repr, result)) == sorted(map(repr, want))


def test_switches_and_levels(spark, rows):
    readings = frame(spark, [r for r in rows if r[0] % 5])
    switches = spark.createDataFrame(
        [(s, k, t, 400 * (s % 3)) for s, k, t, _ in rows if s % 5 == 0],
        "seq long, id string, timestamp long, duration_ms long",
    )
    operator = live.forward_switched(TINIEST)
    result = replayed(live.with_switches(readings, switches), operator).results()
    want = control.forward_switched(readings, switches)
    columns = ["seq", "timestamp"]
    assert got(want, *columns) and got(result, *columns) == got(want, *columns)

    levels = spark.createDataFrame(
        [(s, t, "HIGH" if s % 2 else "LOW") for s, _, t, _ in rows if s % 5 == 0],
        "seq long, timestamp long, level string",
    )
    readings = readings.filter("id IS NOT NULL")
    result = replayed(live.with_levels(readings, levels, 20), live.fire_alerts(TINIEST)).results()
    want = control.fire_alerts(readings, levels, 20)
    columns = ["message", "timestamp"]
    assert got(want, *columns) and got(result, *columns) == got(want, *columns)


def test_late_rows(spark, rows):
    for size, late_if in [
        (None, lambda t, wm: t < wm),
        (3_000, lambda t, wm: wm >= t - t % 3_000 + 2_999),
    ]:
        result = replayed(frame(spark, rows), live.tag_late(1_000, size)).results()
        marked = machines.with_watermarks(rows, 1_000, step=width(rows))
        want = sorted((r[0], late_if(r[2], wm)) for r, wm in marked)
        assert {late_ for _, late_ in want} == {True, False}
        assert got(result, "seq", "is_late") == want


def test_updated_counts(spark):
    rows = stream(n=150, seed=33, jitter=6_000)
    run = replayed(frame(spark, rows), live.updated_window_counts(4_000, 3_000, 1_000))
    want = sorted(machines.updates(rows, 4_000, 3_000, 1_000, step=width(rows)))
    assert {r[3] for r in want} == {"first", "update"}
    assert got(run.finished(), "id", "end_ts", "cnt", "tag") == want
    open_ends = {r.end_ts for r in run.state().collect()}
    best = max(r[2] for r in rows) - 1_001
    assert all(end - 1 + 3_000 > best for end in open_ends)


def test_early_counts(spark):
    rows = stream(n=150, seed=34)
    run = replayed(frame(spark, rows), live.early_window_counts(10_000, 1_000, 1_000))
    want = sorted(machines.early_in_steps(steps_of(rows), 10_000, 1_000, 1_000))
    assert got(run.results(), "id", "end_ts", "eval_time", "cnt") == want


def test_open_windows_are_corrected_by_later_batches(spark, rows):
    readings = frame(spark, rows).filter("id IS NOT NULL")
    run = replayed(readings, live.changing_window_counts(5_000))
    newest = micro.newest_results(run.results(), ["id", "end_ts"])
    columns = ["id", "end_ts", "cnt"]
    assert got(newest, *columns) == got(windows.window_count(readings, 5_000), *columns)
    assert run.results().count() > newest.count()


def test_state_can_be_looked_up_as_of_any_batch(spark, rows, monkeypatch):
    """Also where the state is written whole now and then, and for keys of earlier batches."""
    monkeypatch.setattr(micro, "WHOLE_EVERY", 2)
    readings = frame(spark, rows).filter("id IS NOT NULL")
    run = replayed(readings, live.latest_max(5_000))
    for batch in range(STEPS):
        seen = readings.filter(F.col("seq") < (batch + 1) * width(rows))
        found = windows.window_max(seen, 5_000).groupBy("id").agg(
            F.max("end_ts").alias("end_ts"), F.max_by("temperature", "end_ts").alias("temperature")
        )
        columns = ["id", "end_ts", "temperature"]
        assert got(run.state(batch), *columns) == got(found, *columns)


def test_live_goes_on_from_recorded_rows(spark, rows):
    """The first half in batch, the second live, is the whole."""
    readings = frame(spark, rows)
    half = len(rows) // 2
    first, second = readings.filter(F.col("seq") < half), readings.filter(F.col("seq") >= half)
    for operator, whole, columns in [
        (live.rolling_max_record(), rolling.rolling_max_record(readings), ["seq", "temperature"]),
        (live.change_alerts(3.0), alerts.change_alerts(readings, 3.0), ["id", "temperature", "diff"]),
    ]:
        folder = shared_folder(spark, "second")
        second.write.parquet(folder)
        stream_ = spark.readStream.schema(READING).parquet(folder)
        run = micro.replay(stream_, operator, "resumed", initial=live.state_after(operator, first))
        before = [r for r in got_rows(operator_on(operator, first), columns)]
        both = before + got_rows(run.results(), columns)
        assert sorted(map(repr, both)) == sorted(map(repr, got_rows(whole, columns)))


def operator_on(operator, rows):
    spark = rows.sparkSession
    none = spark.createDataFrame([], operator.state_schema)
    return operator.step(micro.Batch(rows, none, -1, micro.NO_WATERMARK, micro.NO_WATERMARK))[0]


def test_two_sinks_survive_a_failure_between_them(spark, rows):
    """Neither sink misses a batch or has one twice."""
    folder = shared_folder(spark, "sinks")
    names = frame(spark, rows).filter("id IS NOT NULL").select("seq", F.col("id").alias("value"))
    failures = [1]

    def broken(results, batch):
        if batch == 1 and failures:
            failures.pop()
            raise RuntimeError("lost between two sinks")

    sinks = [
        micro.table_sink(f"{folder}/shown", lambda r: r.select("name", "count")),
        broken,
        micro.table_sink(f"{folder}/encoded", lambda r: r.select("seq", F.hex("name").alias("key"))),
    ]

    def go_on(i):
        part = names.filter(F.col("seq").between(i * width(rows), (i + 1) * width(rows) - 1))
        part.write.mode("append").parquet(f"{folder}/in")

    def run():
        stream_ = spark.readStream.schema(NAMES).parquet(f"{folder}/in")
        micro.start(stream_, live.name_counts(), folder, f"{folder}/cp", sinks=sinks).awaitTermination()

    go_on(0)
    run()
    go_on(1)
    with pytest.raises(StreamingQueryException):
        run()
    assert micro.committed(spark, f"{folder}/cp") == 0
    half = micro.read_results(spark, "seq long, name string, count long", folder, f"{folder}/cp")
    assert half.count() == names.filter(F.col("seq") < width(rows)).count()
    run()
    go_on(2)
    run()
    want = got(rolling.name_counts(names), "name", "count")
    shown = micro.read_results(spark, "name string, count long", folder, f"{folder}/cp", "shown")
    assert got(shown, "name", "count") == want
    encoded = micro.read_results(spark, "seq long, key string", folder, f"{folder}/cp", "encoded")
    assert got(encoded, "seq") == [(r.seq,) for r in names.orderBy("seq").collect()]


def test_a_batch_of_one_key_is_cut_into_slices(spark):
    """A million rows of one key, after a first batch: no slice, so no task, has many of them."""
    n = 1_000_000
    readings = spark.range(n + 10).select(
        F.col("id").alias("seq"), F.lit("hot").alias("id"), F.col("id").alias("timestamp"),
        (F.col("id") * 7919 % 1000).cast("double").alias("temperature"),
    )
    folder = shared_folder(spark, "hot")
    operator = live.change_alerts(0.5)
    for part in (readings.filter("seq < 10"), readings.filter("seq >= 10")):
        part.write.mode("append").parquet(f"{folder}/in")
        stream_ = spark.readStream.schema(readings.schema).parquet(f"{folder}/in")
        micro.start(stream_, operator, folder, f"{folder}/cp").awaitTermination()
    result = micro.read_results(spark, operator.schema, folder, f"{folder}/cp")
    assert result.count() == n + 9
    scans = {"before": running.previous(F.col("temperature"))}
    sliced = running.add_running(readings, ["id"], "seq", scans, keep_slices=True)
    largest = sliced.groupBy(running.SLICE).count().agg(F.max("count")).first()[0]
    assert largest <= 2 * running.DEFAULT.rows_per_slice


def test_no_rows(spark):
    """A batch without rows, and a stream without any file, give nothing."""
    folder = shared_folder(spark, "none")
    frame(spark, []).write.parquet(f"{folder}/in")
    stream_ = spark.readStream.schema(READING).parquet(f"{folder}/in")
    for operator in (live.rolling_max_record(), live.tag_late(), live.updated_window_counts()):
        run = micro.replay(stream_, operator, "none")
        assert run.results().count() == 0


def test_whole_batches_of_late_updates(spark):
    """Late rows of a window that had no row on time: its first result comes late, too."""
    rows = [(0, "a", 10_500, 1.0), (1, "a", 30_000, 1.0), (2, "a", 12_000, 1.0), (3, "a", 12_500, 1.0),
            (4, "b", 29_000, 1.0), (5, "b", 12_000, 1.0)]
    df = spark.createDataFrame(rows, READING)
    run = micro.replay_in_steps(df, 3, live.updated_window_counts(4_000, 30_000, 0), "late")
    want = sorted(machines.updates(rows, 4_000, 30_000, 0, step=2))
    assert got(run.finished(), "id", "end_ts", "cnt", "tag") == want
    assert late.UPDATES_PER_BLOCK > 1
