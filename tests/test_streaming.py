"""Live forms give what the batch forms and the row-by-row machines give."""

import random
import time

import machines
import pytest
from pyspark.sql import functions as F
from test_operators import frame, got, stream

from tidegauge.functions.scalar import ONE_SPACE
from tidegauge.operators import late, rolling, windows
from tidegauge.plans import watermarks
from tidegauge.session import shared_folder
from tidegauge.sources import readings as src
from tidegauge.streaming import jobs

STEPS = 4


def steps_of(rows):
    width = (len(rows) - 1) // STEPS + 1
    return [rows[i * width:(i + 1) * width] for i in range(STEPS)]


def test_updated_counts_in_steps(spark):
    rows = stream(n=120, seed=21, jitter=6_000)
    result = jobs.replay_in_steps(
        frame(spark, rows),
        STEPS,
        lambda r: jobs.updated_window_counts(r, 4_000, 3_000, 1_000),
        "updates",
        60_000,
    )
    width = (len(rows) - 1) // STEPS + 1
    expected = sorted(machines.updates(rows, 4_000, 3_000, 1_000, step=width))
    assert {r[3] for r in expected} == {"first", "update"}
    assert got(result, "id", "end_ts", "cnt", "tag") == expected
    marked = watermarks.bounded_watermark(frame(spark, rows), 1_000, step_rows=width)
    batch = late.updated_window_counts(marked, 4_000, 3_000)
    assert got(batch, "id", "end_ts", "cnt", "tag") == expected


def test_early_counts_in_steps(spark):
    rows = stream(n=160, seed=22)
    result = jobs.replay_in_steps(
        frame(spark, rows),
        STEPS,
        lambda r: jobs.early_window_counts(r, 10_000, 1_000, 1_000),
        "early",
        60_000,
    )
    last = max(r[2] for r in rows)
    flush = [(len(rows), "flush", last + 60_000, 0.0)]
    expected = machines.early_in_steps([*steps_of(rows), flush], 10_000, 1_000, 1_000)
    expected = sorted(r for r in expected if r[0] != "flush")
    assert got(result, "id", "end_ts", "eval_time", "cnt") == expected


def test_late_rows_are_tagged(spark):
    rows = stream(n=120, seed=23, jitter=6_000)
    width = (len(rows) - 1) // STEPS + 1
    marked = machines.with_watermarks(rows, 1_000, step=width)
    expected = sorted((r[0], r[2] < wm) for r, wm in marked)
    for_window = sorted((r[0], wm >= r[2] - r[2] % 3_000 + 2_999) for r, wm in marked)
    for size, wanted in [(None, expected), (3_000, for_window)]:
        result = jobs.replay_in_steps(
            frame(spark, rows),
            STEPS,
            lambda r, size=size: jobs.tag_late(r, 1_000, size),
            "late",
            60_000,
        )
        assert {late_ for _, late_ in wanted} == {True, False}
        assert got(result, "seq", "is_late") == wanted


def test_no_late_row_is_lost(spark):
    """Rows ten days late, below number 0, of no key and of any name come out, marked."""
    day = 86_400_000
    rows = [(i, key, 1_700_000_000_000 + i * 1_000, 1.0)
            for i, key in zip(range(-2, 8), ["a", None, "_flush", "a", "b"] * 2)]
    rows += [(8, "a", 1_700_000_000_000 - 10 * day, 2.0), (9, None, 1_700_000_000_000 - day, 2.0)]
    result = jobs.replay_in_steps(
        frame(spark, rows), 2, lambda r: jobs.tag_late(r, 1_000), "very_late", 60_000
    )
    assert got(result, "seq", "is_late") == [(s, s >= 8) for s in range(-2, 10)]


def test_late_against_a_punctuated_watermark(spark):
    rows = stream(n=120, seed=25, jitter=6_000)
    result = jobs.replay_in_steps(
        frame(spark, rows), STEPS, lambda r: jobs.tag_late_punctuated(r, "k3", 500), "marker", 1
    )
    width = (len(rows) - 1) // STEPS + 1
    best = shown = machines.LOW
    expected = []
    for seq, key, t, _ in rows:
        if seq % width == 0:
            shown = best
        expected.append((seq, t < shown))
        best = max(best, t - 500) if key == "k3" else best
    assert {late_ for _, late_ in expected} == {True, False}
    assert got(result, "seq", "is_late") == expected


def test_rolling_sum(spark):
    rng = random.Random(24)
    rows = [(i, rng.choice([1, 1, 2]), rng.randrange(9), rng.randrange(9)) for i in range(60)]
    schema = "seq long, f0 int, f1 int, f2 int"
    folder = shared_folder(spark, "triples")
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(folder)
    live = spark.readStream.schema(schema).parquet(folder)
    batch = rolling.rolling_sum(spark.read.parquet(folder))
    columns = ["f0", "f1", "f2"]
    assert got(jobs.replay(jobs.rolling_sum(live), "sums"), *columns) == got(batch, *columns)


def test_latest_value_is_kept_in_state(spark):
    """A stopped query's state can be looked up by key; the query can go on from it."""
    folder = shared_folder(spark, "results")
    schema = "id string, end_ts long, temperature double"
    for rows in ([("a", 10, 1.0), ("b", 10, 2.0)], [("a", 30, 3.0), ("a", 20, 9.0)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/in")
        live = spark.readStream.schema(schema).parquet(f"{folder}/in")
        jobs.start(
            jobs.latest_values(live), f"{folder}/out", f"{folder}/checkpoint", name="latest"
        ).awaitTermination()
    state = jobs.read_state(spark, f"{folder}/checkpoint")
    assert got(state, "id", "end_ts", "temperature") == [("a", 30, 3.0), ("b", 10, 2.0)]


def test_rise_timer_on_the_clock(spark):
    folder = shared_folder(spark, "rises")
    rows = [(0, "up", 0, 1.0), (1, "up", 0, 2.0), (2, "down", 0, 2.0), (3, "down", 0, 3.0),
            (4, "down", 0, 1.0), (5, "flat", 0, 1.0)]
    frame(spark, rows).write.parquet(f"{folder}/in")
    live = src.stream_readings(spark, f"{folder}/in")
    query = jobs.start(
        jobs.rise_warnings(live, 500), f"{folder}/out", f"{folder}/checkpoint", every="1 second"
    )
    try:
        deadline = time.time() + 60
        found = []
        while not found and time.time() < deadline:
            time.sleep(1)
            found = spark.read.schema(jobs.rise_warnings(live).schema).parquet(
                f"{folder}/out").collect() if query.recentProgress else []
    finally:
        query.stop()
    assert [r["id"] for r in found] == ["up"]
    assert found[0]["message"] == (
        "Temperature of sensor 'up' monotonically increased for 1 second."
    )


def test_words_by_arrival(spark):
    folder = shared_folder(spark, "lines")
    spark.createDataFrame([("a b",), ("a",)], "value string").coalesce(1).write.text(folder)
    live = src.stream_lines(spark, folder)
    counts = windows.word_counts(live.withWatermark("arrival", "0 seconds"), ONE_SPACE)
    query = (
        counts.writeStream.format("memory").queryName("live_words").outputMode("update")
        .option("checkpointLocation", shared_folder(spark, "words"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert got(spark.table("live_words"), "word", "count") == [("a", 2), ("b", 1)]


def test_two_consumers_of_one_stream(spark, small):
    """One source, two queries, each with its own output and checkpoint."""
    live = src.readings_of_events(src.stream_events(spark, small))
    folder = shared_folder(spark, "two")
    started = [
        jobs.start(
            live.filter(condition).select("seq"), f"{folder}/{name}", f"{folder}/{name}_cp", name
        )
        for name, condition in [("cold", F.col("temperature") < 32), ("all", F.lit(True))]
    ]
    for query in started:
        query.awaitTermination()
    total = spark.read.parquet(f"{folder}/all").count()
    assert 0 < spark.read.parquet(f"{folder}/cold").count() < total == 1_000


def test_ingest_round_trip(spark):
    folder = shared_folder(spark, "ingest")
    frame(spark, stream(n=20)).write.parquet(folder)
    read = src.read_readings(spark, folder)
    assert dict(read.dtypes)["event_time"] == "timestamp"
    same = read.filter(F.unix_millis("event_time") == F.col("timestamp"))
    assert same.count() == 20


@pytest.mark.parametrize("name", ["spark.checkpoint.dir"])
def test_shared_folder_follows_the_session(spark, name):
    root = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    assert shared_folder(spark, "x").startswith(root)
    assert shared_folder(spark, "x") != shared_folder(spark, "x")
