"""Fixed examples, with results known from the rules themselves."""

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.scalar import (
    ONE_SPACE,
    WHITESPACE,
    bytes_to_int,
    int_to_bytes,
    round_half_down,
    round_half_up,
    split_words,
    to_celsius,
)
from tidegauge.functions.timeops import floor_to, whole_div, window_end
from tidegauge.operators import alerts, latest, rolling, transforms, windows
from tidegauge.plans import watermarks
from tidegauge.sources import readings as src


def rows(df):
    return [tuple(r) for r in df.collect()]


def readings(spark, *values):
    data = [(i, k, t, v) for i, (k, t, v) in enumerate(values)]
    return spark.createDataFrame(data, src.READING)


def test_rolling_sum_inline(spark):
    inline = src.from_values(
        spark,
        [(0, 1, 2, 2), (1, 1, 4, 4), (2, 2, 3, 1), (3, 2, 2, 4), (4, 1, 5, 3)],
        "seq long, f0 int, f1 int, f2 int",
    )
    expected = [(1, 2, 2), (1, 6, 2), (1, 11, 2), (2, 3, 1), (2, 5, 1)]
    assert sorted(rows(rolling.rolling_sum(inline))) == expected


def test_filter_and_split(spark):
    given = readings(spark, ("a_1", 0, 24.9), ("sensor_12", 1, 25.0), ("c_3", 2, 25.1))
    strict = transforms.filter_by_threshold(given)
    inclusive = transforms.filter_by_threshold(given, inclusive=True)
    assert [r[0] for r in rows(transforms.project_id(strict))] == ["c_3"]
    assert [r[0] for r in rows(inclusive.select("temperature"))] == [25.0, 25.1]
    parts = rows(transforms.filter_project_split(given, inclusive=True))
    assert parts == [("sensor",), ("12",), ("c",), ("3",)]


@pytest.mark.parametrize(
    ("line", "by_space", "by_whitespace"),
    [
        ("a b  c ", ["a", "b", "", "c"], ["a", "b", "c"]),
        (" x y", ["", "x", "y"], ["", "x", "y"]),
        ("", [""], [""]),
        ("   ", [], []),
        ("a\tb \t", ["a\tb", "\t"], ["a", "b"]),
        ("\x0b\ta\r\n", ["\x0b\ta\r\n"], ["", "a"]),
    ],
)
def test_split_words(spark, line, by_space, by_whitespace):
    df = spark.createDataFrame([(line,)], "value string")
    value = F.col("value")
    got = df.select(split_words(value, ONE_SPACE), split_words(value, WHITESPACE)).first()
    assert list(got) == [by_space, by_whitespace]


@pytest.mark.parametrize(
    ("value", "up", "down"),
    [
        (1.0005, 1.001, 1.0),
        (-1.0005, -1.001, -1.0),
        (1.00051, 1.001, 1.001),
        (2.0, 2.0, 2.0),
        (0.0014999, 0.001, 0.001),
        (1.0e-5, 0.0, 0.0),
    ],
)
def test_rounding(spark, value, up, down):
    df = spark.createDataFrame([(value,)], "v double")
    assert tuple(df.select(round_half_up(F.col("v")), round_half_down(F.col("v"))).first()) == (
        up,
        down,
    )


@pytest.mark.parametrize(
    ("number", "digits"),
    [(1, "00000001"), (258, "00000102"), (-2, "FFFFFFFE"), (2**31 - 1, "7FFFFFFF"), (-(2**31), "80000000")],
)
def test_int_codec(spark, number, digits):
    df = spark.createDataFrame([(number,)], "n long")
    encoded = df.select(int_to_bytes(F.col("n")).alias("b"))
    assert encoded.select(F.hex("b"), bytes_to_int(F.col("b"))).first()[:] == (digits, number)


def test_celsius_and_time(spark):
    df = spark.createDataFrame([(212.0, -1)], "v double, t long")
    t = F.col("t")
    got = df.select(to_celsius(F.col("v")), floor_to(t, 10), window_end(t, 10), whole_div(t, 10))
    assert tuple(got.first()) == (pytest.approx(100.0), -10, 0, -1)


def test_rolling_max_tie_goes_to_the_newer(spark):
    given = readings(spark, ("a", 1, 10.0), ("a", 2, 10.0), ("a", 3, 9.0))
    got = rows(rolling.rolling_max_record(given).orderBy("seq"))
    assert [r[2] for r in got] == [1, 2, 2]


def test_change_alert(spark):
    given = readings(spark, ("a", 1, 20.0), ("a", 2, 22.0), ("a", 3, 22.5), ("b", 4, 90.0))
    assert rows(alerts.change_alerts(given)) == [("a", 22.0, 2.0)]


def test_freezing_monitor_passes_all(spark):
    given = readings(spark, ("a", 1, 31.9), ("b", 2, 32.0))
    passed, alarms = transforms.monitor_freezing(given)
    assert passed.count() == 2
    assert rows(alarms) == [("Freezing Alarm for a",)]


def test_windows(spark):
    given = readings(spark, ("a", 0, 32.0), ("a", 999, 212.0), ("a", 1_000, 50.0))
    got = sorted(rows(windows.avg_celsius(given)))
    assert got == [("a", 1_000, pytest.approx(50.0)), ("a", 2_000, pytest.approx(10.0))]
    assert rows(windows.window_minmax(given)) == [("a", 5_000, 32.0, 212.0)]


def test_no_watermark_before_the_first_event(spark):
    given = readings(spark, ("a", 100_000, 1.0), ("sensor_1", 90_000, 1.0), ("a", 80_000, 1.0))
    low = -9223372036854775807

    def marks(df):
        return [r[0] for r in rows(df.orderBy("seq").select("wm"))]

    assert marks(watermarks.bounded_watermark(given)) == [low, 94_999, 94_999]
    assert marks(watermarks.periodic_watermark(given)) == [low, 40_000, 40_000]
    assert marks(watermarks.punctuated_watermark(given)) == [low, low, 30_000]


def test_latest_and_dashboard(spark):
    results = spark.createDataFrame(
        [("sensor_1", 10, 5.0), ("sensor_1", 20, 1.0005), ("sensor_2", 10, 7.0)],
        "id string, end_ts long, temperature double",
    )
    newest = latest.latest_per_key(results)
    assert rows(latest.lookup(newest, ["sensor_1", "sensor_9"])) == [("sensor_1", 1.0005)]
    ids = ["sensor_1", "sensor_2", "sensor_9"]
    assert rows(latest.dashboard(newest, ids)) == [(1.001, 7.0, None)]
    assert rows(latest.dashboard(newest, ids, round_half_down)) == [(1.0, 7.0, None)]
