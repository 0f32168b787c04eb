"""Operators against row-by-row machines, on small and deliberately skewed input."""

import random
from dataclasses import replace

import machines
import pytest

from tidegauge.operators import alerts, control, early, late, rolling
from tidegauge.plans import running, watermarks
from tidegauge.sources.readings import READING

# Cuts even the smallest fixtures into slices and spans.
TINY = running.Tuning(rows_per_slice=7, min_hot_rows=10, max_hot_keys=20)
# The registered queries run with the default tuning, so these use others.
TINIEST = replace(TINY, rows_per_slice=2)


def stream(n=400, seed=1, step=300, jitter=2_000, values=40):
    """Readings of which one key has more than a third."""
    rng = random.Random(seed)
    t, rows = 1_700_000_000_000, []
    for seq in range(n):
        t += rng.randrange(step)
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(9)}"
        rows.append((seq, key, t + rng.randrange(jitter) if jitter else t,
                     float(rng.randrange(values))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, READING).repartition(3)


def got(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_updated_counts(spark):
    rows = stream()
    marked = watermarks.bounded_watermark(frame(spark, rows), 1_000, tuning=TINY)
    result = late.updated_window_counts(marked, 2_000, 1_500)
    expected = sorted(machines.updates(rows, 2_000, 1_500, 1_000))
    assert {r[3] for r in expected} == {"first", "update"}
    assert got(result, "id", "end_ts", "cnt", "tag") == expected


def test_many_updates_of_one_window(spark, monkeypatch):
    monkeypatch.setattr(late, "UPDATES_PER_BLOCK", 3)
    rows = [(0, "a", 10_000, 1.0), (1, "b", 10_000, 1.0), (2, "b", 10_999, 1.0)]
    rows += [(i, "a", 4_500, 1.0) for i in range(3, 40)]
    rows += [(i, "c", 4_500, 1.0) for i in range(40, 44)]
    marked = watermarks.bounded_watermark(frame(spark, rows), 1_000, tuning=TINY)
    result = late.updated_window_counts(marked, 5_000, 9_000)
    expected = sorted(machines.updates(rows, 5_000, 9_000, 1_000))
    assert got(result, "id", "end_ts", "cnt", "tag") == expected


@pytest.mark.parametrize("step", [None, 50])
def test_first_and_last_updates_add_up(spark, step):
    rows = stream(seed=5)
    marked = watermarks.bounded_watermark(frame(spark, rows), 1_000, step_rows=step, tuning=TINY)
    result = late.updated_window_counts(marked, 2_000, 1_500).groupBy("id", "end_ts").max("cnt")
    accepted = [
        r
        for r, wm in machines.with_watermarks(rows, 1_000, step)
        if wm < r[2] - r[2] % 2_000 + 2_000 - 1 + 1_500
    ]
    assert sum(r[2] for r in result.collect()) == len(accepted)


def test_late_split(spark):
    rows = stream(seed=2)
    marked = watermarks.bounded_watermark(frame(spark, rows), 500, tuning=TINIEST)
    on_time, behind = late.split_late(marked)
    expected = [r for r, wm in machines.with_watermarks(rows, 500) if r[2] < wm]
    assert got(behind, "seq") == sorted((r[0],) for r in expected)
    assert on_time.count() + len(expected) == len(rows)


@pytest.mark.parametrize("tuning", [running.DEFAULT, TINY, TINIEST])
def test_change_alerts(spark, tuning):
    rows = stream(seed=3)
    result = alerts.change_alerts(frame(spark, rows), 5.0, tuning=tuning)
    assert got(result, "id", "temperature", "diff") == sorted(machines.changes(rows, 5.0))


def test_self_cleaning_alerts(spark):
    rows = stream(seed=4)
    marked = watermarks.bounded_watermark(frame(spark, rows), 500, tuning=TINY)
    result = alerts.self_cleaning_alerts(marked, 5.0, 1_200, tuning=TINY)
    expected = machines.changes(rows, 5.0, 1_200, 500)
    assert 0 < len(expected) < len(machines.changes(rows, 5.0))
    assert got(result, "id", "temperature", "diff") == sorted(expected)


@pytest.mark.parametrize("size", [3_000, 20_000])
def test_early_counts(spark, size):
    rows = stream(seed=6)
    # a key silent for years must not cost a row per window in between
    far = 300 * 365 * 86_400_000
    rows += [(s + len(rows), k, t + far, v) for s, k, t, v in rows[:40]]
    marked = watermarks.bounded_watermark(frame(spark, rows), 1_000, tuning=TINY)
    result = early.early_window_counts(marked, 1_000, size, 500)
    expected = sorted(machines.early(rows, size, 500, 1_000))
    assert got(result, "id", "end_ts", "eval_time", "cnt") == expected


@pytest.mark.parametrize("values", [40, 2])
def test_rise_warnings(spark, values):
    rows = stream(seed=7, jitter=0, values=values)
    result = alerts.rise_warnings(frame(spark, rows), 1_000, tuning=TINY)
    expected = machines.rises(rows, 1_000)
    assert expected
    assert got(result, "id", "timestamp") == sorted(expected)


@pytest.mark.parametrize("duration", [1, 300, 1_000, 30_000])
def test_long_climbs(spark, duration):
    """Unbroken climbs of more rises than a slice or a timer's duration holds."""
    rng = random.Random(8)
    t, rows, value = 1_700_000_000_000, [], 0.0
    for seq in range(400):
        t += rng.randrange(300)
        value = value + rng.randrange(2) if seq % 150 else 0.0
        rows.append((seq, "hot" if seq % 9 else "other", t, value))
    result = alerts.rise_warnings(frame(spark, rows), duration, tuning=TINY)
    assert got(result, "id", "timestamp") == sorted(machines.rises(rows, duration))


def test_no_rises(spark):
    flat = [(seq, "a", seq * 1_000, 5.0) for seq in range(5)]
    assert alerts.rise_warnings(frame(spark, flat), 1_000).count() == 0
    assert alerts.rise_warnings(frame(spark, []), 1_000).count() == 0


def test_forward_switched(spark):
    rng = random.Random(9)
    rows = stream(seed=9, jitter=0)
    mixed = [
        (s, k, t, rng.choice([300, 900, 4_000]) if rng.random() < 0.1 else None)
        for s, k, t, _ in rows
    ]
    readings = frame(spark, [r for r, m in zip(rows, mixed) if m[3] is None])
    switches = spark.createDataFrame(
        [m for m in mixed if m[3] is not None],
        "seq long, id string, timestamp long, duration_ms long",
    )
    expected = sorted((s,) for s in machines.forwarded(mixed))
    assert expected
    result = control.forward_switched(readings, switches, tuning=TINIEST)
    assert got(result, "seq") == expected
    twice = control.forward_switched(readings, switches.union(switches), tuning=TINIEST)
    assert got(twice, "seq") == expected


def test_fire_alerts(spark):
    rows = stream(seed=10, values=200)
    rng = random.Random(10)
    levels = [(s, rng.choice(["LOW", "HIGH"])) for s, *_ in rows if rng.random() < 0.1]
    readings = [r for r in rows if r[0] not in {s for s, _ in levels}]
    smoke = spark.createDataFrame(
        [(s, 0, level) for s, level in levels], "seq long, timestamp long, level string"
    )
    expected, level, known = [], "LOW", dict(levels)
    for seq, key, t, v in rows:
        level = known.get(seq, level)
        if seq not in known and level == "HIGH" and v > 100:
            expected.append((f"Risk of fire! SensorReading({key}, {t}, {v})", t))
    assert expected
    result = control.fire_alerts(frame(spark, readings), smoke, tuning=TINY)
    assert got(result, "message", "timestamp") == sorted(expected)


def test_rolling(spark):
    rows = stream(seed=11, values=5)
    best, expected = {}, []
    for seq, key, t, v in rows:
        if key not in best or not best[key][1] > v:
            best[key] = (t, v)
        expected.append((seq, key, *best[key]))
    result = rolling.rolling_max_record(frame(spark, rows), tuning=TINIEST)
    assert got(result, "seq", "id", "timestamp", "temperature") == expected

    counts, expected = {}, []
    for seq, key, _, _ in rows:
        counts[key] = counts.get(key, 0) + 1
        expected.append((seq, key.upper(), counts[key]))
    names = frame(spark, rows).selectExpr("seq", "id AS value")
    assert got(rolling.name_counts(names, tuning=TINIEST), "seq", "name", "count") == expected


def test_rolling_sum_keeps_first_of_other_fields(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice([1, 1, 2, 3]), rng.randrange(9), rng.randrange(9)) for i in range(300)]
    sums, firsts, expected = {}, {}, []
    for _, f0, f1, f2 in rows:
        sums[f0] = sums.get(f0, 0) + f1
        expected.append((f0, sums[f0], firsts.setdefault(f0, f2)))
    triples = spark.createDataFrame(rows, "seq long, f0 int, f1 int, f2 int").repartition(3)
    assert got(rolling.rolling_sum(triples, tuning=TINY), "f0", "f1", "f2") == sorted(expected)


def test_hot_keys_are_few(spark):
    rows = spark.range(2_000).selectExpr("id AS seq", "cast(id % 100 AS string) AS id")
    tuning = running.Tuning(rows_per_slice=5, min_hot_rows=1, max_hot_keys=10)
    assert running.hot_keys(rows, ["id"], "seq", tuning).count() == 0
    skewed = rows.selectExpr("seq", "if(seq % 3 = 0, 'x', id) AS id")
    assert [r[0] for r in running.hot_keys(skewed, ["id"], "seq", tuning).collect()] == ["x"]


def test_slices_follow_the_spread_of_the_order(spark):
    """Numbers far apart, such as clock readings, don't make a slice of every row."""
    rows = spark.range(2_000).selectExpr("id * 33554432 - 1000 AS seq", "id AS v")
    scans = {"best": running.running_max(running.F.col("v"), with_current=False)}
    tuning = running.Tuning(rows_per_slice=50)
    result = running.add_running(rows, [], "seq", scans, tuning=tuning, keep_slices=True)
    sizes = [r["count"] for r in result.groupBy(running.SLICE).count().collect()]
    assert max(sizes) <= 100 and len(sizes) <= 50
    assert result.filter("v > 0 AND best != v - 1 OR v = 0 AND best IS NOT NULL").isEmpty()
