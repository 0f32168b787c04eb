"""Opaque Python functions against their built-in twins."""

import re

import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from test_operators import frame, stream

import __spark_entry__ as entry
from tidegauge.functions import opaque
from tidegauge.functions.timeops import window_end
from tidegauge.operators import windows


@pytest.fixture(scope="module")
def placed(spark):
    rows = [(s, None if k == "k1" else k, t, v) for s, k, t, v in stream(n=300, seed=41)]
    return frame(spark, rows).withColumn("end_ts", window_end(F.col("timestamp"), 5_000))


def rows_of(df, *columns):
    return sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))


@pytest.mark.parametrize("at_once", [opaque.KEYS_AT_ONCE, 2])
def test_mergeable_aggregate(placed, at_once, monkeypatch):
    """Also where a task hands on its parts early; null keys are a group."""
    monkeypatch.setattr(opaque, "KEYS_AT_ONCE", at_once)
    mean = opaque.aggregate(
        placed, ["id", "end_ts"], entry.MeanOf(), ["temperature"], "temperature double"
    )
    want = windows.window_avg(placed.drop("end_ts"), 5_000)
    columns = ["id", "end_ts", F.round("temperature", 9).alias("t")]
    assert rows_of(mean, *columns) == rows_of(want, *columns)


def test_only_parts_are_shuffled(placed):
    mean = opaque.aggregate(placed, ["id"], entry.MeanOf(), ["temperature"], "temperature double")
    text = mean._jdf.queryExecution().executedPlan().toString()
    keyed = re.findall(r"Exchange hashpartitioning\(id", text)
    assert len(keyed) == 1 and text.index("Exchange hashpartitioning(id") > text.index("MapInArrow")
    assert text.count("MapInArrow") == 2


def test_window_function_gets_batches_in_order(spark):
    """A window of a million rows comes in many batches, none of them large."""
    n = 1_000_000
    readings = spark.range(n).select(
        F.when(F.col("id") < n - 5, "hot").alias("id"), F.lit(10).cast("bigint").alias("end_ts"),
        F.col("id").alias("seq"), (F.col("id") * 7919 % 1009).cast("double").alias("temperature"),
    ).repartition(4)

    def summary(key, batches):
        low, high, n, parts, largest, last = float("inf"), float("-inf"), 0, 0, 0, -1
        for batch in batches:
            low = min(low, pc.min(batch.column("temperature")).as_py())
            high = max(high, pc.max(batch.column("temperature")).as_py())
            seqs = batch.column("seq").to_pylist()
            assert seqs == sorted(seqs) and seqs[0] > last
            last = seqs[-1]
            n, parts, largest = n + len(seqs), parts + 1, max(largest, len(seqs))
        yield low, high, n, parts, largest

    found = opaque.apply_windows(
        readings, ["id", "end_ts"], summary, ["seq", "temperature"],
        "low double, high double, n bigint, parts bigint, largest bigint", ["seq"],
    )
    got = {r.id: r for r in found.collect()}
    assert (got["hot"].low, got["hot"].high, got["hot"].n) == (0.0, 1008.0, n - 5)
    assert got["hot"].parts >= 50 and got["hot"].largest <= 20_000
    assert got[None].n == 5


def test_window_function_need_not_read_all(placed):
    def first(key, batches):
        yield (next(batches).column("seq")[0].as_py(),)

    def nothing(key, batches):
        return ()

    got = opaque.apply_windows(placed, ["id"], first, ["seq"], "first bigint", ["seq"])
    want = placed.groupBy("id").agg(F.min("seq").alias("first"))
    assert rows_of(got, "id", "first") == rows_of(want, "id", "first")
    assert opaque.apply_windows(placed, ["id"], nothing, ["seq"], "first bigint").count() == 0


def test_flat_map_keeps_the_row(spark):
    df = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "n int, value string")
    made = opaque.flat_map(df, lambda v: [(w, len(w)) for w in (v or "").split()], ["value"], "word string, size int")
    assert rows_of(made, "n", "value", "word", "size") == rows_of(
        spark.createDataFrame([(1, "a b", "a", 1), (1, "a b", "b", 1)], "n int, value string, word string, size int"),
        "n", "value", "word", "size",
    )


def test_empty_input(placed):
    none = placed.filter("false")
    assert opaque.aggregate(none, ["id"], entry.MeanOf(), ["temperature"], "t double").count() == 0
    assert opaque.apply_windows(none, ["id"], lambda k, b: [(1,)], ["seq"], "n bigint").count() == 0
