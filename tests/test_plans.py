"""Plans keep what makes them scale."""

import re

import pytest

import __spark_entry__ as entry

QUERIES = entry._own_queries()


def plan(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream_", "opaque_"))])
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(spark, small, name)
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_filter_and_columns_reach_the_scan(spark, small):
    text = plan(spark, small, "filter_project_split")
    assert "GreaterThan(value,25.0)" in text
    assert "ReadSchema: struct<user_id:bigint,value:double>" in text
    text = plan(spark, small, "fire_alerts")
    assert "GreaterThan(value,100.0)" in text


def test_windows_aggregate_before_the_shuffle(spark, small):
    text = plan(spark, small, "tumbling_minmax")
    assert len(re.findall(r"\bExchange\b", text)) == 1
    assert "partial_min" in text and "partial_max" in text


@pytest.mark.parametrize(
    ("name", "keyed"),
    [
        ("temp_change_alerts", True),
        ("switch_forward", True),
        ("late_update_counts", False),
        ("early_fire_counts", False),
        ("fire_alerts", False),
    ],
)
def test_only_hot_keys_are_broadcast(spark, small, name, keyed):
    """By hint, that is: with automatic broadcasts off."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, small, name)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("BroadcastExchange") == text.count("AS _width")
    assert ("BroadcastExchange" in text) == keyed


def test_rows_are_shuffled_once_per_order(spark, small):
    """The carried values are joined on the partitioning the scan left behind."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(spark, small, "temp_change_alerts").splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[join].index("SortMergeJoin")
    below = [line for line in lines[join + 1:] if len(line) > depth]
    window = next(i for i, line in enumerate(below) if "Window" in line)
    assert not any("Exchange" in line or "Sort " in line for line in below[:window])
