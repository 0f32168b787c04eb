"""Every registered query against its SQL oracle, and known row counts."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry

QUERIES = entry._own_queries()
ORACLE = entry.oracle_sql()
BATCH = [n for n in QUERIES if not n.startswith("stream_")]
LIVE = [n for n in QUERIES if n.startswith("stream_")]


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_each_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", BATCH)
def test_batch_query(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", LIVE)
def test_live_query(spark, small, con, name):
    assert differences(QUERIES[name](spark, small), con, ORACLE[name]) is None


@pytest.mark.parametrize(
    ("name", "rows"),
    [
        ("late_messages", 1_720),
        ("late_window_rows", 143),
        ("late_update_counts", 6_525 + 78),
        ("self_cleaning_alerts", 8_641),
        ("switch_forward", 2_849),
        ("fire_alerts", 376),
        ("rise_warnings", 764),
        ("early_fire_counts", 4_539),
    ],
)
def test_known_row_counts(spark, medium, name, rows):
    assert QUERIES[name](spark, medium).count() == rows


@pytest.mark.parametrize(
    ("one", "other"),
    [
        ("filter_gt", "filter_ge"),
        ("round_half_up", "round_half_down"),
        ("split_words_java", "split_words_ws"),
        ("word_count_java", "word_count_ws"),
    ],
)
def test_modes_can_be_told_apart(medium, one, other):
    both = connect(medium)
    rows = [both.sql(ORACLE[name]).fetchall() for name in (one, other)]
    assert sorted(rows[0]) != sorted(rows[1])


def test_steps_show_late_updates_and_cleaned_rows(medium):
    both = connect(medium)
    tags = both.sql(f"SELECT DISTINCT tag FROM ({ORACLE['stream_late_update_counts']})").fetchall()
    assert {t for t, in tags} == {"first", "update"}
    count = f"SELECT count(*) FROM ({ORACLE['stream_self_cleaning_alerts']})"
    kept, = both.sql(count).fetchall()[0]
    every, = both.sql(f"SELECT count(*) FROM ({ORACLE['temp_change_alerts']})").fetchall()[0]
    assert kept < 0.95 * every


def test_entry(spark):
    result = entry.entry(spark)
    assert set(result.columns) == {"id", "end_ts", "cnt", "tag"}
    assert result.count() > 0
