"""Chat turns of awkward input, through the formatter and back."""

import hashlib

import pytest
from oracle import connect, differences
from pyspark.sql import functions as F

from tidegauge.llm import chat, queries

ROWS = "conv_id bigint, turn bigint, role string, text string, record string, part string"
LONG = 25_000_000


def turns_of_rows(df):
    return chat.turns_of_column(df.select("conv_id", F.struct("turn", "role", "text").alias("record")))


def digests(turns):
    found = chat.conversation_digests(chat.read_back(chat.formatted(turns))).collect()
    return {r.conv_id: r for r in found}


def digest_of(*turns):
    return hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()


def test_query_equals_sql(spark, small):
    sql = queries.ORACLE_SQL["op4_chat_format"]
    assert differences(queries.op4_chat_format(spark, small), connect(small), sql) is None


@pytest.mark.parametrize("as_json", [False, True])
def test_very_long_turns(spark, as_json):
    rows = spark.range(1).select(
        F.lit(7).cast("bigint").alias("conv_id"),
        F.lit(0).cast("bigint").alias("turn"),
        F.lit("assistant").alias("role"),
        F.repeat(F.lit("x<s>é"), LONG // 5).alias("text"),
    )
    if as_json:
        record = F.to_json(F.struct("turn", "role", "text")).alias("record")
        turns = chat.canonical_turns(rows.select("conv_id", record))
    else:
        turns = turns_of_rows(rows)
    (found,) = digests(turns).values()
    text = "x<s>é" * (LONG // 5)
    assert found.loss_chars == LONG
    assert found.turns_sha256 == digest_of(("assistant", text))
    assert found.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_roles_of_rows_stay(spark):
    """Only layouts with role names of their own have them changed."""
    rows = [(1, 0, "human", "a", "", ""), (1, 1, "model", "b", "", ""), (1, 2, "assistant", "c", "", "")]
    found = digests(turns_of_rows(spark.createDataFrame(rows, ROWS)))[1]
    assert found.turns_sha256 == digest_of(("human", "a"), ("model", "b"), ("assistant", "c"))
    assert found.loss_chars == 1
    listed = [
        (1, '{"messages": [{"role": "human", "content": "q"}]}'),
        (2, '{"conversations": [{"from": "human", "value": "q"}, {"from": "sage", "value": "r"}]}'),
    ]
    turns = chat.canonical_turns(spark.createDataFrame(listed, "conv_id bigint, record string"))
    got = sorted((r.conv_id, r.turn, r.role) for r in turns.collect())
    assert got == [(1, 0, "human"), (2, 0, "user"), (2, 1, "sage")]


def test_equal_numbers_repeats_and_nulls(spark):
    """Turns of one number go by role and text; rows alike all count; a null id is one conversation."""
    rows = [
        (1, 5, "user", "b", "", ""), (1, 5, "user", "a", "", ""), (1, 5, "assistant", "z", "", ""),
        (1, 5, "user", "a", "", ""), (1, None, None, None, None, None),
        (None, 0, "user", "", "", ""), (None, 0, "user", None, "", ""),
    ]
    found = digests(turns_of_rows(spark.createDataFrame(rows, ROWS).repartition(3)))
    want = [("", ""), ("assistant", "z"), ("user", "a"), ("user", "a"), ("user", "b")]
    assert found[1].n_turns == 5 and found[1].turns_sha256 == digest_of(*want)
    assert found[None].n_turns == 2 and found[None].turns_sha256 == digest_of(("user", ""), ("user", ""))


def test_empty_table(spark):
    empty = spark.createDataFrame([], ROWS)
    assert digests(turns_of_rows(empty)) == {}
    assert digests(chat.canonical_turns(empty.select("conv_id", "record"))) == {}


def test_records_that_fit_no_mapping_are_kept(spark):
    records = [
        (1, '{"prompt": {"deep": 1}, "completion": "x"}'),
        (2, '{"prompt": "p", "completion": "c"'),
        (3, '{"turn": "not a number", "role": "user", "text": "t"}'),
        (4, '{"question": "q"}'),
    ]
    turns = chat.canonical_turns(spark.createDataFrame(records, "conv_id bigint, record string"))
    assert sorted((r.conv_id, r.role, r.text) for r in turns.collect()) == [
        (i, "unknown", record) for i, record in records
    ]
    odd = spark.createDataFrame([(1, ("q",))], "conv_id bigint, record struct<question: string>")
    assert [(r.role, r.text) for r in chat.turns_of_column(odd).collect()] == [("unknown", '{"question":"q"}')]
