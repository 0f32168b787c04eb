"""Chat formatting by schema fingerprint.

Records come in many layouts: rows of one turn, prompt and completion,
instruction and output, lists of messages. The sorted nested field paths of a
record, as far as any layout knows them, are hashed; the hash selects a
declarative mapping (a schema and an expression) that gives canonical turns.
Formatting is per turn, so a conversation of any length stays rows: the formatted
conversation is the pieces of its turns in order.

The template marks a turn as ``<|turn|>role`` newline text ``<|end|>`` newline.
Control strings inside roles and texts are broken by a backslash after their
first character, backslashes are doubled; a reader undoes both.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from tidegauge.llm.batches import map_partitions

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
# fixed values: control strings of common templates, by their beginnings
CONTROLS = ("<|", "<s>", "</s>", "<<SYS", "<</SYS", "[INST]", "[/INST]")
TURNS = "array<struct<turn:bigint,role:string,text:string>>"
UNKNOWN = "unknown"
_BROKEN = "_broken"
# a text may be as long as a string can be
_JSON = {"columnNameOfCorruptRecord": _BROKEN, "maxStringLen": str(2**31 - 1)}


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths, how to parse a record, and the turns it holds (SQL over ``r``).

    ``renamed`` layouts have role names of their own, which become the usual ones.
    """

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: str
    renamed: bool = False


def _listed(field: str, role: str, text: str) -> str:
    return (
        f"transform(r.{field}, (m, i) -> named_struct("
        f"'turn', CAST(i AS BIGINT), 'role', m.`{role}`, 'text', m.`{text}`))"
    )


def _said(*turns: tuple[str, str]) -> str:
    return "array(" + ", ".join(
        f"named_struct('turn', {i}L, 'role', '{role}', 'text', {text})"
        for i, (role, text) in enumerate(turns)
    ) + ")"


MAPPINGS = (
    Mapping(
        "turn rows",
        ("role", "text", "turn"),
        "turn bigint, role string, text string",
        "array(named_struct('turn', r.turn, 'role', r.role, 'text', r.text))",
    ),
    Mapping(
        "prompt and completion",
        ("completion", "prompt"),
        "prompt string, completion string",
        _said(("user", "r.prompt"), ("assistant", "r.completion")),
    ),
    Mapping(
        "system, prompt and completion",
        ("completion", "prompt", "system"),
        "system string, prompt string, completion string",
        _said(("system", "r.system"), ("user", "r.prompt"), ("assistant", "r.completion")),
    ),
    Mapping(
        "instruction and output",
        ("instruction", "output"),
        "instruction string, output string",
        _said(("user", "r.instruction"), ("assistant", "r.output")),
    ),
    Mapping(
        "instruction, input and output",
        ("input", "instruction", "output"),
        "instruction string, input string, output string",
        _said(
            ("user", "concat_ws('\\n\\n', r.instruction, nullif(r.input, ''))"),
            ("assistant", "r.output"),
        ),
    ),
    Mapping(
        "messages",
        ("messages[].content", "messages[].role"),
        "messages array<struct<role:string,content:string>>",
        _listed("messages", "role", "content"),
    ),
    Mapping(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        "conversations array<struct<`from`:string,value:string>>",
        _listed("conversations", "from", "value"),
        renamed=True,
    ),
)
KNOWN = frozenset(p for m in MAPPINGS for p in m.paths)
# fixed values: role names of layouts that have their own
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: object) -> str:
    """The hash of a set of field paths; paths that no layout knows don't count."""
    return hashlib.sha256("\n".join(sorted(KNOWN.intersection(paths))).encode()).hexdigest()


def field_paths(value: object, at: str = "") -> Iterator[str]:
    """Nested field paths of a parsed record; ``[]`` stands for any element of a list."""
    if isinstance(value, dict):
        for key, inner in value.items():
            yield from field_paths(inner, f"{at}.{key}" if at else key)
    elif isinstance(value, list):
        for inner in value:
            yield from field_paths(inner, f"{at}[]")
    else:
        yield at


@F.pandas_udf(StringType())
def layout_of(records: pd.Series) -> pd.Series:
    """Fingerprint of each JSON record; of no path if it can't be parsed."""

    def one(record: str | None) -> str:
        try:
            return fingerprint(field_paths(json.loads(record)))
        except (TypeError, ValueError, RecursionError):
            return fingerprint(())

    return records.map(one)


def schema_paths(kind: DataType, at: str = "") -> Iterator[str]:
    """The nested field paths of a column's type, as ``field_paths`` gives those of a record."""
    if isinstance(kind, StructType):
        for field in kind.fields:
            yield from schema_paths(field.dataType, f"{at}.{field.name}" if at else field.name)
    elif isinstance(kind, ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def _unknown(record: str) -> Column:
    return F.expr(f"array(named_struct('turn', 0L, 'role', '{UNKNOWN}', 'text', {record}))").cast(TURNS)


def _turns(mapping: Mapping, field: str) -> Column:
    turns = F.expr(mapping.turns.replace("r.", f"{field}.")).cast(TURNS)
    if not mapping.renamed:
        return turns
    names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    return F.transform(
        turns,
        lambda t: F.struct(t.turn.alias("turn"), F.coalesce(names[t.role], t.role).alias("role"), t.text.alias("text")),
    )


def _exploded(records: DataFrame, turns: Column) -> DataFrame:
    return records.select("conv_id", F.posexplode(turns).alias("part", "t")).select(
        "conv_id",
        "t.turn",
        "part",
        F.coalesce("t.role", F.lit("")).alias("role"),
        F.coalesce("t.text", F.lit("")).alias("text"),
    )


def turns_of_column(records: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, part, role, text) from rows (conv_id, record), a struct column.

    All records of a column have its fields, so one mapping fits all; texts are not
    parsed and may have any length. A column of no known layout becomes turns of role
    ``unknown`` that hold the records as JSON.
    """
    layout = fingerprint(schema_paths(records.schema["record"].dataType))
    for mapping in MAPPINGS:
        if layout == fingerprint(mapping.paths):
            return _exploded(records, _turns(mapping, "record"))
    return _exploded(records, _unknown("to_json(record)"))


def canonical_turns(records: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, part, role, text) from JSON rows (conv_id, record).

    ``part`` is the place of a turn in its record. A record that can't be parsed, or is
    of no known layout, becomes one turn of role ``unknown`` that holds the record, so
    nothing is lost. Null roles and texts become empty strings.
    """
    known = records.select("conv_id", "record", layout_of("record").alias("layout"))
    turns = _unknown("record")
    for m in MAPPINGS:
        field = "r_" + m.name.replace(" ", "_").replace(",", "")
        own = F.col("layout") == fingerprint(m.paths)
        parsed = F.from_json("record", f"{m.schema}, {_BROKEN} string", _JSON)
        known = known.withColumn(field, F.when(own, parsed))
        whole = F.col(field).isNotNull() & F.col(f"{field}.{_BROKEN}").isNull()
        turns = F.when(own & whole, _turns(m, field)).otherwise(turns)
    return _exploded(known, turns)


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def formatted(turns: DataFrame) -> DataFrame:
    """Adds ``piece`` and its loss mask (``loss_start`` from 0, ``loss_len``, in code points).

    The mask covers the texts of assistant turns; other turns have length 0.
    """
    # a newline in a role would end the head of the turn
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = escaped(F.col("text"))
    masked = F.when(F.col("role") == "assistant", F.char_length(body)).otherwise(0)
    return turns.select(
        "conv_id",
        "turn",
        "part",
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.char_length(head).alias("loss_start"),
        masked.alias("loss_len"),
    )


def read_back(pieces: DataFrame) -> DataFrame:
    """Role, text and text under the loss mask, from the pieces alone."""
    role = r"^<\|turn\|>((?:[^\\\n]|\\[\s\S])*+)\n"
    inner = F.regexp_replace(F.regexp_replace("piece", role, ""), r"<\|end\|>\n$", "")
    masked = F.substring("piece", F.col("loss_start") + 1, F.col("loss_len"))
    return pieces.withColumns(
        {
            "role": unescaped(F.regexp_extract("piece", role, 1)),
            "text": unescaped(inner),
            "loss_text": unescaped(masked),
        }
    )


def conversation_digests(read: DataFrame) -> DataFrame:
    """One row per conversation, hashed turn by turn.

    A hash needs the turns of a conversation in order, so they meet in one task; it
    holds one digest at a time, however long the conversation. Turns of the same
    number go by their role and text. A null ``conv_id`` is one conversation.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current: list = []
        out: dict[str, list] = {}

        def close() -> None:
            conv, n, turns, chars, loss, size = current
            for name, value in zip(
                ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"),
                (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size),
                strict=True,
            ):
                out.setdefault(name, []).append(value)

        for batch in batches:
            for row in batch.to_pylist():
                if not current or current[0] != row["conv_id"]:
                    if current:
                        close()
                    current = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                current[1] += 1
                current[2].update(f"{row['role']}\n{row['text']}\n".encode())
                current[3] += len(row["loss_text"])
                current[4].update(row["loss_text"].encode())
                current[5] += row["formatted"]
            if out:
                yield dict(out)
                out.clear()
        if current:
            close()
            yield dict(out)

    ordered = (
        read.select(
            "conv_id", "turn", "part", "role", "text", "loss_text", F.char_length("piece").alias("formatted")
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "part", "role", "text")
    )
    schema = (
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint"
    )
    return map_partitions(ordered, task, schema)
