"""User functions in Python, for what no column expression can say.

Rows travel to Python as Arrow batches. An aggregate is folded where its rows are, and
only the folded parts are shuffled; a function of a whole window is given the window's
batches one after the other, never one frame of them all.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, DataType, StructField, StructType

# Keys a task folds at once; beyond that it hands on what it has and starts anew.
KEYS_AT_ONCE = 1 << 16
ROWS_AT_ONCE = 1 << 14
_STATE = "_state"

Key = tuple[Any, ...]
WindowFunction = Callable[[Key, Iterator[pa.RecordBatch]], Iterable[tuple]]


class Aggregator(Protocol):
    """A mergeable accumulator. ``add`` gets the input columns of a row."""

    def create(self) -> Any: ...

    def add(self, state: Any, *values: Any) -> Any: ...

    def merge(self, one: Any, other: Any) -> Any: ...

    def result(self, state: Any) -> tuple: ...


def _fields(df: DataFrame, columns: Sequence[str]) -> list[StructField]:
    return [df.schema[c] for c in columns]


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def made() -> pa.RecordBatch:
        columns = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
        )

    for row in rows:
        held.append(tuple(row))
        if len(held) >= ROWS_AT_ONCE:
            yield made()
            held.clear()
    if held:
        yield made()


def _rows(batch: pa.RecordBatch, columns: Sequence[str]) -> Iterator[tuple]:
    return zip(*[batch.column(c).to_pylist() for c in columns], strict=True)


def map_values(function: Callable, kind: DataType | str) -> Callable[..., Column]:
    """A function of one row's values as a column function."""
    return F.udf(function, kind, useArrow=True)


def flat_map(
    df: DataFrame, function: Callable[..., Iterable[tuple]], inputs: Sequence[str], schema: str
) -> DataFrame:
    """The rows that ``function`` makes of the inputs of each row, beside all columns of that row."""

    class Made:
        def eval(self, *values):
            yield from function(*values)

    made = F.udtf(Made, returnType=schema, useArrow=True)
    return df.lateralJoin(made(*[F.col(c).outer() for c in inputs]))


def aggregate(
    df: DataFrame, keys: Sequence[str], aggregator: Aggregator, inputs: Sequence[str], schema: str
) -> DataFrame:
    """The keys and the aggregator's results per group of equal keys.

    A key has one folded part per task, so a busy one is no more work for one task than
    others. Accumulators travel as bytes.
    """
    keys, inputs = list(keys), list(inputs)
    parts = StructType([*_fields(df, keys), StructField(_STATE, BinaryType())])
    whole = StructType([*_fields(df, keys), *StructType.fromDDL(schema).fields])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = to_arrow_schema(parts)
        states: dict[Key, Any] = {}

        def told() -> Iterator[pa.RecordBatch]:
            yield from _batches(((*k, pickle.dumps(s)) for k, s in states.items()), to)

        for batch in batches:
            for row in _rows(batch, [*keys, *inputs]):
                key, values = row[: len(keys)], row[len(keys) :]
                state = states[key] if key in states else aggregator.create()
                states[key] = aggregator.add(state, *values)
            if len(states) >= KEYS_AT_ONCE:
                yield from told()
                states = {}
        yield from told()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for batch in batches for row in _rows(batch, [*keys, _STATE]))
        yield from _batches(map(merged, groupby(found, lambda row: row[:-1])), to_arrow_schema(whole))

    def merged(group: tuple[Key, Iterator[tuple]]) -> tuple:
        key, rows = group
        state = pickle.loads(next(rows)[-1])
        for row in rows:
            state = aggregator.merge(state, pickle.loads(row[-1]))
        return (*key, *aggregator.result(state))

    folded = df.select(*keys, *[c for c in inputs if c not in keys]).mapInArrow(fold, parts)
    return folded.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, whole)


def apply_windows(
    df: DataFrame,
    keys: Sequence[str],
    function: WindowFunction,
    inputs: Sequence[str],
    schema: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """The keys and the rows that ``function`` makes of each group of equal keys.

    It gets the key and an iterator over Arrow batches of the inputs, in ``order``; what
    it doesn't read is skipped. A group is one task's, as its function must see all of
    it, but no more than a batch of it is held. Prefer ``aggregate`` where parts can be
    merged.
    """
    keys, inputs = list(keys), list(inputs)
    whole = StructType([*_fields(df, keys), *StructType.fromDDL(schema).fields])
    columns = list(dict.fromkeys([*keys, *inputs, *order]))

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[Key, pa.RecordBatch]]:
        """Stretches of one key; rows come sorted by key."""
        told, start = list(_rows(batch, keys)), 0
        own = batch.select(inputs)
        for end in range(1, len(told) + 1):
            if end == len(told) or told[end] != told[start]:
                yield told[start], own.slice(start, end - start)
                start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (r for batch in batches for r in runs(batch))

        def rows() -> Iterator[tuple]:
            for key, group in groupby(found, lambda r: r[0]):
                for row in function(key, (part for _, part in group)):
                    yield *key, *row

        yield from _batches(rows(), to_arrow_schema(whole))

    placed = df.select(*columns).repartition(*keys).sortWithinPartitions(*keys, *order)
    return placed.mapInArrow(run, whole)
