"""Arrow batches as NumPy arrays: text bytes, words and their hashes.

A task sees a batch of rows as one byte array and offsets into it, so the cost of
Python is paid per batch rather than per row. Work goes in pieces of a few
megabytes of text; only a single longer text makes a longer piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

PIECE = 2 << 20

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)
# the complement of \x00-\x2F \x3A-\x60 \x7B-\x7F once A-Z are lower case
WORD = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))

_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_STEP), -1, 1 << 64))


def map_partitions(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str | StructType
) -> DataFrame:
    """Apply ``task`` to the batches of each partition; it yields columns by name."""
    to = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in task(batches):
            arrays = [as_array(columns[f.name], f.type) for f in to]
            yield pa.RecordBatch.from_arrays(arrays, schema=to)
        pa.default_memory_pool().release_unused()  # the worker stays, for other tasks

    return df.mapInArrow(run, schema)


def map_arrow(
    df: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[dict]], schema: str | StructType
) -> DataFrame:
    """Apply ``rows`` to each batch; it yields columns by name."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from rows(batch)

    return map_partitions(df, task, schema)


def as_array(values: object, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values.cast(kind)
    if isinstance(values, np.ndarray) and values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, type=kind)


def values(column: pa.Array, rows: int = 256) -> Iterator[object]:
    """Values of a column as Python objects, of a few rows at a time."""
    for first in range(0, len(column), rows):
        yield from column.slice(first, rows).to_pylist()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row begins and ends; null: empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    size = int(offsets[-1])
    whole = np.frombuffer(data, np.uint8, size) if data is not None and size else np.empty(0, np.uint8)
    return whole[offsets[0] :], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``size`` bytes each, at least one row."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit hash over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * _ODD
    h = h ^ (h >> np.uint64(29))
    h = h * _STEP
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of the hash multiplier and of its inverse, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = -(-n >> 18) << 18
            one = np.ones(n, np.uint64)
            one[1:] = _STEP
            cls.up = np.cumprod(one)
            one[1:] = _INVERSE
            cls.down = np.cumprod(one)
        return cls.up, cls.down


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_hash`` gets the hash of any span of ``data``."""
    up, _ = Powers.upto(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = Powers.upto(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


@dataclass
class Words:
    """The lower-case words of rows ``first`` to ``last`` of a batch."""

    first: int
    last: int
    data: np.ndarray  # bytes, A-Z lower-cased
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray  # of each word, counted from the first row of the batch
    hash: np.ndarray

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and where they are of one row."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, bool)
        h = np.zeros(n, np.uint64)
        for j in range(k):
            h = h * _ODD + self.hash[j : j + n]
        return mixed(h + np.uint64(k)), self.row[:n] == self.row[k - 1 :]

    def counts(self) -> np.ndarray:
        """Words of each row."""
        return np.bincount(self.row - self.first, minlength=self.last - self.first)


def words(column: pa.Array, kind: np.ndarray = WORD, size: int = PIECE) -> Iterator[Words]:
    """Words of whole texts, A-Z lower-cased: runs of the bytes that ``kind`` marks.

    The default is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Texts of about ``size`` bytes
    are looked at together.
    """
    whole, offsets = utf8(column)
    for first, last in pieces(offsets, size):
        at = offsets[first : last + 1] - offsets[first]
        data = LOWER[whole[offsets[first] : offsets[last]]]
        inside = kind[data]
        full = at[1:] > at[:-1]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        heads, tails = at[:-1][full], at[1:][full] - 1
        begins[heads] = inside[heads]
        ends[tails] = inside[tails]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        row = np.searchsorted(at, start, "right") - 1 + first
        yield Words(first, last, data, start, end, row, span_hash(prefix_hash(data), start, end))
