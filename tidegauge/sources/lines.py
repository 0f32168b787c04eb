"""Lines of files that grow: each line is read once, when it is complete.

Spark's own file source takes a file whole when it first sees it. Here the place up to
which each file has been read is the stream's offset, so lines appended later come in
later batches, after a restart too. A line counts once its line feed is there. Long
stretches are dealt over tasks, each of which reads the lines that begin in its part.

The folder may be anywhere that Arrow's file systems reach (a path or a URI).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

NAME = "growing_lines"
PART_BYTES = 64 << 20
BLOCK_BYTES = 1 << 20
_SCHEMA = pa.schema([("value", pa.string())])


@dataclass
class Stretch(InputPartition):
    """The lines of a file that begin from ``start`` on and before ``end``; ``first`` begins a line."""

    path: str
    start: int
    end: int
    first: bool


def complete_bytes(system: fs.FileSystem, path: str, known: int, size: int) -> int:
    """Where the last complete line of a file ends, looked for from the end back to ``known``."""
    if size <= known:
        return known
    with system.open_input_file(path) as file:
        end = size
        while end > known:
            start = max(known, end - BLOCK_BYTES)
            file.seek(start)
            found = file.read(end - start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            end = start
    return known


def lines_of(system: fs.FileSystem, part: Stretch) -> Iterator[list[str]]:
    """The part's lines, a block at a time; the last may end beyond the part."""
    with system.open_input_file(part.path) as file:
        # from the byte before, which is a line feed if a line begins at the start
        at = part.start if part.first else part.start - 1
        file.seek(at)
        rest, skipping = b"", not part.first
        while at < part.end or rest or skipping:
            block = file.read(BLOCK_BYTES)
            if not block:
                return
            begins, data = at - len(rest), rest + block
            at += len(block)
            whole = data.rfind(b"\n") + 1
            rest = data[whole:]
            lines = data[:whole].split(b"\n")[:-1]
            if skipping and lines:
                begins, skipping = begins + len(lines.pop(0)) + 1, False
            kept = []
            for line in lines:
                if begins >= part.end:
                    break
                kept.append(line.decode("utf-8", "replace"))
                begins += len(line) + 1
            if kept:
                yield kept
            if begins >= part.end and not skipping:
                return


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, part_bytes: int) -> None:
        self.path, self.part_bytes = path, part_bytes

    def _system(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, folder = self._system()
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True))
        known = getattr(self, "_known", {})
        offsets = dict(known)
        for info in found:
            inside = info.path[info.path.find(folder) + len(folder) :].split("/")
            hidden = any(name.startswith((".", "_")) for name in inside)
            if info.type == fs.FileType.File and not hidden:
                offsets[info.path] = complete_bytes(system, info.path, known.get(info.path, 0), info.size)
        self._known = offsets
        return offsets

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        return [
            Stretch(path, at, min(at + self.part_bytes, last), at == start.get(path, 0))
            for path, last in sorted(end.items())
            for at in range(start.get(path, 0), last, self.part_bytes)
        ]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        for lines in lines_of(self._system()[0], partition):
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], schema=_SCHEMA)


class GrowingLines(DataSource):
    """Options: ``path``, the folder, and ``partBytes``, the most that one task reads."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options.get("partBytes", PART_BYTES)))


def stream_growing_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines appended to the files of a folder (``value``), stamped once with their arrival."""
    spark.dataSource.register(GrowingLines)
    lines = spark.readStream.format(NAME).options(**options).load(path)
    return lines.withColumn("arrival", F.current_timestamp())
