"""Lines of growing files, read once each."""

import random
from pathlib import Path

import pytest
from pyarrow import fs

from tidegauge.session import shared_folder
from tidegauge.sources import lines


def appended(path, text):
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    with open(path, "ab") as file:
        file.write(text.encode())


@pytest.mark.parametrize("part_bytes", [1, 3, 7, 1000])
def test_parts_give_each_line_once(tmp_path, part_bytes, monkeypatch):
    """Whatever the parts and blocks: empty lines, lines longer than a part, no last line feed."""
    monkeypatch.setattr(lines, "BLOCK_BYTES", 4)
    rng = random.Random(part_bytes)
    said = ["".join(rng.choices("aé", k=rng.choice([0, 1, 2, 9]))) for _ in range(40)]
    path = str(tmp_path / "a.txt")
    appended(path, "\n".join(said) + "\nnot yet")
    system = fs.LocalFileSystem()
    size = Path(path).stat().st_size
    last = lines.complete_bytes(system, path, 0, size)
    assert last == size - len("not yet")
    reader = lines._Reader(str(tmp_path), part_bytes)
    parts = reader.partitions({}, {path: last})
    assert [line for p in parts for block in lines.lines_of(system, p) for line in block] == said
    middle = len("\n".join(said[:10]).encode()) + 1
    parts = reader.partitions({path: middle}, {path: last})
    assert [line for p in parts for block in lines.lines_of(system, p) for line in block] == said[10:]


def test_appended_lines_come_once(spark):
    folder = shared_folder(spark, "growing")

    def run():
        live = lines.stream_growing_lines(spark, f"{folder}/in", partBytes="5")
        assert live.columns == ["value", "arrival"]
        query = (
            live.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp")
            .trigger(availableNow=True).start(f"{folder}/out")
        )
        query.awaitTermination()
        return sorted(r.value for r in spark.read.parquet(f"{folder}/out").collect())

    appended(f"{folder}/in/a.txt", "one\ntwo\nthr")
    appended(f"{folder}/in/b.txt", "")
    assert run() == ["one", "two"]
    appended(f"{folder}/in/a.txt", "ee\nfour\n")
    appended(f"{folder}/in/b.txt", "\nfive\n")
    appended(f"{folder}/in/_hidden.txt", "no\n")
    assert run() == ["", "five", "four", "one", "three", "two"]
    assert run() == ["", "five", "four", "one", "three", "two"]
    stamped = spark.read.parquet(f"{folder}/out")
    assert stamped.filter("arrival IS NULL").count() == 0
    assert stamped.select("arrival").distinct().count() == 2
