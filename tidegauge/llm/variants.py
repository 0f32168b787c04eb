"""Spelling variants by k-d trees over letter counts.

A word is a point: how often each letter occurs in it. One inserted letter raises
one count by one, a replaced letter raises one and lowers another, so the words one
edit away lie in a small box around the point: up to one count higher for a word one
letter longer, one lower for a shorter one, one of each at the same length. Per
length a k-d tree, grown on a bounded sample of the words, cuts the space into cells;
a word lies in one cell and asks all cells its boxes reach. Within a cell a finer
tree over all its words prunes again, and the order of letters is compared for what
is left. Only sums and the best neighbour of a word leave a cell, never pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.batches import LOWER, map_partitions
from tidegauge.session import materialize

NOISE = 97  # a run is misspelt where this divides its hash
MIN_LETTERS = 5
MIN_OCCURRENCES = 3
# Words that the upper trees are grown on, and the most of them in one cell.
SAMPLE_WORDS = 1 << 16
SAMPLE_PER_CELL = 64
# Words of one cell in one task; a larger cell is dealt into blocks that all its askers visit.
BLOCK_WORDS = 1 << 17
LEAF_WORDS = 16
ASKED_AT_ONCE = 1 << 13
PAIR_BYTES = 1 << 22
COUNTED_AT_ONCE = 1 << 18
# a to z, and all other letters in six groups: fewer counts only widen a box
LETTERS = 32

_RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
_BYTES_LOWER = LOWER.tobytes()


def noisy(doc_id: str, run: str) -> str:
    """The lower-case run, less one letter where its hash says so."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{doc_id}:".encode()))
    if h % NOISE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(
    documents: DataFrame,
    id_col: str = "doc_id",
    min_letters: int = MIN_LETTERS,
    min_occurrences: int = MIN_OCCURRENCES,
) -> DataFrame:
    """Rows (word, n): the words of all texts with their occurrences.

    A null text has no runs; a null id counts as the empty text. Tasks count words
    before the shuffle, at most ``COUNTED_AT_ONCE`` different ones at a time.
    """

    def told(counts: Counter) -> dict:
        return {"word": list(counts), "n": list(counts.values())}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        counts: Counter = Counter()
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                lower = (text or "").encode().translate(_BYTES_LOWER).decode()
                for run, n in Counter(_RUN.findall(lower)).items():
                    word = noisy(doc_id or "", run)
                    if len(word) >= min_letters:
                        counts[word] += n
                if len(counts) >= COUNTED_AT_ONCE:
                    yield told(counts)
                    counts = Counter()
        yield told(counts)

    texts = documents.select(F.col(id_col).cast("string").alias("id"), "text")
    counted = map_partitions(texts, task, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_occurrences)


def points_of(words: list[str]) -> np.ndarray:
    """Letter counts of each word; counts past 127 are 127, which only widens a box."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where((codes >= 97) & (codes <= 122), codes - 97, 26 + codes % (LETTERS - 26))
    at = np.repeat(np.arange(len(words)), size) * LETTERS + letter
    counts = np.bincount(at, minlength=len(words) * LETTERS)
    return np.minimum(counts, 127).reshape(len(words), LETTERS).astype(np.int8)


def letters_of(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters, all of which are single bytes in Latin-1."""
    said = "".join(words).encode("latin-1")
    return np.frombuffer(said, np.uint8).reshape(len(words), len(words[0]))


@dataclass
class Box:
    """A node of a k-d tree: the box around its points, and its parts or its points."""

    low: np.ndarray
    high: np.ndarray
    parts: tuple[Box, Box] | None
    members: np.ndarray


def grown(points: np.ndarray, most: int, members: np.ndarray | None = None) -> Box:
    """A k-d tree of tight boxes, cut at the middle of the widest count.

    A leaf has at most ``most`` points unless they are all the same.
    """
    members = np.arange(len(points)) if members is None else members
    own = points[members]
    low, high = own.min(0), own.max(0)
    if len(members) > most and (low < high).any():
        spread = own.std(0)
        spread[low == high] = -1
        axis = int(spread.argmax())
        values = own[:, axis]
        cut = min(int(np.median(values)), int(high[axis]) - 1)
        left = values <= cut
        parts = grown(points, most, members[left]), grown(points, most, members[~left])
        return Box(low, high, parts, members)
    return Box(low, high, None, members)


def reached(box: Box, asked: np.ndarray, rows: np.ndarray, up: int, down: int) -> Iterator[tuple[Box, np.ndarray]]:
    """The leaves within reach of the points asked for, with the rows that reach each.

    In reach is what ``up`` counts more and ``down`` counts less can lead to.
    """
    own = asked[rows]
    higher = np.maximum(box.low - own, 0).sum(1)
    lower = np.maximum(own - box.high, 0).sum(1)
    rows = rows[(higher <= up) & (lower <= down)]
    if not len(rows):
        return
    if box.parts is None:
        yield box, rows
        return
    for part in box.parts:
        yield from reached(part, asked, rows, up, down)


def steps(longer_by: int) -> tuple[int, int]:
    """Counts up and down from a word to one that is longer by -1, 0 or 1."""
    return (1, 1) if not longer_by else (max(longer_by, 0), max(-longer_by, 0))


class Cells:
    """The upper trees, one per length: which cell a point lies in, and which it reaches.

    The cells of a tree cover the whole space: sample words only say where it is cut.
    A length without sample words is one cell.
    """

    def __init__(self, sample: list[str], per_cell: int = SAMPLE_PER_CELL) -> None:
        of_length: dict[int, list[str]] = {}
        for word in sample:
            of_length.setdefault(len(word), []).append(word)
        self.cuts = {n: self._cut(points_of(words), per_cell) for n, words in of_length.items()}

    def _cut(self, points: np.ndarray, per_cell: int) -> list[tuple[int, int, int, int]]:
        """Nodes (axis, cut, left, right); a leaf has axis -1 and its number as cut."""
        nodes: list[tuple[int, int, int, int]] = []
        leaves = 0

        def add(box: Box) -> int:
            nonlocal leaves
            at = len(nodes)
            nodes.append((-1, leaves, 0, 0))
            if box.parts is None:
                leaves += 1
                return at
            left, right = box.parts
            axis = int(np.flatnonzero(left.high < right.low)[0])
            cut = int(left.high[axis])
            nodes[at] = axis, cut, add(left), add(right)
            return at

        add(grown(points, per_cell))
        return nodes

    def of(self, length: int, points: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Cells of the tree of that length in reach, each with the rows of ``points`` that reach it.

        The counts allowed are spent on the cuts that are crossed.
        """
        nodes = self.cuts.get(length, [(-1, 0, 0, 0)])
        n = len(points)
        waiting = [(0, np.arange(n), np.full(n, up), np.full(n, down), points)]
        while waiting:
            at, rows, more, less, where = waiting.pop()
            axis, cut, left, right = nodes[at]
            if axis < 0:
                yield cut, rows
                continue
            values = where[:, axis]
            for part, target, spent in (
                (left, np.minimum(values, cut), less),
                (right, np.maximum(values, cut + 1), more),
            ):
                cost = np.abs(values - target)
                go = cost <= spent
                if go.any():
                    moved = where[go].copy()
                    moved[:, axis] = target[go]
                    waiting.append((
                        part, rows[go],
                        (more - cost)[go] if part == right else more[go],
                        (less - cost)[go] if part == left else less[go],
                        moved,
                    ))


def one_edit(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which rows of letters are one edit apart; the second are as long or one longer."""
    n = one.shape[1]
    if other.shape[1] == n:
        return (one != other).sum(1) == 1
    same = one == other[:, :n]
    begin = np.where(same.all(1), n, same.argmin(1))
    return ((one == other[:, 1:]) | (np.arange(n) < begin[:, None])).all(1)


def _visits(words: DataFrame, cells: Cells) -> DataFrame:
    """Rows (length, cell, asks, word, n): each word in its cell, and at each cell it asks."""
    shared = words.sparkSession.sparkContext.broadcast(cells)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            said, counts = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
            size = np.fromiter(map(len, said), np.int64, len(said))
            for length in np.unique(size).tolist():
                rows = np.flatnonzero(size == length)
                points = points_of([said[i] for i in rows])
                for asks, longer_by in ((False, 0), (True, -1), (True, 0), (True, 1)):
                    up, down = steps(longer_by) if asks else (0, 0)
                    for cell, of in shared.value.of(length + longer_by, points, up, down):
                        here = rows[of]
                        yield {
                            "length": np.full(len(here), length + longer_by),
                            "cell": np.full(len(here), cell),
                            "asks": np.full(len(here), asks),
                            "word": [said[i] for i in here],
                            "n": counts[here],
                        }

    return map_partitions(words, task, "length int, cell int, asks boolean, word string, n bigint")


def _dealt(visits: DataFrame, block_words: int) -> DataFrame:
    """The visits with a block; cells of more than ``block_words`` words have several."""
    sizes = visits.filter(~F.col("asks")).groupBy("length", "cell").agg(F.count(F.lit(1)).alias("held"))
    large = sizes.filter(F.col("held") > block_words).select(
        "length", "cell", F.ceil(F.col("held") / F.lit(block_words)).cast("int").alias("blocks")
    )
    blocks = F.coalesce("blocks", F.lit(1))
    every = F.sequence(F.lit(0), blocks - 1)
    own = F.array(F.pmod(F.xxhash64("word"), blocks).cast("int"))
    block = F.explode(F.when(F.col("asks"), every).otherwise(own)).alias("block")
    return visits.join(large, ["length", "cell"], "left").select("length", "cell", block, "asks", "word", "n")


class _Block:
    """The words of one block, best first, with a k-d tree over them."""

    def __init__(self, words: list[str], counts: np.ndarray) -> None:
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.words, self.counts = [words[i] for i in order], counts[order]
        self.letters, self.points = letters_of(self.words), points_of(self.words)
        self.tree = grown(self.points, LEAF_WORDS)

    def _leaves(self, points: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of a leaf with rows that reach it; rows come in parts where words are many."""
        for leaf, of in reached(self.tree, points, np.arange(len(points)), up, down):
            size = max(1, PAIR_BYTES // (LETTERS * len(leaf.members)))
            for i in range(0, len(of), size):
                yield leaf.members, of[i : i + size]

    def near(self, asked: np.ndarray, points: np.ndarray, longer_by: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows asked for and words here that are one edit apart."""
        up, down = steps(longer_by)
        size = max(1, PAIR_BYTES // max(1, self.letters.shape[1]))
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for leaf, of in self._leaves(points, up, down):
            apart = self.points[leaf][None] - points[of][:, None]
            close = (np.maximum(apart, 0).sum(2) <= up) & (np.maximum(-apart, 0).sum(2) <= down)
            rows, others = np.nonzero(close)
            rows, others = of[rows], leaf[others]
            for i in range(0, len(rows), size):
                row, at = rows[i : i + size], others[i : i + size]
                one, other = asked[row], self.letters[at]
                ok = one_edit(one, other) if longer_by >= 0 else one_edit(other, one)
                found.append((row[ok], at[ok]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def answer(self, words: list[str]) -> Iterator[dict]:
        """Columns word, n_near, form_n, form of the words that have near words here."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        for longer_by in (-1, 0, 1):
            asked = [words[i] for i in np.flatnonzero(size == self.letters.shape[1] - longer_by)]
            if not asked:
                continue
            row, at = self.near(letters_of(asked), points_of(asked), longer_by)
            n = np.bincount(row, minlength=len(asked))
            best = np.full(len(asked), len(self.words))
            np.minimum.at(best, row, at)
            hit = np.flatnonzero(n)
            yield {
                "word": [asked[i] for i in hit],
                "n_near": n[hit],
                "form_n": self.counts[best[hit]],
                "form": [self.words[i] for i in best[hit]],
            }


def _answers(dealt: DataFrame) -> DataFrame:
    """Rows (word, n_near, form_n, form) from each block that has near words of a word.

    Rows come by block, its words before those that ask.
    """
    keys = ["length", "cell", "block"]
    in_order = dealt.repartition(*keys).sortWithinPartitions(*keys, "asks")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current, block = None, None
        words: list[str] = []
        counts: list[np.ndarray] = []
        for batch in batches:
            columns = np.stack([np.asarray(batch.column(c).cast(pa.int64())) for c in keys])
            asks = np.asarray(batch.column("asks").cast(pa.int8()))
            said, n = batch.column("word").to_pylist(), np.asarray(batch.column("n"))
            new = (columns[:, 1:] != columns[:, :-1]).any(0) | (asks[1:] != asks[:-1])
            bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(said)]])
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if a == b:
                    continue
                key = columns[:, a].tolist()
                if key != current:
                    current, block, words, counts = key, None, [], []
                if not asks[a]:
                    words += said[a:b]
                    counts.append(n[a:b])
                elif words:
                    block = block or _Block(words, np.concatenate(counts))
                    for i in range(a, b, ASKED_AT_ONCE):
                        yield from block.answer(said[i : min(b, i + ASKED_AT_ONCE)])

    return map_partitions(in_order, task, "word string, n_near bigint, form_n bigint, form string")


def neighbours(
    words: DataFrame,
    sample_words: int = SAMPLE_WORDS,
    per_cell: int = SAMPLE_PER_CELL,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Rows (word, n_near, form_n, form) for words of (word, n) that have near words.

    ``form`` is the near word of largest n, of equals the smallest.
    """
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(sample_words)
    cells = Cells([r.word for r in sample.collect()], per_cell)
    visits = materialize(_visits(words, cells), "visits")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return (
        _answers(_dealt(visits, block_words))
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), best)
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")
    )


def roots(forms: DataFrame) -> DataFrame:
    """Rows (word, root) from (word, form): the last word that forms lead to.

    A form occurs at least twice as often as its word, so paths are short; each round
    doubles the steps taken.
    """
    ahead = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        farther = ahead.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        joined = ahead.join(farther, "root", "left")
        ahead = materialize(
            joined.select("word", F.coalesce("farther", "root").alias("root"), F.col("farther").isNotNull().alias("moved")),
            "roots",
        )
        if ahead.filter("moved").isEmpty():
            return ahead.select("word", "root")
        ahead = ahead.drop("moved")


def spelling_variants(
    documents: DataFrame,
    id_col: str = "doc_id",
    sample_words: int = SAMPLE_WORDS,
    per_cell: int = SAMPLE_PER_CELL,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    A word's form is its near word with the largest n, if that is at least twice the
    word's, else null. Null and empty texts have no words; without words there are no
    rows. Repeated rows count each; columns other than the id and text are not read.
    """
    words = materialize(vocabulary(documents, id_col), "vocabulary")
    near = materialize(neighbours(words, sample_words, per_cell, block_words), "neighbours")
    taken = F.col("form_n") >= 2 * F.col("n")
    known = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("form")).alias("form"),
        F.when(taken, F.col("form_n")).alias("form_n"),
    )
    led = roots(known.filter(F.col("form").isNotNull()))
    return known.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
