"""Token counts by a linear longest-match automaton.

Greedy longest-match word pieces over a given vocabulary: a trie whose nodes carry
a failure link and the number of pieces that are completed when it is followed.
Matching a word takes one pass over its bytes and builds no piece. Words are
separated by white space and begin with a blank, as in the vocabulary; each
single byte is a piece, so any text can be counted.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidegauge.llm.batches import map_arrow

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHED_WORDS = 1 << 19
LONGEST_CACHED = 48

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Pieces from a file of lines with a base64 piece and its rank; read on the driver."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


class Automaton:
    """Trie with failure links and popped-piece counts."""

    def __init__(self, pieces: Iterable[bytes]) -> None:
        self.next: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in [bytes([b]) for b in range(256)] + [p for p in pieces if p]:
            node = 0
            for byte in piece:
                child = self.next[node].get(byte)
                if child is None:
                    child = len(ends)
                    self.next[node][byte] = child
                    self.next.append({})
                    ends.append(False)
                node = child
            ends[node] = True
        self.fail = [-1] * len(ends)
        self.popped = [0] * len(ends)
        level = [0]
        while level:
            below = []
            for node in level:
                for byte, child in self.next[node].items():
                    below.append(child)
                    if ends[child]:
                        self.fail[child], self.popped[child] = 0, 1
                        continue
                    at, n = self.fail[node], self.popped[node]
                    while at >= 0 and byte not in self.next[at]:
                        n += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.popped[child] = self.next[at][byte], n
            level = below

    def count(self, said: bytes) -> int:
        """Pieces of a word; any single byte is a piece, so a failure link is always there."""
        step, fail, popped = self.next, self.fail, self.popped
        node = n = 0
        for byte in said:
            while (child := step[node].get(byte)) is None:
                n += popped[node]
                node = fail[node]
            node = child
        while node:
            n += popped[node]
            node = fail[node]
        return n


class WordCounts(dict):
    """Pieces by word, worked out once; emptied when full, and long words are not kept."""

    def __init__(self, automaton: Automaton) -> None:
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        n = self.automaton.count(b" " + word.encode())
        if len(word) <= LONGEST_CACHED:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = n
        return n


_COUNTERS: dict[int, WordCounts] = {}


def token_counts(
    documents: DataFrame, pieces: list[bytes] | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """One row per row of ``documents``: the id, n_words, n_tokens.

    Null and empty texts have none. Repeated rows and null ids are kept; other
    columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(
        read_vocabulary() if pieces is None else pieces
    )
    key = shared._id if hasattr(shared, "_id") else id(shared)

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        counts = _COUNTERS.get(key)
        if counts is None:
            _COUNTERS.clear()
            counts = _COUNTERS[key] = WordCounts(Automaton(shared.value))
        n_words, n_tokens = [], []
        for text in batch.column("text").to_pylist():
            words = _WORD.findall(text or "")
            n_words.append(len(words))
            n_tokens.append(sum(map(counts.__getitem__, words)))
        yield {id_col: batch.column(id_col), "n_words": n_words, "n_tokens": n_tokens}

    kind = documents.schema[id_col].dataType.simpleString()
    return map_arrow(
        documents.select(id_col, "text"), rows, f"`{id_col}` {kind}, n_words bigint, n_tokens bigint"
    )
