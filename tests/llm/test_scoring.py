"""Scores against a context tree written out in fractions, bit by bit."""

import collections
import math
import re
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa

from tidegauge.llm import scoring
from tidegauge.llm.batches import NOT_SPACE, words

DEPTH = 5
HALF = Fraction(1, 2)
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


class Tree:
    """Counts of bits by context (nearest byte last) and the bits before in the byte."""

    def __init__(self, texts):
        self.counts = collections.defaultdict(lambda: [0, 0])
        self.longer = collections.defaultdict(set)
        for text in texts:
            for context, byte in grams(text):
                for bit in range(8):
                    so_far = byte >> (8 - bit)
                    for depth in range(DEPTH + 1):
                        node = context[DEPTH - depth:], bit, so_far
                        self.counts[node][byte >> (7 - bit) & 1] += 1
                        if depth < DEPTH:
                            self.longer[node].add((context[DEPTH - depth - 1:], bit, so_far))
        self.known = {}

    def estimate(self, node):
        """One bit after the other: (n + 1/2) / (all + 1)."""
        p, seen = Fraction(1), [0, 0]
        for bit in (0, 1):
            for _ in range(self.counts[node][bit]):
                p *= (seen[bit] + HALF) / (sum(seen) + 1)
                seen[bit] += 1
        return p

    def weighted(self, node):
        if node not in self.known:
            p = self.estimate(node)
            if len(node[0]) < DEPTH:
                p = HALF * p + HALF * math.prod(map(self.weighted, self.longer[node]))
            self.known[node] = p
        return self.known[node]

    def bit(self, context, bit, so_far, one, depth=0):
        """Probability of the bit; contexts that were never seen have no say."""
        node = context[DEPTH - depth:], bit, so_far
        n = self.counts[node] if node in self.counts else [0, 0]
        said = (n[one] + HALF) / (sum(n) + 1)
        longer = context[DEPTH - depth - 1:], bit, so_far
        if depth == DEPTH or longer not in self.counts:
            return said
        weight = HALF * self.estimate(node) / self.weighted(node)
        return weight * said + (1 - weight) * self.bit(context, bit, so_far, one, depth + 1)

    def byte(self, context, byte):
        return math.prod(
            self.bit(context, bit, byte >> (8 - bit), byte >> (7 - bit) & 1) for bit in range(8)
        )


def grams(text):
    data = b"\0" * DEPTH + lower(text).encode() + b"\0"
    return [(data[i - DEPTH:i], data[i]) for i in range(DEPTH, len(data))]


def test_scores_equal_a_tree_in_fractions(spark):
    texts = ["the cat sat. The", "cat é the", "", None, "that the that", "sat on", "a the hat", "cats", "xyzzy the", "the cat"]
    rows = list(enumerate(texts, 20)) + [(20, texts[0]), (None, "hat")]
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, _ in rows}
    tree = Tree([t for i, t in rows if not held[i]])
    assert True in held.values() and False in held.values()
    words = collections.Counter()
    for i, t in rows:
        if not held[i]:
            words.update([*TOKEN.findall(lower(t)), None])
    total = sum(words.values())
    want = []
    for i, t in rows:
        said = [*TOKEN.findall(lower(t)), None]
        base = sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in said)
        score = sum(math.log10(tree.byte(*g)) for g in grams(t))
        want.append((str(i), held[i], len(said), sum(words[w] > 0 for w in said), total, round(base, 6), round(score, 5)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 5))
        for r in scoring.scores(df, block_bytes=40).collect()
    ]
    assert sorted(got) == sorted(want)
    for context in (b"\0\0\0\0\0", b" the ", b"zzzzz"):
        assert sum(tree.byte(context, b) for b in range(256)) == 1


def test_a_task_holds_little_beside_its_texts():
    """Words of a block were hashed two megabytes at a time, with ten times that beside them."""
    column = pa.array([f"The cat sat on a mat {i % 50} " * 150 for i in range(4000)])
    tallies = (scoring.Tally(), scoring.Tally())
    tracemalloc.start()
    scoring.tell(column, True, tallies)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    (_, n), (said, told) = (t.merge() for t in tallies)
    assert n.sum() == sum(len(t) + 1 for t in column.to_pylist())
    assert len(said) == 6 + 50 and told.sum() == 4000 * 150 * 7  # "the" is "The"
    of_pieces = [np.concatenate([w.hash for w in words(column, NOT_SPACE, size)]) for size in (1, 10_000, 1 << 30)]
    assert all((h == of_pieces[0]).all() for h in of_pieces)
