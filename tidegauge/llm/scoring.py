"""Language-model scores by context-tree weighting, beside a word-unigram base.

The corpus is counted as byte grams (``ctw.DEPTH`` context bytes and the next
byte) and words. No task and no broadcast holds the whole model: texts are dealt
into blocks of about ``BLOCK_BYTES``; a block lists the grams and words it has,
the model is joined to those lists, and each block is scored beside its own
part. The tree is weighed in subtrees by the two latest context bytes; only the
levels above those, a fixed number of nodes, meet on the driver.

Words are compared by a 64-bit hash. Texts are scored as lower-case bytes and an
end byte, each after its context; contexts never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm import ctw
from tidegauge.llm.batches import (
    LOWER,
    NOT_SPACE,
    map_partitions,
    mixed,
    pieces,
    utf8,
    words,
)
from tidegauge.llm.jaccard import row_key
from tidegauge.session import materialize

BLOCK_BYTES = 32 << 20
PIECE = 1 << 18  # bytes of text whose grams or words are looked at together
ROWS_AT_ONCE = 1 << 10
GRAMS_AT_ONCE = 1 << 18
MERGE_AT = 1 << 19
PACK_AT = 1 << 17
GRAM, WORD, TEXT = 0, 1, 2


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows not learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 10 == 0


def grams_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of texts laid end to end (bounds ``at``), with the text of each.

    A text gives one gram per byte and one for its end byte 0; bytes before its
    beginning are 0.
    """
    n, depth = len(at) - 1, ctw.DEPTH
    size = np.diff(at)
    owner = np.repeat(np.arange(n), size)
    stream = np.zeros(len(data) + n * (depth + 1), np.uint8)
    stream[np.arange(len(data)) + owner * (depth + 1) + depth] = LOWER[data]
    begin = at[:-1] + np.arange(n) * (depth + 1)
    grams = ctw.pack(stream)
    text = np.repeat(np.arange(n), size + 1)
    inside = np.arange(len(text)) - np.repeat(at[:-1] + np.arange(n), size + 1)
    return grams[np.repeat(begin, size + 1) + inside], text


class Tally:
    """Distinct values and their counts, merged when many have gathered."""

    def __init__(self) -> None:
        self.values: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, values: np.ndarray, learned: bool) -> None:
        found, n = np.unique(values, return_counts=True)
        self.values.append(found)
        self.counts.append(n if learned else np.zeros(len(n), np.int64))
        self.size += len(found)
        if self.size > MERGE_AT and len(self.values) > 1:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.values:
            found, at = np.unique(np.concatenate(self.values), return_inverse=True)
            n = np.bincount(at, np.concatenate(self.counts), len(found)).astype(np.int64)
            self.values, self.counts, self.size = [found], [n], 0
            return found, n
        return np.empty(0, np.uint64), np.empty(0, np.int64)


def tell(column: pa.Array, learned: bool, tallies: tuple[Tally, Tally]) -> None:
    """Add the grams and the words of texts to the tallies of each."""
    whole, offsets = utf8(column)
    for a, b in pieces(offsets, PIECE):
        at = offsets[a : b + 1]
        tallies[GRAM].add(grams_of(whole[at[0] : at[-1]], at - at[0])[0], learned)
    for w in words(column, NOT_SPACE, PIECE):
        tallies[WORD].add(w.hash, learned)


def _listed(texts: DataFrame) -> DataFrame:
    """Rows (block, kind, value, n): what a block has, and how often its learned texts have it."""
    dealt = texts.select("block", "held", "text").repartition("block").sortWithinPartitions("block")

    def told(block: int, tallies: tuple[Tally, Tally]) -> Iterator[dict]:
        for kind, tally in enumerate(tallies):
            found, n = tally.merge()
            for i in range(0, len(found), 1 << 17):
                part = found[i : i + (1 << 17)]
                yield {
                    "block": np.full(len(part), block),
                    "kind": np.full(len(part), kind),
                    "value": part,
                    "n": n[i : i + (1 << 17)],
                }

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block, tallies = None, (Tally(), Tally())
        for batch in batches:
            of = np.asarray(batch.column("block"))
            held = np.asarray(batch.column("held").cast(pa.int8())).astype(bool)
            for own in np.unique(of):
                if block is not None and own != block:
                    yield from told(block, tallies)
                    tallies = (Tally(), Tally())
                block = own
                for learned in (True, False):
                    rows = np.flatnonzero((of == own) & (held != learned))
                    for i in range(0, len(rows), ROWS_AT_ONCE):
                        some = pa.array(rows[i : i + ROWS_AT_ONCE])
                        tell(batch.column("text").take(some), learned, tallies)
        if block is not None:
            yield from told(block, tallies)

    return map_partitions(dealt, task, "block int, kind int, value bigint, n bigint")


def _in_subtrees(grams: DataFrame, work, schema: str) -> DataFrame:
    """Apply ``work`` to whole subtrees of grams (value, n), some at a time."""
    subtree = F.shiftrightunsigned("value", 8).bitwiseAND(F.lit((1 << 8 * ctw.TOP) - 1))
    dealt = (
        grams.select("value", "n", subtree.alias("subtree"))
        .repartition("subtree")
        .sortWithinPartitions("subtree")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            columns = tuple(np.asarray(batch.column(c)) for c in ("value", "n", "subtree"))
            if size >= GRAMS_AT_ONCE:
                # up to where the subtree that is open at the seam ends
                seam = int(np.searchsorted(columns[2], held[-1][2][-1], "right"))
                held.append(tuple(c[:seam] for c in columns))
                columns = tuple(c[seam:] for c in columns)
                if len(columns[0]):
                    yield from apply(held)
                    held, size = [], 0
            if len(columns[0]):
                held.append(columns)
                size += len(columns[0])
        if held:
            yield from apply(held)

    def apply(held: list[tuple[np.ndarray, ...]]) -> Iterator[dict]:
        values = np.concatenate([h[0] for h in held]).view(np.uint64)
        yield work(values, np.concatenate([h[1] for h in held]))

    return map_partitions(dealt, task, schema)


def _subtree_levels(values: np.ndarray, n: np.ndarray) -> dict[int, list[ctw.Nodes]]:
    levels = {d: ctw.nodes(values, n, d) for d in range(ctw.TOP, ctw.DEPTH + 1)}
    ctw.weigh(levels, ctw.TOP)
    return levels


def _top_sums(values: np.ndarray, n: np.ndarray) -> dict:
    """Sums over a chunk of subtrees for the nodes of one context byte."""
    out: dict[str, list] = {c: [] for c in ("bit", "node", "below", "n0", "n1")}
    for bit, own in enumerate(_subtree_levels(values, n)[ctw.TOP]):
        # drop the second context byte: eight bits of context and the bits so far stay
        node, at = np.unique(own.key & np.uint64((1 << (8 + bit)) - 1), return_inverse=True)
        out["bit"].append(np.full(len(node), bit))
        out["node"].append(node)
        for name, values_of in (("below", own.weighted), ("n0", own.n0), ("n1", own.n1)):
            out[name].append(np.bincount(at, values_of, len(node)))
    return {c: np.concatenate(parts) for c, parts in out.items()}


def _top_levels(rows: list) -> dict[int, list[ctw.Nodes]]:
    """Levels 1 and 0 of the tree, weighed, from the sums of all subtrees."""
    levels: dict[int, list[ctw.Nodes]] = {0: [], 1: []}
    below = []
    for bit in range(8):
        own = sorted((r["node"], r["below"], r["n0"], r["n1"]) for r in rows if r["bit"] == bit)
        key, sums, n0, n1 = (np.array(c) for c in zip(*own, strict=True))
        key = key.astype(np.uint64)
        levels[1].append(ctw.Nodes(np.arange(len(key)), key, n0, n1, ctw.kt(n0, n1)))
        below.append(sums)
        root, at = np.unique(key & np.uint64((1 << bit) - 1), return_inverse=True)
        m0, m1 = np.bincount(at, n0, len(root)), np.bincount(at, n1, len(root))
        levels[0].append(ctw.Nodes(at, root, m0, m1, ctw.kt(m0, m1)))
    ctw.weigh(levels, 0, below)
    return levels


def gram_scores(grams: DataFrame) -> DataFrame:
    """Rows (value, p): log10 of the probability of each gram's byte after its context."""
    sums = _in_subtrees(grams, _top_sums, "bit int, node bigint, below double, n0 double, n1 double")
    rows = sums.groupBy("bit", "node").agg(*[F.sum(c).alias(c) for c in ("below", "n0", "n1")]).collect()
    top = grams.sparkSession.sparkContext.broadcast(_top_levels(rows) if rows else None)

    def work(values: np.ndarray, n: np.ndarray) -> dict:
        bits = ctw.bits_of(values)
        long = ctw.mix(_subtree_levels(values, n), bits)
        above: dict[int, list[ctw.Nodes]] = {0: [], 1: []}
        for depth in above:
            kept = values & np.uint64((1 << (8 * depth + 8)) - 1)
            for bit, own in enumerate(top.value[depth]):
                of = np.searchsorted(own.key, kept >> np.uint64(8 - bit))
                above[depth].append(ctw.Nodes(of, own.key, own.n0, own.n1, own.own, own.weighted))
        p = ctw.mix(above, bits, long)
        return {"value": values, "p": sum(np.log10(x) for x in p)}

    return _in_subtrees(grams, work, "value bigint, p double")


class Part:
    """The part of the model that a block needs, found by hash."""

    def __init__(self, values: np.ndarray, p: np.ndarray) -> None:
        key = mixed(values.view(np.uint64))
        order = np.argsort(key)
        self.key, self.p = key[order], p[order]
        bits = max(1, int(len(key)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.key >> self.shift, np.arange(1 << bits, dtype=np.uint64))

    def find(self, values: np.ndarray) -> np.ndarray:
        key = mixed(values)
        at = self.first[key >> self.shift]
        open_ = np.flatnonzero(self.key[at] != key)
        while len(open_):
            at[open_] += 1
            open_ = open_[self.key[at[open_]] != key[open_]]
        return self.p[at]


def _packed(parts: DataFrame) -> DataFrame:
    """Rows (block, kind, values, p) with many values each, for a leaner shuffle."""

    def packed(held: list[pa.RecordBatch]) -> dict:
        block, kind, value, p = (
            np.concatenate([np.asarray(b.column(c)) for b in held]) for c in ("block", "kind", "value", "p")
        )
        order = np.lexsort((kind, block))
        block, kind, value, p = block[order], kind[order], value[order], p[order]
        new = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (kind[1:] != kind[:-1])]))
        ends = np.append(new[1:], len(block))
        return {
            "block": block[new],
            "kind": kind[new],
            "values": [value[a:b].tobytes() for a, b in zip(new, ends, strict=True)],
            "p": [p[a:b].tobytes() for a, b in zip(new, ends, strict=True)],
        }

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PACK_AT:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    return map_partitions(parts, task, "block int, kind int, values binary, p binary")


def scores(documents: DataFrame, id_col: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``documents``: the id, held_out, n_bytes (with the end), n_tokens,
    n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the rows that are not held out. Null texts are empty: one end
    token, one end byte. Without any learned row all probabilities are even.
    Repeated rows count each; other columns are not read.
    """
    texts = documents.select(
        row_key([id_col, "text"]).alias("row_key"),
        F.col(id_col).alias("id"),
        held_out(id_col).alias("held"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size, n_learned = texts.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if(~F.col("held"))
    ).first()
    n_blocks = max(1, -(-size // block_bytes))
    texts = texts.withColumn("block", F.pmod(F.xxhash64("row_key"), F.lit(n_blocks)).cast("int")).drop("row_key")
    listed = materialize(_listed(texts), "listed")
    counts = materialize(
        listed.groupBy("kind", "value").agg(F.sum("n").alias("n")), "gram-and-word-counts"
    )
    n_words, n_kinds = counts.filter(F.col("kind") == WORD).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)
    ).first()
    train_tokens = n_words + n_learned
    divisor = train_tokens + 0.1 * (n_kinds + (n_learned > 0) + 1)
    unknown, end = (float(np.log10((c + 0.1) / divisor)) for c in (0, n_learned))
    word_p = F.log10((F.col("n") + 0.1) / F.lit(divisor))
    known_p = F.when(F.col("n") > 0, word_p)  # null: not learned
    model = (
        counts.filter(F.col("kind") == WORD)
        .select("kind", "value", F.coalesce(known_p, F.lit(float("nan"))).alias("p"))
        .unionByName(
            gram_scores(counts.filter(F.col("kind") == GRAM)).select(F.lit(GRAM).alias("kind"), "value", "p")
        )
    )
    parts = _packed(
        listed.select("block", "kind", "value")
        .join(materialize(model, "model").hint("merge"), ["kind", "value"])
        .select("block", "kind", "value", "p")
    )
    kind = documents.schema[id_col].dataType.simpleString()
    rows = parts.select(
        "block", "kind", "values", "p", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("boolean").alias("held"),
        F.lit(None).cast("string").alias("text"),
    ).unionByName(
        texts.select(
            "block", F.lit(TEXT).alias("kind"), F.lit(None).cast("binary").alias("values"),
            F.lit(None).cast("binary").alias("p"), "id", "held", "text",
        )
    )
    dealt = rows.repartition("block").sortWithinPartitions("block", "kind")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block, gathered = None, ([], [])
        parts: list[Part] = []
        for batch in batches:
            of, kinds = (np.asarray(batch.column(c)) for c in ("block", "kind"))
            for own in np.unique(of):
                if own != block:
                    block, gathered, parts = own, ([], []), []
                mine = np.flatnonzero(of == own)
                for i in mine[kinds[mine] != TEXT].tolist():
                    value, p = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("values", np.int64), ("p", float)))
                    gathered[kinds[i]].append((value, p))
                chosen = mine[kinds[mine] == TEXT]
                if len(chosen):
                    if not parts:
                        for found in gathered:
                            found = found or [(np.empty(0, np.int64), np.empty(0))]
                            parts.append(Part(*(np.concatenate(c) for c in zip(*found, strict=True))))
                        gathered = ([], [])
                    for i in range(0, len(chosen), ROWS_AT_ONCE):
                        yield scored(batch.take(pa.array(chosen[i : i + ROWS_AT_ONCE])), *parts)

    def scored(batch: pa.RecordBatch, grams: Part, vocabulary: Part) -> dict:
        n = batch.num_rows
        score, base = np.zeros(n), np.zeros(n)
        tokens, known = np.zeros(n, np.int64), np.zeros(n, np.int64)
        column = batch.column("text")
        whole, offsets = utf8(column)
        for a, b in pieces(offsets, PIECE):
            at = offsets[a : b + 1]
            found, text = grams_of(whole[at[0] : at[-1]], at - at[0])
            score[a:b] = np.bincount(text, grams.find(found), b - a)
        for w in words(column, NOT_SPACE, PIECE):
            p = vocabulary.find(w.hash) if len(w.hash) else np.empty(0)
            new, row = np.isnan(p), w.row - w.first
            base[w.first : w.last] = np.bincount(row, np.where(new, unknown, p), w.last - w.first)
            known[w.first : w.last] = np.bincount(row[~new], minlength=w.last - w.first)
            tokens[w.first : w.last] = w.counts()
        n_bytes = np.diff(offsets) + 1
        return {
            "id": batch.column("id"),
            "held_out": batch.column("held"),
            "n_bytes": n_bytes,
            "n_tokens": tokens + 1,
            "n_known": known + (n_learned > 0),
            "train_tokens": np.full(n, train_tokens, np.int64),
            "base_score": base + end,
            "score": score,
            "bits_per_byte": -score / np.log10(2) / n_bytes,
        }

    return map_partitions(
        dealt,
        task,
        f"id {kind}, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double, bits_per_byte double",
    ).withColumnRenamed("id", id_col)
