"""Removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of ``min_bytes`` that covers it also starts elsewhere.
Sorting every suffix of a corpus would shuffle many times its size, so the work
narrows in steps that lose no repeat:

1. Each string of ``min_bytes`` has an anchor, its 32-byte gram of least hash.
   Equal strings have equal anchors at equal places. Neighbouring starts share
   their anchor and form a block; only blocks whose anchor gram occurs twice go on.
2. Blocks of equal bytes are repeats as a whole, however many there are of them;
   one stands for all.
3. Different blocks of one gram are compared by suffix order: ranks by prefix
   doubling up to ``min_bytes``, ties in order of position. A start with a factor
   of that length before it has it at the previous smaller position, which is
   then its predecessor in the order; the next smaller position never is longer.
   The successor tells of a later copy.
4. Grams with many different blocks are dealt over units of ``UNIT_BLOCKS``; what
   each unit finds distinct is compared between units by digest.

Positions go by input row and byte. Only texts move whole: once to cut out the
blocks of step 3, once to apply the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.batches import (
    Powers,
    map_arrow,
    map_partitions,
    mixed,
    pieces,
    prefix_hash,
    utf8,
)
from tidegauge.llm.jaccard import row_key
from tidegauge.session import materialize

MIN_BYTES = 400
GRAM = 32
CHUNK = 4 << 20  # bytes ranked at once
UNIT_BLOCKS = CHUNK // (MIN_BYTES + (MIN_BYTES - GRAM) // 2)  # a unit fills a chunk

_LOW = np.uint64(0xFFFFFFFF)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def blocks_of(data: np.ndarray, at: np.ndarray, min_bytes: int) -> dict[str, np.ndarray]:
    """Blocks of texts laid end to end (bounds ``at``): text, start, starts, anchor place, gram, digest."""
    gram = min(GRAM, min_bytes)
    n_grams = len(data) - gram + 1
    width = min_bytes - gram + 1
    if n_grams < width:
        none = np.empty(0, np.int64)
        return {c: none for c in ("text", "start", "n", "off", "gram", "digest")}
    sums = prefix_hash(data)
    _, down = Powers.upto(len(sums))
    h = mixed((sums[gram:] - sums[:n_grams]) * down[:n_grams])
    keyed = (h & ~_LOW) | np.arange(n_grams, dtype=np.uint64)
    anchor = (window_minima(keyed, width) & _LOW).astype(np.int64)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + min_bytes <= at[1:][text])
    anchor, text = anchor[start], text[start]
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(start)))
    begin, raw = start[first], data.tobytes()
    digest = [
        int.from_bytes(hashlib.blake2b(raw[a : a + c + min_bytes - 1], digest_size=8).digest(), "little", signed=True)
        for a, c in zip(begin.tolist(), n.tolist(), strict=True)
    ]
    return {
        "text": text[first],
        "start": begin - at[text[first]],
        "n": n,
        "off": anchor[first] - begin,
        "gram": h[anchor[first]],
        "digest": np.array(digest, np.int64),
    }


def _blocks(documents: DataFrame, min_bytes: int) -> DataFrame:
    """Rows (row, row_key, start, n, gram, digest) from rows (row, row_key, text)."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        whole, offsets = utf8(batch.column("text"))
        for first, last in pieces(offsets):
            at = offsets[first : last + 1]
            found = blocks_of(whole[at[0] : at[-1]], at - at[0], min_bytes)
            own = pa.array(found["text"] + first)
            yield {c: batch.column(c).take(own) for c in ("row", "row_key")} | {
                c: found[c] for c in ("start", "n", "gram", "digest")
            }

    return map_arrow(
        documents, rows, "row bigint, row_key binary, start int, n int, gram bigint, digest bigint"
    )


def _longer(ranks: np.ndarray, have: int, step: int) -> np.ndarray:
    """Numbers that order suffixes by ``have + step`` bytes, from ranks by ``have`` (the end is padded)."""
    beside = np.zeros(len(ranks), np.int64)
    beside[: len(ranks) - step] = ranks[step:]
    # eight bytes fit a word, after that two ranks do
    return (ranks << (8 * step)) | (beside & ((1 << (8 * step)) - 1)) if have + step <= 4 else (ranks << 32) | beside


def suffix_ranks(data: np.ndarray, length: int, begin: np.ndarray) -> np.ndarray:
    """Rank of the first ``length`` bytes of the suffixes at ``begin``, equal where those are; -1: met once.

    Each ``begin`` has ``length`` bytes after it. Ranks by prefix doubling; once
    they are sorted, a start within whose ``length`` bytes lies a suffix met once
    has no equal, and bytes that no other start needs are left out.
    """
    out = np.full(len(begin), -1, np.int64)
    open_ = np.arange(len(begin))
    ranks, have = data.astype(np.int64), 1
    while have < length and len(open_):
        step = min(have, length - have)
        ranks = _longer(ranks, have, step)
        have += step
        if have <= 4:
            continue
        if have == length:
            ranks, begin = np.unique(ranks[begin], return_inverse=True)[1], slice(None)
            break
        _, ranks, n = np.unique(ranks, return_inverse=True, return_counts=True)
        met_once = np.concatenate([[0], np.cumsum(n[ranks] == 1)])
        left = met_once[begin + (length - have) + 1] == met_once[begin]
        open_, begin = open_[left], begin[left]
        covered = np.bincount(begin, minlength=len(ranks)) - np.bincount(begin + length, minlength=len(ranks) + 1)[:-1]
        needed = np.cumsum(covered) > 0
        begin = np.cumsum(needed)[begin] - 1
        ranks = ranks[needed]
    out[open_] = ranks[begin]
    return out


def factors(ranks: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a start has a factor of full length at an earlier, and at a later position.

    In suffix order with ties by position, the previous smaller position of a
    suffix that has such a factor is its predecessor.
    """
    order = np.lexsort((position, ranks))
    same = ranks[order][1:] == ranks[order][:-1]
    earlier, later = np.zeros(len(ranks), bool), np.zeros(len(ranks), bool)
    earlier[order[1:]] = same
    later[order[:-1]] = same
    return earlier, later


def _compared(blocks: DataFrame, min_bytes: int, keep_first: bool) -> DataFrame:
    """Spans (row, start, end) to remove, and rows with a digest to compare between units."""
    by = ["gram", "unit"]
    dealt = blocks.repartition(*by).sortWithinPartitions(*by, "row", "start")

    def one(chunk: list[dict]) -> dict:
        data = np.frombuffer(b"".join(b["bytes"] for b in chunk), np.uint8)
        n = np.array([b["n"] for b in chunk])
        base = np.concatenate([[0], np.cumsum(n + min_bytes - 1)])[:-1]
        owner = np.repeat(np.arange(len(chunk)), n)
        local = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = base[owner] + local
        ranks = suffix_ranks(data, min_bytes, begin)
        row = np.array([b["row"] for b in chunk])[owner]
        start = np.array([b["start"] for b in chunk])[owner] + local
        again = np.flatnonzero(ranks >= 0)
        position = np.empty(len(again), np.int64)
        position[np.lexsort((start[again], row[again]))] = np.arange(len(again))
        earlier, later = np.zeros((2, len(row)), bool)
        earlier[again], later[again] = factors(ranks[again], position)
        many = np.array([b["copies"] > 1 for b in chunk])[owner]
        gone = earlier if keep_first else earlier | later
        # blocks with copies are repeats as a whole and are told elsewhere
        told = gone if keep_first else gone & ~many
        cut = np.diff(owner) != 0
        head, tail = told.copy(), told.copy()
        head[1:] &= ~told[:-1] | cut
        tail[:-1] &= ~told[1:] | cut
        out: dict[str, list] = {
            "row": row[head].tolist(),
            "start": start[head].tolist(),
            "end": (start[tail] + min_bytes).tolist(),
            "digest": [None] * int(head.sum()),
        }
        split = np.array([b["units"] > 1 for b in chunk])[owner]
        raw = data.tobytes()
        for s in np.flatnonzero(split & ~earlier).tolist():
            out["row"].append(int(row[s]))
            out["start"].append(int(start[s]))
            # an end of 0: already known to be a repeat, here only to be found
            out["end"].append(0 if later[s] or many[s] else int(start[s]) + min_bytes)
            out["digest"].append(hashlib.blake2b(raw[begin[s] : begin[s] + min_bytes], digest_size=16).digest())
        return out

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held: list[dict] = []
        seen: set[int] = set()
        size, current = 0, None
        for batch in batches:
            for b in batch.to_pylist():
                if (b["gram"], b["unit"]) != current:
                    if size >= CHUNK:
                        yield one(held)
                        held, size = [], 0
                    current, seen = (b["gram"], b["unit"]), set()
                if b["digest"] in seen:
                    continue  # the same block, cut from rows alike in id and text
                seen.add(b["digest"])
                held.append(b)
                size += len(b["bytes"])
        if held:
            yield one(held)

    return map_partitions(dealt, task, "row bigint, start int, end int, digest binary")


def _cut_out(texts: DataFrame, wanted: DataFrame, min_bytes: int) -> DataFrame:
    """The bytes of wanted blocks: rows (gram, unit, units, digest, copies, row, start, n, bytes)."""
    fields = ("gram", "unit", "units", "digest", "copies", "row", "start", "n")
    lists = wanted.groupBy("row_key").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    joined = texts.join(materialize(lists, "wanted").hint("shuffle_hash"), "row_key")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            raw = text.encode()
            yield {c: [w[c] for w in wanted] for c in fields} | {
                "bytes": [raw[w["start"] : w["start"] + w["n"] + min_bytes - 1] for w in wanted]
            }

    return map_arrow(
        joined.select("text", "wanted"),
        rows,
        "gram bigint, unit int, units int, digest bigint, copies bigint, row bigint, start int, n int, bytes binary",
    )


def repeated_spans(texts: DataFrame, min_bytes: int = MIN_BYTES, keep_first: bool = False) -> DataFrame:
    """Rows (row_key, spans) from rows (row_key, text): sorted, possibly overlapping byte spans."""
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    blocks = materialize(_blocks(numbered, min_bytes), "blocks")
    grams = materialize(blocks.groupBy("gram").count().filter("count > 1"), "grams")
    again = materialize(blocks.join(grams.select("gram").hint("merge"), "gram"), "again")
    keys = again.select("row", "row_key").distinct()
    place = F.min(F.struct("row", "start", "n", "row_key")).alias("first")
    distinct = materialize(
        again.groupBy("gram", "digest").agg(F.count(F.lit(1)).alias("copies"), place), "distinct-blocks"
    )
    # blocks that are repeats as a whole
    whole = distinct.filter("copies > 1").select("gram", "digest", "first")
    copies = again.join(materialize(whole, "whole"), ["gram", "digest"])
    if keep_first:
        copies = copies.filter("row != first.row OR start != first.start")
    known = copies.select("row", "start", (F.col("start") + F.col("n") - 1 + min_bytes).alias("end"))
    # blocks to compare with others of their gram
    several = materialize(distinct.groupBy("gram").count().filter("count > 1"), "several")
    units = F.ceil(F.col("count") / UNIT_BLOCKS).cast("int")
    wanted = distinct.join(several, "gram").select(
        "gram", "digest", "copies", "first.*", units.alias("units"), F.pmod("digest", units).cast("int").alias("unit")
    )
    compared = materialize(
        _compared(_cut_out(texts, wanted, min_bytes), min_bytes, keep_first), "compared"
    )
    across = compared.filter("digest IS NOT NULL")
    shared = materialize(
        across.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("seen"), F.min(F.struct("row", "start")).alias("first"))
        .filter("seen > 1"),
        "shared",
    )
    late = across.join(shared, "digest")
    late = late.filter("row != first.row OR start != first.start") if keep_first else late.filter("end > 0")
    spans = (
        known.unionByName(compared.filter("digest IS NULL").select("row", "start", "end"))
        .unionByName(late.select("row", "start", (F.col("start") + min_bytes).alias("end")))
    )
    return (
        spans.join(keys, "row")
        .groupBy("row_key")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"))
    )


def without_repeats(
    documents: DataFrame, id_col: str = "doc_id", min_bytes: int = MIN_BYTES, keep_first: bool = False
) -> DataFrame:
    """One row per row of ``documents``: the id, n_bytes, kept (bytes), spans (removed, maximal).

    With ``keep_first`` the first occurrence in input order stays, else all
    occurrences go. Null texts are empty. Rows alike in id and text get the same
    result, as they count as occurrences of each other. Other columns are not read.
    """
    texts = documents.select(
        row_key([id_col, "text"]).alias("row_key"),
        F.col(id_col).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    spans = materialize(
        repeated_spans(texts.select("row_key", "text"), min_bytes, keep_first), "spans"
    )
    joined = texts.join(spans.hint("shuffle_hash"), "row_key", "left")

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        out: dict[str, list] = {"n_bytes": [], "kept": [], "spans": []}
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw = text.encode()
            gone: list[list[int]] = []
            for span in spans or ():
                if gone and span["start"] <= gone[-1][1]:
                    gone[-1][1] = max(gone[-1][1], span["end"])
                else:
                    gone.append([span["start"], span["end"]])
            at, kept = 0, []
            for a, b in gone:
                kept.append(raw[at:a])
                at = b
            out["n_bytes"].append(len(raw))
            out["kept"].append(b"".join(kept) + raw[at:])
            out["spans"].append([{"start": a, "end": b} for a, b in gone])
        yield {"id": batch.column("id")} | out

    kind = documents.schema[id_col].dataType.simpleString()
    return map_arrow(
        joined.select("id", "text", "spans"),
        rows,
        f"id {kind}, n_bytes bigint, kept binary, spans array<struct<start:int,end:int>>",
    ).withColumnRenamed("id", id_col)
