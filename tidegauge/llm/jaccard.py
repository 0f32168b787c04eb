"""N-gram Jaccard join with Bayesian candidate pruning.

Texts become sets of hashes of five words; texts of the same set are one class
from the start. Candidates are sets that share a band of MinHash values (32 bands
of four: a pair at Jaccard 0.8 is missed with probability 5e-8). Within a bucket
of such sets MinHash values are compared in steps, and a pair goes as soon as the
posterior probability that it reaches the threshold falls below ``TOLERANCE``.
What is left joins sets to groups; within a group all pairs are verified exactly.

No pair is ever a row. A bucket gives at most one link per member (a spanning
forest of the pairs left), a group gives each member its number of links and
again a forest. Buckets and groups above ``BLOCK`` members, and groups above
``BLOCK_SHINGLES`` shingles in all, are cut into blocks, and each pair of blocks is a
unit of work of its own, so a unit of long texts has fewer of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.batches import Words, map_arrow, map_partitions, words
from tidegauge.llm.columns import quoted
from tidegauge.llm.components import components
from tidegauge.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 4
HASHES = BANDS * BAND_ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21  # about 12 MB of text
PAIRS_AT_ONCE = 1 << 18

_SEEDS = np.random.default_rng(20240607)
_MULTIPLY = (_SEEDS.integers(0, 1 << 31, HASHES, np.uint32) << np.uint32(1)) | np.uint32(1)
_ADD = _SEEDS.integers(0, 1 << 32, HASHES, np.uint32)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(w: Words) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each row; of all words where there are under five."""
    hashes, ok = w.shingles(SHINGLE)
    bounds = np.searchsorted(w.row, np.arange(w.first, w.last + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(hashes[a : b - SHINGLE + 1])
        elif b > a:
            yield w.shingles(b - a)[0][a : a + 1]
        else:
            yield np.empty(0, np.uint64)


def minhash(values: np.ndarray) -> np.ndarray:
    x = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        part = np.multiply.outer(_MULTIPLY, x[i : i + 2048])
        part += _ADD[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit value per band of each signature."""
    parts = signatures.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    h = np.zeros(parts.shape[:2], np.uint64)
    for i in range(BAND_ROWS):
        h = (h ^ parts[:, :, i]) * _FOLD
        h ^= h >> np.uint64(31)
    return h


@cache
def needed_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> tuple[int, ...]:
    """After each step, the fewest equal values that keep a pair.

    Values are compared by their low 8 bits, so they are equal with probability
    J + (1 - J) / 256. The prior of J is uniform.
    """
    grid = (np.arange(4000) + 0.5) / 4000
    same = grid + (1 - grid) / 256
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        for m in range(n + 1):
            weight = m * np.log(same) + (n - m) * np.log1p(-same)
            weight = np.exp(weight - weight.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                out.append(m)
                break
    return tuple(out)


def unpruned(sketch: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) of rows of ``sketch`` that no step of the comparison drops."""
    matches = np.zeros(len(i), np.int64)
    for step, least in enumerate(needed_matches()):
        part = sketch[:, step * STEP : (step + 1) * STEP]
        matches = matches + (part[i] == part[j]).sum(1)
        keep = matches >= least
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


class Forest:
    """Union-find over the members of one bucket or group."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def in_blocks(members: DataFrame, blocks: Column, key: str) -> DataFrame:
    """Adds ``block`` and the pairs of blocks (p, q) that a member has to be in.

    ``blocks`` is the number of blocks of the member's bucket or group.
    """
    n = blocks.cast("int")
    block = F.pmod(F.xxhash64(key), n).cast("int")
    dealt = members.withColumn("block", block)
    pairs = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda j: F.struct(F.least("block", j).alias("p"), F.greatest("block", j).alias("q")),
    )
    return dealt.select("*", F.inline(pairs))


def _pairs(blocks: np.ndarray, p: int, q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a unit: all pairs of one block, or one of each of two blocks."""
    left, right = np.flatnonzero(blocks == p), np.flatnonzero(blocks == q)
    rows = max(1, PAIRS_AT_ONCE // max(1, len(right)))
    for a in range(0, len(left), rows):
        i = np.repeat(left[a : a + rows], len(right))
        j = np.tile(right, len(left[a : a + rows]))
        if p == q:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def _units(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[list[dict]]:
    """Runs of rows that agree in ``by``, from sorted rows."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(row[c] != held[0][c] for c in by):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def text_key(text: str | None) -> bytes:
    """The class of a text without words; null is not the empty text."""
    said = b"null" if text is None else b":" + text.encode()
    return hashlib.blake2b(said, digest_size=16).digest()


def _signed(documents: DataFrame) -> DataFrame:
    """Each row with its set's key (null without words; then the text's), size, bands and 8-bit values."""

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for w in words(batch.column("text")):
            sets = list(shingle_sets(w))
            own = batch.slice(w.first, w.last - w.first)
            signatures = np.array([minhash(s) for s in sets], np.uint32).reshape(-1, HASHES)
            yield {
                "row_key": own.column("row_key"),
                "id": own.column("id"),
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                "text_key": [
                    None if len(s) else text_key(own.column("text")[i].as_py()) for i, s in enumerate(sets)
                ],
                "n": [len(s) for s in sets],
                "bands": list(band_hashes(signatures).view(np.int64)),
                "sketch": [s.tobytes() for s in (signatures & np.uint32(255)).astype(np.uint8)],
            }

    kind = documents.schema["id"].dataType.simpleString()
    return map_arrow(
        documents,
        rows,
        f"row_key binary, id {kind}, set_key binary, text_key binary, n int, bands array<bigint>, sketch binary",
    )


def _candidate_links(sets: DataFrame) -> DataFrame:
    """Links (u, v) between set keys: a forest of the unpruned pairs of each bucket."""
    banded = materialize(
        sets.select("set_key", F.posexplode("bands").alias("band", "value")), "bands"
    )
    full = materialize(
        banded.groupBy("band", "value").count().filter("count > 1"), "buckets"
    )
    members = (
        banded.join(full, ["band", "value"])
        .join(sets.select("set_key", "sketch"), "set_key")
    )
    by = ["band", "value", "p", "q"]
    dealt = (
        in_blocks(members, F.ceil(F.col("count") / F.lit(BLOCK)), "set_key")
        .select(*by, "block", "set_key", "sketch")
        .repartition(*by)
        .sortWithinPartitions(*by, "set_key")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        u: list[bytes] = []
        v: list[bytes] = []
        for unit in _units(batches, by):
            sketch = np.frombuffer(b"".join(r["sketch"] for r in unit), np.uint8).reshape(-1, HASHES)
            blocks = np.array([r["block"] for r in unit])
            forest = Forest(len(unit))
            for i, j in _pairs(blocks, unit[0]["p"], unit[0]["q"]):
                for a, b in zip(*(x.tolist() for x in unpruned(sketch, i, j)), strict=True):
                    forest.join(a, b)
            for i, row in enumerate(unit):
                if (root := forest.root(i)) != i:
                    u.append(row["set_key"])
                    v.append(unit[root]["set_key"])
            if len(u) > 50_000:
                yield {"u": u, "v": v}
                u, v = [], []
        yield {"u": u, "v": v}

    return map_partitions(dealt, task, "u binary, v binary")


def exact_links(sets: list[np.ndarray], blocks: np.ndarray, p: int, q: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of a unit whose exact Jaccard similarity reaches the threshold."""
    size = np.array([len(s) for s in sets])
    vocabulary, number = np.unique(np.concatenate(sets), return_inverse=True)
    member = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(number, kind="stable")
    number, member = number[order], member[order]
    left, right = np.flatnonzero(blocks == p), np.flatnonzero(blocks == q)
    shared = np.zeros((len(left), len(right)), np.float32)
    place = {side: np.full(len(sets), -1) for side in ("left", "right")}
    place["left"][left] = np.arange(len(left))
    place["right"][right] = np.arange(len(right))
    width = 4096
    for start in range(0, len(vocabulary), width):
        a, b = np.searchsorted(number, [start, start + width])
        cells = []
        for side, n in (("left", len(left)), ("right", len(right))):
            at = place[side][member[a:b]]
            ok = at >= 0
            matrix = np.zeros((n, min(width, len(vocabulary) - start)), np.float32)
            matrix[at[ok], number[a:b][ok] - start] = 1
            cells.append(matrix)
        shared += cells[0] @ cells[1].T
    union = size[left][:, None] + size[right][None, :] - shared
    i, j = np.nonzero(shared >= threshold * union - 1e-9 * union)
    i, j = left[i], right[j]
    if p == q:
        i, j = i[i < j], j[i < j]
    yield i, j


def _verified(groups: DataFrame, threshold: float) -> DataFrame:
    """Per member and unit of work: set_key, its exact links there, and its root in the forest.

    ``groups`` has rows (label, blocks, set_key, text).
    """
    by = ["label", "p", "q"]
    dealt = (
        in_blocks(groups, F.col("blocks"), "set_key")
        .select(*by, "block", "set_key", "text")
        .repartition(*by)
        .sortWithinPartitions(*by, "set_key")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for unit in _units(batches, by):
            texts = pa.array([r["text"] for r in unit], pa.large_string())
            sets = [s for w in words(texts) for s in shingle_sets(w)]
            blocks = np.array([r["block"] for r in unit])
            links = np.zeros(len(unit), np.int64)
            forest = Forest(len(unit))
            for i, j in exact_links(sets, blocks, unit[0]["p"], unit[0]["q"], threshold):
                links += np.bincount(i, minlength=len(unit)) + np.bincount(j, minlength=len(unit))
                for a, b in zip(i.tolist(), j.tolist(), strict=True):
                    forest.join(a, b)
            yield {
                "set_key": [r["set_key"] for r in unit],
                "n_links": links,
                "root": [unit[forest.root(i)]["set_key"] for i in range(len(unit))],
            }

    return map_partitions(dealt, task, "set_key binary, n_links bigint, root binary")


def row_key(columns: list[str]) -> Column:
    """A digest of a row's id and text; rows alike in both are one document."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.unhex(F.md5(F.concat_ws(":", F.col(columns[0]).isNull().cast("string"), *said)))


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``documents``: row_key, the id, class_id, class_key, n_links, n_copies.

    ``class_id`` is the least id of the class (null ids last), ``class_key`` the
    key of the class, ``n_links`` the number of different sets linked to the row's
    own, ``n_copies`` the number of rows with the same set. Texts without words have
    no set: their n_copies is 1, and only equal ones share a class (null is equal to
    null, not to the empty text). Other columns are not read.
    """
    held = documents.select(
        row_key([id_col, "text"]).alias("row_key"), F.col(id_col).alias("id"), "text"
    )
    signed = materialize(_signed(held), "signed")
    sets = materialize(
        signed.filter("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(
            F.min("row_key").alias("row_key"),
            F.count(F.lit(1)).alias("n_copies"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
            F.first("n").alias("n"),
        ),
        "sets",
    )
    labels = components(_candidate_links(sets)).withColumnRenamed("node", "set_key")
    members = materialize(labels.join(sets.select("set_key", "row_key", "n"), "set_key"), "members")
    blocks = F.greatest(F.count(F.lit(1)) / F.lit(BLOCK), F.sum("n") / F.lit(BLOCK_SHINGLES))
    sizes = members.groupBy("label").agg(F.ceil(blocks).alias("blocks"))
    chosen = materialize(members.drop("n").join(sizes, "label"), "chosen")
    # the members grow with the rows, so they are never broadcast, at small sizes either
    texts = (
        held.select("row_key", "text")
        .join(chosen.hint("merge"), "row_key")
        .dropDuplicates(["set_key"])
    )
    verified = materialize(_verified(texts, threshold), "verified")
    classes = components(verified.select(F.col("set_key").alias("u"), F.col("root").alias("v")))
    links = verified.groupBy("set_key").agg(F.sum("n_links").alias("n_links"))
    by_set = materialize(
        sets.select("set_key", "n_copies")
        .join(links, "set_key", "left")
        .join(classes.withColumnRenamed("node", "set_key"), "set_key", "left")
        .select(
            "set_key",
            "n_copies",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("label", "set_key").alias("class_key"),
        ),
        "by-set",
    )
    rows = materialize(
        signed.select("row_key", "id", "set_key", "text_key")
        .join(by_set, "set_key", "left")
        .select(
            "row_key",
            "id",
            F.coalesce("class_key", "text_key").alias("class_key"),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
        ),
        "rows",
    )
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row_key"))
    heads = materialize(
        rows.groupBy("class_key").agg(first.alias("head")).select(
            "class_key", F.col("head.id").alias("class_id"), F.col("head.row_key").alias("head_key")
        ),
        "heads",
    )
    return rows.join(heads, "class_key").select(
        "row_key", F.col("id").alias(id_col), "class_id", "class_key", "head_key", "n_links", "n_copies"
    )


def one_of_each_class(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The row of least id of each class, with all columns; rows alike in id and text count once.

    Of rows alike in id and text the one whose other columns come first as JSON, nulls written out, stays.
    """
    found = near_duplicates(documents, threshold=threshold)
    kept = materialize(found.filter("row_key = head_key").select("row_key").distinct(), "kept")
    key = "_row_key"
    names = [f.name for f in documents.schema]
    whole = F.struct(*[quoted(c) for c in names])
    others = [quoted(c) for c in names if c not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others), {"ignoreNullFields": "false"}) if others else F.lit("")
    held = documents.select(row_key(["doc_id", "text"]).alias(key), whole.alias("_doc"), rest.alias("_rest"))
    return (
        held.join(kept.withColumnRenamed("row_key", key), key, "left_semi")
        .groupBy(key)
        .agg(F.min_by("_doc", "_rest").alias("_doc"))
        .select(*[F.col("_doc")[c].alias(c) for c in names])
    )
