"""Benchmark decontamination by a prefix-filtered set join.

A window of an item (13 consecutive words, or the whole of a shorter item) is a
set of word shingles with their places. A document holds the window only if it
holds every shingle of it, so one shingle is a necessary prefix: the one that is
rarest in the documents. Documents are joined with the windows on those shingles
alone, bounds on place and length drop what cannot fit, and the words of what is
left are compared one for one.

Neither side is broadcast. Tasks know the shingles to look for from a bitmap of
fixed size; what it lets through by chance is dropped in the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.batches import map_arrow, words
from tidegauge.session import materialize

WINDOW = 13
SHINGLE = 5
BITMAP_BITS = 24

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (item, words, n, k, shingles): the windows of each item, words joined by a blank.

    ``k`` is the number of words in a shingle: five, or all of a shorter window.
    Items without words, or of null text, have no window. Null ids count as ``""``.
    """

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        ids = batch.column("item").to_pylist()
        for w in words(batch.column("text")):
            bounds = np.searchsorted(w.row, np.arange(w.first, w.last + 1))
            out: dict[str, list] = {c: [] for c in ("item", "words", "n", "k", "shingles")}
            hashes = {k: w.shingles(k)[0] for k in range(1, SHINGLE + 1)}
            for row, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), w.first):
                n = min(window, b - a)
                k = min(SHINGLE, n)
                for i in range(a, b - n + 1 if n else a):
                    said = [w.data[w.start[j] : w.end[j]].tobytes() for j in range(i, i + n)]
                    out["item"].append(ids[row])
                    out["words"].append(b" ".join(said).decode())
                    out["n"].append(n)
                    out["k"].append(k)
                    out["shingles"].append(hashes[k][i : i + n - k + 1].view(np.int64).tolist())
            yield out

    source = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )
    return map_arrow(
        source, rows, "item string, words string, n int, k int, shingles array<bigint>"
    )


def _bitmaps(shingles: DataFrame) -> dict[int, np.ndarray]:
    """By shingle length, a bitmap of the hashes: a fixed size, whatever their number."""
    slot = F.col("shingle").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    bits = (
        shingles.select("k", slot.alias("slot"))
        .groupBy("k", F.shiftright("slot", 5).alias("cell"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 31 AS INT))")).alias("bits"))
    )
    maps: dict[int, np.ndarray] = {}
    for k, cell, value in bits.collect():
        at = maps.setdefault(k, np.zeros(1 << (BITMAP_BITS - 5), np.uint32))
        at[cell] = value
    return maps


def _listed(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64((1 << BITMAP_BITS) - 1)
    return (bitmap[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & 1 == 1


def shingle_counts(documents: DataFrame, shingles: DataFrame) -> DataFrame:
    """How often each listed (k, shingle) occurs in all documents; those that don't are left out."""
    maps = documents.sparkSession.sparkContext.broadcast(_bitmaps(shingles))

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for w in words(batch.column("text")):
            for k, bitmap in maps.value.items():
                h, ok = w.shingles(k)
                h, n = np.unique(h[ok & _listed(bitmap, h)], return_counts=True)
                yield {"k": np.full(len(h), k, np.int32), "shingle": h, "n": n}

    seen = map_arrow(documents.select("text"), rows, "k int, shingle bigint, n bigint")
    return seen.groupBy("k", "shingle").agg(F.sum("n").alias("seen"))


def rarest_shingles(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its rarest shingle and the place of that; windows that can't occur go."""
    placed = windows.select("words", "n", "k", F.posexplode("shingles").alias("place", "shingle"))
    rarest = F.min_by(F.struct("place", "shingle"), F.struct("seen", "shingle", "place"))
    return (
        placed.join(counts, ["k", "shingle"], "left")
        .groupBy("words", "n", "k")
        .agg(
            rarest.alias("rarest"),
            (F.count("seen") == F.count(F.lit(1))).alias("possible"),
        )
        .filter("possible")
        .select("words", "n", "k", "rarest.place", "rarest.shingle")
    )


def candidates(documents: DataFrame, prefixes: DataFrame, window: int = WINDOW) -> DataFrame:
    """Each document (its columns but the text) with its word count and candidate places.

    A candidate is a place whose shingle is a prefix of some window, with the words
    around it that any window through it can reach.
    """
    maps = documents.sparkSession.sparkContext.broadcast(_bitmaps(prefixes))
    kept = [c for c in documents.columns if c != "text"]
    reach = window - SHINGLE

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        for w in words(batch.column("text")):
            found: list[list[dict]] = [[] for _ in range(w.last - w.first)]
            bounds = np.searchsorted(w.row, np.arange(w.first, w.last + 1))
            for k, bitmap in maps.value.items():
                h, ok = w.shingles(k)
                beside = reach if k == SHINGLE else 0
                for i in np.flatnonzero(ok & _listed(bitmap, h)).tolist():
                    row = int(w.row[i]) - w.first
                    a = max(i - beside, int(bounds[row]))
                    b = min(i + k + beside, int(bounds[row + 1]))
                    around = _WORD.findall(w.data[w.start[a] : w.end[b - 1]].tobytes())
                    found[row].append(
                        {
                            "k": k,
                            "shingle": int(h[i : i + 1].view(np.int64)[0]),
                            "at": i - int(bounds[row]),
                            "before": i - a,
                            "around": b" ".join(around).decode(),
                        }
                    )
            own = batch.slice(w.first, w.last - w.first)
            yield {c: own.column(c) for c in kept} | {"_words": w.counts(), "_found": found}

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema if f.name in kept)
    found = "array<struct<k:int,shingle:bigint,at:int,before:int,around:string>>"
    return map_arrow(documents, rows, f"{fields}, _words bigint, _found {found}")


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id"
) -> DataFrame:
    """One row per row of ``documents``: how much of it lies in windows of ``benchmark``.

    Columns: the id, n_words, n_hit (words inside any occurrence of a window),
    n_items (items with occurring windows), items (their ids as strings, sorted),
    contaminated (n_hit > 0 and 20 * n_hit >= n_words).

    Null or empty texts have no words and are not contaminated; repeated rows and
    null ids are kept apart, one result each; an empty benchmark marks nothing.
    Other columns of either table are not read.
    """
    windows = materialize(item_windows(benchmark, window), "windows")
    texts = documents.select(F.col(id_col).alias("id"), "text")
    shingles = windows.select("k", F.explode("shingles").alias("shingle")).distinct()
    counts = shingle_counts(texts, shingles)
    distinct = windows.dropDuplicates(["words"])
    prefixes = materialize(rarest_shingles(distinct, counts), "prefixes")
    marked = materialize(
        candidates(texts, prefixes.select("k", "shingle").distinct(), window).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "candidates",
    )
    place = F.col("before") - F.col("place")
    said = F.split("around", " ")
    hits = (
        marked.select("_row", F.inline("_found"))
        .join(prefixes, ["k", "shingle"])
        .filter((place >= 0) & (place + F.col("n") <= F.size(said)))
        .filter(F.array_join(F.slice(said, place + 1, F.col("n")), " ") == F.col("words"))
        .select("_row", (F.col("at") - F.col("place")).alias("start"), "n", "words")
    )
    hits = materialize(hits, "hits")
    end = F.col("start") + F.col("n")
    reached = F.max(end).over(
        Window.partitionBy("_row").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = (
        hits.select("_row", "start", "n")
        .distinct()
        .select("_row", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(reached, F.lit(0)))).alias("new"))
        .groupBy("_row")
        .agg(F.sum("new").alias("_hit"))
    )
    items = (
        hits.select("_row", "words")
        .distinct()
        .join(windows.select("words", "item").distinct(), "words")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_set("item")).alias("_items"))
    )
    no_items = F.array().cast("array<string>")
    n_hit = F.coalesce("_hit", F.lit(0)).cast("bigint")
    return (
        marked.select("_row", "id", "_words")
        .join(covered, "_row", "left")
        .join(items, "_row", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("_words").alias("n_words"),
            n_hit.alias("n_hit"),
            F.coalesce(F.size("_items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("_items", no_items).alias("items"),
            ((n_hit > 0) & (20 * n_hit >= F.col("_words"))).alias("contaminated"),
        )
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that are not contaminated, with all their columns.

    A row is judged with its own text, also where its id occurs more than once.
    """
    keyed = documents.withColumn("_key", F.md5(F.coalesce("text", F.lit(""))))
    texts = keyed.select("_key", "text")
    bad = (
        contamination(texts, benchmark, id_col="_key")
        .filter("contaminated")
        .select("_key")
        .distinct()
    )
    return keyed.join(materialize(bad, "contaminated"), "_key", "left_anti").drop("_key")
