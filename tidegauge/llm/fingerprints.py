"""Document fingerprints: sketches that keep every shingle hash below a threshold.

A sketch keeps a fixed fraction of the distinct shingle hashes of a text, so
sketches of a short and of a very long text are comparable, their union is the
sketch of both texts, and containment is estimated from what they share.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 4  # one hash in so many is kept
BUCKETS_PER_PARTITION = 4

_BREAK = r"[\x20\x09-\x0D]+"
_HASHES = "array<bigint>"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _BREAK, -1), lambda w: w != "")


def _shingle_hashes(words: str) -> Column:
    w = F.col(words)
    each = F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]),
    )
    return (
        F.when(F.size(w) >= SHINGLE, each)
        .when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " "))))
        .otherwise(F.array().cast(_HASHES))
    )


def with_sketch(df: DataFrame, text: str, sketch: str, fraction: int = FRACTION) -> DataFrame:
    """Adds the sketch of a text column: sorted distinct hashes.

    Shingles are five words, or all words of a shorter text. Of a text none of
    whose hashes is below the threshold the least hash is kept, so only texts
    without words (null, empty, blank) have an empty sketch.
    """
    words, hashes = f"_{sketch}_words", f"_{sketch}_hashes"
    below = -(1 << 63) + (1 << 64) // fraction
    kept = F.filter(hashes, lambda h: h < below)
    least = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(F.col(hashes))
    return (
        df.withColumn(words, _words(F.coalesce(F.col(text), F.lit(""))))
        .withColumn(hashes, _shingle_hashes(words))
        .drop(words)
        .withColumn(sketch, F.array_sort(F.array_distinct(kept)))
        .withColumn(sketch, F.when(F.size(sketch) > 0, F.col(sketch)).otherwise(least))
        .drop(hashes)
    )


def _below(sketch: str, fraction: int) -> Column:
    below = -(1 << 63) + (1 << 64) // fraction
    return F.filter(sketch, lambda h: h < below)


def merged(a: str, b: str, fraction: int = FRACTION) -> Column:
    """The sketch of two texts together: hashes below the threshold, else the least of both."""
    strict = _below(F.array_union(a, b), fraction)
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, 1)
    return F.when(F.size(strict) > 0, F.array_sort(strict)).otherwise(least)


def containment(a: str, b: str, fraction: int = FRACTION) -> Column:
    """Estimated share of the shingles of one text that are in the other (of ``a`` in ``b``).

    1 if ``a`` has no words. Null, not 0, if no hash of ``a`` lies below the threshold and
    ``b`` doesn't have the one it keeps: a longer text's sketch holds nothing to find it by.
    """
    strict = _below(a, fraction)
    shared = F.size(F.array_intersect(strict, F.col(b))) / F.size(strict)
    return (
        F.when(F.size(strict) > 0, shared)
        .when(F.size(a) == 0, 1.0)
        .when(F.size(F.array_intersect(a, b)) > 0, 1.0)
    )


def likeness(a: str, b: str) -> Column:
    """Containment of the smaller sketch in the larger; 1 of two empty ones, 0 of one."""
    least = F.least(F.size(a), F.size(b))
    both = F.when(F.size(a) == F.size(b), 1.0).otherwise(0.0)
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(both)


def as_text(sketch: str) -> Column:
    """A sketch as a string: 16 hex digits a hash, in order."""
    return F.array_join(
        F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), ""
    )


def _bucket(bounds: list[int]) -> Column:
    """The number of bounds at or below ``doc_id``, found in two steps; null: 0."""
    width = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    if not groups:
        return F.lit(0)
    tops = F.lit([g[0] for g in groups])
    rests = F.array(*[F.lit(g) for g in groups])
    top = F.size(F.filter(tops, lambda b: b <= F.col("doc_id")))
    inner = F.size(F.filter(F.get(rests, top - 1), lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull() | (top == 0), 0).otherwise((top - 1) * width + inner)


def with_next(documents: DataFrame, prepare=lambda df: df) -> DataFrame:
    """Rows (doc_id, text, ..., next): each row beside the next by doc_id, the last beside the first.

    Rows are dealt into ranges of ``doc_id``; each range also gets the first row of
    the following one, so each row moves once and no task sees more than a range.
    Only the bounds of the ranges, a fixed number, go through the driver. Rows of
    one id go by their text; null ids come first. ``prepare`` may add columns to
    the dealt rows; ``next`` is a struct of all columns.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / n for i in range(1, n)]
    found = docs.agg(F.percentile_approx("doc_id", cuts, 100 * n)).first()[0] or []
    docs = docs.withColumn("bucket", _bucket(sorted(set(found))))
    heads = sorted(docs.groupBy("bucket").agg(F.min(F.struct("doc_id")).alias("head")).collect())
    if heads:
        size = heads[-1]["bucket"] + 1
        first: list[int | None] = [None] * size
        before: list[int] = [-1] * size
        for i, (bucket, head) in enumerate(heads):
            first[bucket], before[bucket] = head["doc_id"], heads[i - 1]["bucket"]
        firsts = F.array(*[F.lit(x).cast("bigint") for x in first])
        befores = F.array(*[F.lit(x) for x in before])
    else:
        firsts, befores = F.array().cast("array<bigint>"), F.array().cast("array<int>")
    halo = (
        docs.filter(F.col("doc_id").eqNullSafe(F.get(firsts, F.col("bucket"))))
        .groupBy("bucket")
        .agg(F.min(F.struct("doc_id", "text")).alias("d"))
        .select("d.doc_id", "d.text", F.get(befores, F.col("bucket")).alias("bucket"), F.lit(1).alias("halo"))
    )
    dealt = docs.withColumn("halo", F.lit(0)).unionByName(halo).repartition("bucket")
    ready = prepare(dealt)
    order = Window.partitionBy("bucket").orderBy(
        "halo", F.col("doc_id").asc_nulls_first(), "text"
    )
    held = [c for c in ready.columns if c not in ("bucket", "halo", "doc_id")]
    return (
        ready.withColumn("next", F.lead(F.struct(*held)).over(order))
        .filter("halo = 0")
        .drop("bucket", "halo")
    )


def fingerprints_of_edits(documents: DataFrame, fraction: int = FRACTION) -> DataFrame:
    """Fingerprints of each text and of its edit, whose last quarter comes from the next text.

    Columns: doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next. Null texts are empty. One row per row of ``documents``; other
    columns are not read.
    """
    rows = with_next(documents, lambda df: with_sketch(df, "text", "sketch", fraction))
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - quarter), F.substring("next.text", F.lit(1), quarter)
    )
    rows = rows.select(
        "doc_id",
        n.cast("bigint").alias("n_chars"),
        edited.alias("edited"),
        "sketch",
        F.col("next.sketch").alias("next_sketch"),
    )
    return with_sketch(rows, "edited", "edited_sketch", fraction).select(
        "doc_id",
        "n_chars",
        "edited",
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
    )
