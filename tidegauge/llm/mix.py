"""Mixing sources to target weights by capped water-filling.

Sources share the words of the whole corpus by weight. A source stops at
``max_epochs`` times its own size and what it leaves goes to the others by their
weights, until none is above its cap.

The target of a source, rounded to a word, is taken in whole documents: all documents
of the source are repeated equally often, and the rest of the words, less than one
repetition of the source, is dealt to documents in the order of a seeded hash. One
document of a source at most is cut, the one at which the words run out. ``mixture``
gives the words taken of each document, ``mixed_documents`` the repetitions themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.columns import quoted
from tidegauge.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
KEY_DIGITS, DIGIT_BITS = 15, 10
KEY_BITS = 4 * KEY_DIGITS


def n_words(text: str = "text") -> Column:
    """Words in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 by code point, null last, without a global sort in one task."""
    order = F.col("source").asc_nulls_last()
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(
        sources.repartitionByRange(n, order).withColumn("part", F.spark_partition_id()), "sources"
    )
    before, starts = 0, {}
    for part, count in sorted(dealt.groupBy("part").count().collect()):
        starts[part] = before
        before += count
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    base = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair]) if starts else None
    return dealt.withColumn("rank", inside + (base[F.col("part")] if starts else F.lit(0))).drop("part")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    The cap is found in rounds; each round fixes the sources above their cap and
    brings two sums back, whatever the number of sources.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = materialize(
        _ranked(sums).select(
            "source", "source_size", F.get(cycle, F.col("rank") % len(weights)).alias("weight")
        ),
        "weights",
    )
    cap = F.lit(max_epochs) * F.col("source_size")
    total, share = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
    ).first()
    level, full = (total / share if share else 0.0), -1
    while share:
        above = sources.filter(cap < F.col("weight") * F.lit(level))
        n, fixed, gone = above.agg(F.count(F.lit(1)), F.sum(cap), F.sum("weight")).first()
        if n == full or n == 0:
            break
        full, level = n, (total - fixed) / (share - gone)
    aimed = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.select("source", "source_size", aimed.alias("target"))


def mixture(documents: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``taken`` counts the words the mix takes of the document, repeats counted: the sum
    of ``n_words_taken`` of its rows in ``mixed_documents``, never above ``max_epochs``
    times the size. Over a source it is the target, rounded. Null texts have size 0,
    null sources are one source, repeated rows are documents of their own, an empty
    table gives no rows. Other columns are not read.
    """
    sized, targets = _sized(documents, max_epochs, seed)
    taken = _with_taken(sized, sized, targets, F.col("doc_id"))
    t = targets.withColumnRenamed("source", "_source")
    return taken.join(t, F.col("source").eqNullSafe(F.col("_source"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def _sized(documents: DataFrame, max_epochs: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, source, size, key) and rows (source, source_size, target)."""
    sized = materialize(
        documents.select("doc_id", "source", n_words().alias("size"), _key(seed).alias("key")), "sizes"
    )
    return sized, materialize(source_targets(sized, max_epochs=max_epochs), "targets")


def _key(seed: str) -> Column:
    """The place of a document in the order of the draw, from its id and text."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    digest = F.md5(F.concat_ws(":", F.lit(seed), *said))
    return F.conv(F.substring(digest, 1, KEY_DIGITS), 16, 10).cast("bigint")


def _cuts(keyed: DataFrame, budgets: DataFrame) -> tuple[DataFrame, int, bool]:
    """Where the words of each source run out in the order of the keys.

    Rows (_source, whole, left, cut, n), from rows (source, key, size) and rows
    (_source, whole, left), and how many low bits of a key are to be left off before
    it is compared with ``cut``: documents below it are drawn whole, the ``n`` at it
    share ``left`` words. Each round fixes some bits, until one document is left at
    every cut; the last value tells that documents of one key remain. A source has
    1,024 sums in a round, whatever its size.
    """
    at, bits, tied = budgets.withColumn("cut", F.lit(0).cast("bigint")), KEY_BITS, True
    while tied and bits:
        inside = keyed.join(
            at,
            F.col("source").eqNullSafe(F.col("_source")) & (F.shiftright("key", bits) == F.col("cut")),
        ).drop("cut")
        bits -= DIGIT_BITS
        sums = inside.groupBy("_source", "whole", "left", F.shiftright("key", bits).alias("cut")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")
        )
        before = F.sum("words").over(Window.partitionBy("_source").orderBy("cut")) - F.col("words")
        left = F.col("left") - F.col("before")
        at = materialize(
            sums.withColumn("before", before)
            .filter((left >= 0) & (left < F.col("words")))
            .select("_source", "whole", left.alias("left"), "cut", "n"),
            "cuts",
        )
        tied = not at.filter("n > 1").isEmpty()
    return at, bits, tied


def _with_taken(rows: DataFrame, sized: DataFrame, targets: DataFrame, order: Column) -> DataFrame:
    """Adds ``taken`` to rows (source, key, size, ...); ``order`` is that of rows of one key."""
    words = F.floor(F.col("target") + 0.5).cast("bigint")
    whole = F.expr("words div source_size")
    budgets = (
        targets.filter("source_size > 0")
        .withColumn("words", words)
        .select(
            F.col("source").alias("_source"),
            whole.alias("whole"),
            (F.col("words") - whole * F.col("source_size")).alias("left"),
        )
    )
    keyed = sized.filter("size > 0").select("source", "key", "size")
    cuts, bits, tied = _cuts(keyed, materialize(budgets, "budgets"))
    place = F.when(F.col("size") > 0, F.shiftright("key", bits))
    marked = rows.join(cuts, F.col("source").eqNullSafe(F.col("_source")), "left").withColumn("place", place)
    drawn = F.when(F.col("place") < F.col("cut"), F.col("size")).when(F.col("place") == F.col("cut"), F.col("left"))
    if tied:
        same = Window.partitionBy("_source").orderBy("size", order)
        before = F.coalesce(F.sum("size").over(same.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.least(F.greatest(F.col("left") - before, F.lit(0)), F.col("size"))
        at_cut = F.coalesce(F.col("place") == F.col("cut"), F.lit(False))
        marked = (
            marked.filter(~at_cut)
            .withColumn("drawn", drawn)
            .unionByName(marked.filter(at_cut).withColumn("drawn", rest))
        )
    else:
        marked = marked.withColumn("drawn", drawn)
    taken = F.coalesce("whole", F.lit(0)) * F.col("size") + F.coalesce("drawn", F.lit(0))
    return marked.withColumn("taken", taken.cast("bigint")).drop(
        "_source", "whole", "left", "cut", "n", "place", "drawn"
    )


def mixed_documents(documents: DataFrame, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: one row per repetition, numbered from 0, with all columns.

    A source gives as many words as ``mixture`` takes of it. Texts are whole but for
    one repetition of one document of a source, which may be cut to its first words.
    Documents of which nothing is taken are left out. Rows alike in id and text that
    meet at the cut are told apart in one task.
    """
    sized, targets = _sized(documents, max_epochs, seed)
    held = documents.select(
        F.struct(*[quoted(c) for c in documents.columns]).alias("_doc"),
        "source",
        n_words().alias("size"),
        _key(seed).alias("key"),
    ).filter("size > 0")
    taken = _with_taken(held, sized, targets, F.to_json("_doc")).filter("taken > 0")
    last = F.ceil(F.col("taken") / F.col("size")) - 1
    each = taken.select(
        "_doc", "size", "taken", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("repetition")
    )
    words_here = F.least(F.col("size"), F.col("taken") - F.col("repetition") * F.col("size"))
    parts = F.split("_doc.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.array_join(F.slice(parts, F.lit(1), words_here.cast("int")), "")
    text = F.when(words_here < F.col("size"), cut).otherwise(F.col("_doc.text"))
    columns = [
        text.alias(c) if c == "text" else F.col("_doc")[c].alias(c)
        for c in documents.columns
        if c not in ("repetition", "n_words_taken")
    ]
    return each.select(*columns, "repetition", words_here.alias("n_words_taken"))
