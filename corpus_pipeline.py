"""The corpus pipeline: stages that each take and keep the columns of ``documents``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm import decontaminate, jaccard, language, mix, site_lines
from tidegauge.llm.columns import quoted
from tidegauge.session import prepare, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: not ``und``, and scored above chance."""
    model = language.train(docs.filter(~language.held_out()).select("text", "lang"))
    least = language.min_score(len(model.languages))
    known = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= least)
    held = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("doc"))
    return language.predict(held, model, inside="doc").filter(known).select("doc.*")


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that are boilerplate of their source; all rows stay.

    Copies count once, as the next stage keeps one of them and needs its lines.
    """
    kept = site_lines.without_boilerplate(docs, distinct=True).select(*[quoted(c) for c in docs.columns])
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.one_of_each_class(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the contamination rule doesn't mark."""
    benchmark = prepare(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per repetition that the mix takes of a document; ``n_chars`` is of the text taken."""
    return mix.mixed_documents(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_languages),
    ("line_dedup", drop_site_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Language ID is learned and the mix draws hashes by rows, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
