"""Stages and corpus operators on odd names, ties, copies, long texts and empty tables."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidegauge.llm import fingerprints, jaccard, language, mix

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = "`my-col x` string, `a.b` bigint, `_doc` string, `key` string, `taken` bigint"
WORDS = {"en": "the quick brown fox and the lazy dog with a", "de": "der schnelle braune fuchs und der faule hund mit"}


def made(n=60):
    rows = []
    for i in range(n):
        lang = "de" if i % 3 else "en"
        rows.append((i, f"{WORDS[lang]} {i} {WORDS[lang]} x{i}\nfooter of all", lang, f"s{i % 2}", 0))
    long = " ".join(f"{w}{i}" for i in range(20_000) for w in WORDS["en"].split())
    rows += [(900, long, "en", "s0", 0), (901, None, "en", "s1", 0), (902, "", None, None, 0)]
    return rows + [(None, WORDS["en"], "en", None, 0), rows[0], rows[0], (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "o", i, "d", "k", 1) for i, r in enumerate(made())], f"{SCHEMA}, {ODD}")


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_any_columns_and_rows(spark, small, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, small)
    last = name == corpus_pipeline.STAGES[-1][0]
    assert got.columns[: len(docs.columns)] == docs.columns and (last or got.columns == docs.columns)
    rows = got.collect()
    ids = {r.doc_id for r in rows}
    assert ids >= set(range(60)) or (last and ids)  # the mix leaves documents out
    assert {r["my-col x"] for r in rows} == {"o"} and all(r["a.b"] is not None for r in rows)
    if name in ("line_dedup", "mixing"):
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)
    assert stage(spark, docs.limit(0), small).count() == 0


def test_letters_decide_what_is_undetermined(spark, docs):
    model = language.train(docs.select("text", "lang"))
    assert model.languages == ["de", "en"]
    for text in ("½ ²", "①②", "१२", "_ 1", "", " ", None, "€"):
        assert model.predict(text) == ("und", 0.0)
    for text in ("x", "½ ä", "ʰ", "中"):
        assert model.predict(text)[0] in ("de", "en")


def test_copies_do_not_enlarge_the_sample(spark, monkeypatch):
    rows = [(f"text {i} of many words", "en") for i in range(300)] + [("one copied text", "en")] * 3000
    rows += [(f"satz {i} aus worten", "de") for i in range(300)]
    seen = []
    fit = language._fit
    monkeypatch.setattr(language, "_fit", lambda sample, *rest: seen.append(sample) or fit(sample, *rest))
    language.train(spark.createDataFrame(rows, "text string, lang string"), sample_rows=100_000)
    texts = [r.text for r in seen[0].collect()]
    assert len(texts) == len(set(texts)) == 601


def test_of_rows_alike_the_first_as_json_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text, "en", s, n) for s, n in (("b", 1), ("a", 2), (None, 3), ("a", 10))]
    for order in (rows, rows[::-1]):
        kept = jaccard.one_of_each_class(spark.createDataFrame(order, SCHEMA).repartition(3)).collect()
        assert [(r.source, r.n_chars) for r in kept] == [("a", 10)]


def test_taken_is_what_the_repetitions_hold(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(i % 13)), "en", f"s{i % 4}", 0) for i in range(200)]
    rows += [(None, "one two three", "en", "s1", k) for k in range(40)] + [(500, "a b c d", "en", "s1", 0)] * 30
    rows += [(600, "few", "en", "t", 0), (601, None, "en", "none", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken, held, by = collections.Counter(), collections.Counter(), collections.Counter()
    for r in mix.mixture(docs).collect():
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.doc_id] += r.taken
        by[r.source_size, r.target] += r.taken
    assert all(abs(n - target) <= 0.5 for (_, target), n in by.items())
    for r in mix.mixed_documents(docs).collect():
        held[r.doc_id] += r.n_words_taken
    assert +taken == held
    whole = sum(r.taken % r["size"] == 0 for r in mix.mixture(docs).filter(F.col("size") > 0).collect())
    assert whole >= docs.filter(F.length("text") > 0).count() - 6


@pytest.mark.parametrize("chunk", [1, 2, 3, 7])
@pytest.mark.parametrize("text", ["", "a", "ab", "Ab é", "one two  three 4 fünf", "x" * 15])
def test_features_do_not_depend_on_the_chunk(monkeypatch, chunk, text):
    whole = language.features(text)
    monkeypatch.setattr(language, "CHUNK", chunk)
    cut = language.features(text)
    assert [a.tolist() for a in whole] == [a.tolist() for a in cut]


def test_features_by_hand():
    assert language.features("")[1].sum() == 1  # the pair of blanks around an empty text
    assert language.features("ab")[1].sum() == 2 + 3 + 2


def test_containment_of_a_short_text_is_never_a_false_zero(spark):
    host = [f"w{i}" for i in range(2_000)]
    rows = [(" ".join(host[i * 4 : i * 4 + 9]), " ".join(host)) for i in range(200)]
    rows.append(("quite other words than any of those", " ".join(host)))
    rows += [("", " ".join(host)), (None, "a b")]
    df = spark.createDataFrame(rows, "a string, b string")
    df = fingerprints.with_sketch(fingerprints.with_sketch(df, "a", "sa"), "b", "sb")
    got = df.select(
        fingerprints.containment("sa", "sb").alias("c"),
        fingerprints.merged("sa", "sb").alias("m"), "sb",
    ).collect()
    assert {r.c for r in got[:200]} == {1.0, None}
    assert got[200].c in (0.0, None) and got[201].c == got[202].c == 1.0
    assert all(r.m == r.sb for r in got[:200])  # the union's sketch is the host's
