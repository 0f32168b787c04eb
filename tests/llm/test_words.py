"""Phrases, spelling variants and SentencePiece ids against brute force, SQL and the library."""

import collections
import hashlib
import random
import re
import zlib

import pytest
import sentencepiece
from oracle import connect, differences

from tidegauge.llm import phrases, queries, spm, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, word string, n bigint, phrase string, form string"
NEW = ("op11_phrases", "op12_spelling_variants", "op13_sentencepiece")


def as_documents(spark, rows):
    """(doc_id, text, lang) with further columns, whose names clash with those made inside."""
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    stems = ["winter", "Summer", "harvest", "élève", "candle", "rivers", "mother", "kettle"]

    def word():
        w = rng.choices(stems, weights=range(8, 0, -1))[0]
        kind = rng.randrange(20)
        if kind < 3:
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "a", "z"]) + w[at + (kind > 0):]
        return w

    texts = [
        rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n"]).join(word() for _ in range(rng.randrange(40)))
        for _ in range(300)
    ]
    texts += [None, "", " \t\n", ".,;:!?", "x" * 40_000, "Winter " * 9_000, "a-b c_d 1 2", "ÀÉ×÷ß ÿÿÿÿÿ"]
    texts.append("ladders " * 40 + "laddrs " * 12 + "ladrs " * 4)
    made = [(i, t, [None, "en", "fr", ""][i % 4]) for i, t in enumerate(texts)]
    return made + made[:3] + [(None, texts[0], "en"), (None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return as_documents(spark, rows).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return as_documents(spark, [])


@pytest.mark.parametrize("name", [n for n in NEW if n in queries.ORACLE_SQL])
def test_query_equals_sql(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), connect(small), queries.ORACLE_SQL[name]) is None


def best_phrases(rows, max_words, min_count, top=2000):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in counts.items():
        candidates = {p: n for p, n in c.items() if len(p) > 1 and n >= min_count}
        longer = collections.Counter()
        for p, n in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], n)
        ranked = []
        for p, a in candidates.items():
            if longer[p] and 100 * longer[p] >= 50 * a:
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p))
            )
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        out += [
            (lang, rank, p.decode(), -a, left, right, totals[lang], -score)
            for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1)
        ]
    return sorted(out)


@pytest.mark.parametrize(
    ("shard_words", "max_words", "min_count"),
    [(1 << 20, 3, 10), (500, 3, 10), (40, 4, 3), (2_000, 2, 5)],
)
def test_phrases(docs, rows, shard_words, max_words, min_count):
    """Over one shard with a high local support, some, and very many with a support of one."""
    got = phrases.collocations(docs, min_count, max_words, shard_words=shard_words).collect()
    want = best_phrases(rows, max_words, min_count)
    assert len(want) > 20
    assert sorted(map(tuple, got)) == want


def test_local_support_is_lowered_in_proportion(docs, rows):
    """What shards leave out is what can't be frequent; a global phrase is found in one of them."""
    texts = docs.selectExpr("coalesce(lang, 'und') AS lang", "text")
    total = phrases.word_totals(texts).agg({"n": "sum"}).first()[0]
    found = phrases.shard_counts(texts, range(1, 4), total, 10, 3_000).collect()
    every = phrases.shard_counts(texts, range(1, 4), shard_words=3_000).collect()
    assert len(found) < len(every)
    sums = collections.Counter()
    for r in every:
        sums[r.lang, r.phrase] += r.n
    assert {k for k, n in sums.items() if n >= 10} <= {(r.lang, r.phrase) for r in found}


def test_phrase_scores_past_64_bits(spark):
    """Products of counts have up to 31 digits here."""
    a, left, right = 2 * 10**12, 3 * 10**12 + 7, 10**13 + 9
    counts = spark.createDataFrame(
        [("en", 1, "new", left), ("en", 1, "york", right), ("en", 2, "new york", a)],
        "lang string, words int, phrase string, n bigint",
    )
    (row,) = phrases.scored(counts).collect()
    assert (row.l, row.r, row.score) == (left, right, 1_000_000 * a * a // (left * right))


def test_ranks_of_ties(spark):
    rows = [("en", p, 2, 9, 9, 9, 5) for p in ("b b", "a b", "é a", "z a")]
    rows.append(("en", "c c", 2, 10, 10, 10, 5))
    candidates = spark.createDataFrame(
        rows, "lang string, phrase string, words int, a bigint, l bigint, r bigint, score bigint"
    )
    best = phrases.best(candidates, top=4).orderBy("rank").collect()
    assert [(r["rank"], r.phrase) for r in best] == [(1, "c c"), (2, "a b"), (3, "b b"), (4, "z a")]


def test_no_phrases_of_nothing(empty, spark):
    assert phrases.collocations(empty).count() == 0
    blank = as_documents(spark, [(1, None, "en"), (2, "", None), (3, " .\n", "en")])
    assert phrases.collocations(blank).count() == 0


def variants_of(rows):
    counts = collections.Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 3}
    near, wild = collections.defaultdict(set), collections.defaultdict(list)
    for w in counts:
        for k in range(len(w)):
            wild[w[:k], w[k + 1 :]].append(w)
            less = w[:k] + w[k + 1 :]
            if less in counts:
                near[w].add(less)
                near[less].add(w)
    for group in wild.values():
        for one in group:
            near[one].update(o for o in group if o != one)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [(1 << 16, 64, 1 << 17), (30, 2, 3), (0, 4, 1)])
def test_variants(docs, rows, sizes):
    """With cells and blocks as they are, very small ones, and no sample for the upper trees."""
    got = sorted(map(tuple, variants.spelling_variants(docs, "doc_id", *sizes).collect()), key=repr)
    want = variants_of(rows)
    assert sum(r[1] is not None for r in want) > 20
    assert any(r[2] != r[1] for r in want if r[1])  # paths of more than one step
    assert got == want


def test_words_of_the_same_letters(spark):
    """Anagrams are one point, however many; only the order of letters tells them apart."""
    rng = random.Random(2)
    words = {"".join(rng.sample("abcdefgh", 8)) for _ in range(600)} | {"abcdefghi", "abcdefg"}
    rows = [(i, " ".join(words), "en") for i in range(4)]
    got = variants.spelling_variants(as_documents(spark, rows), block_words=100).collect()
    assert sorted(map(tuple, got), key=repr) == variants_of(rows)


def test_one_edit():
    rng = random.Random(3)
    for _ in range(3_000):
        one = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 8)))
        other = "".join(rng.choice("ab") for _ in range(len(one) + rng.randrange(2)))
        if len(one) == len(other):
            want = sum(a != b for a, b in zip(one, other)) == 1
        else:
            want = any(other[:i] + other[i + 1 :] == one for i in range(len(other)))
        got = variants.one_edit(variants.letters_of([one] * 2), variants.letters_of([other] * 2))
        assert got.tolist() == [want] * 2


def test_upper_cells_cover_what_a_box_reaches():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcde") for _ in range(7)) for _ in range(400)})
    cells = variants.Cells(words[:80], per_cell=3)
    points = variants.points_of(words)
    home = {row: cell for cell, of in cells.of(7, points, 0, 0) for row in of.tolist()}
    assert len(home) == len(words)
    met = collections.defaultdict(set)
    for cell, of in cells.of(7, points, 1, 1):
        for row in of.tolist():
            assert cell not in met[row]
            met[row].add(cell)
    for i, one in enumerate(words):
        for j, other in enumerate(words):
            if sum(a != b for a, b in zip(one, other)) == 1:
                assert home[j] in met[i]
    assert max(home.values()) > 10


def test_no_variants_of_nothing(empty):
    assert variants.spelling_variants(empty).count() == 0


@pytest.fixture(scope="module")
def codec():
    return spm.Codec(spm.read_model())


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=spm.MODEL)


def same(codec, library, text):
    ids, decoded = codec.coded(text)
    want = library.encode(text, add_bos=True, add_eos=True)
    assert ids == b"".join(i.to_bytes(4, "little") for i in want), text[:80]
    assert decoded == library.decode(want), text[:80]


def test_ids_equal_the_library(codec, library, rows):
    rng = random.Random(6)
    fixed = ["", " ", "  a  b ", "a\nb\t\n", "▁x ▁", "a\0b", "ﬁ½Ａ", "<s>x</s><0x41>", "日本語 😀", " " * 99, "abc" * 999]
    tokens = codec.of.tokens
    made = ["".join(rng.choices(tokens, k=rng.randrange(1, 25))) for _ in range(1_500)]
    made += ["".join(rng.choices("etaoin shr▁\n\té", k=rng.randrange(1, 150))) for _ in range(500)]
    made += ["".join(chr(rng.randrange(1, 0xD800)) for _ in range(30)) for _ in range(200)]
    for text in fixed + made + [t or "" for _, t, _ in rows]:
        same(codec, library, text)


def test_ids_of_a_small_vocabulary():
    """Equal scores go to the left; a letter inside a piece need not be a piece."""
    scores = {"a": -9.0, "b": -9.0, "ab": -1.0, "ba": -1.0, "aba": -2.0, "bab": -0.5, "xa": -3.0, "▁": -9.0, "▁a": -1.5}
    pieces = {p: (s, 300 + i) for i, (p, s) in enumerate(scores.items())}
    small = spm.Codec(spm.Vocabulary(pieces, list(range(3, 259)), 1, 2))

    def by_merging(text):
        symbols = list(text)
        while True:
            ways = [(-scores[s + t], i) for i, (s, t) in enumerate(zip(symbols, symbols[1:])) if s + t in scores]
            if not ways:
                break
            _, i = min(ways)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return [j for s in symbols for j in ([pieces[s][1]] if s in pieces else [3 + b for b in s.encode()])]

    rng = random.Random(7)
    for _ in range(3_000):
        text = "".join(rng.choice("aabbx▁é") for _ in range(rng.randrange(1, 14)))
        assert small.ids(text) == by_merging(text), text


def test_query_equals_the_library(spark, small, library):
    table = queries.table(spark, small, "documents").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_sentencepiece(spark, small).collect()}
    assert len(got) == len(table)
    for row in table:
        ids = library.encode(row.text or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert got[row.doc_id] == (len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest())


def test_encoded_keeps_rows(docs, rows, empty):
    got = collections.Counter(r.doc_id for r in spm.encoded(docs).collect())
    assert got == collections.Counter(r[0] for r in rows)
    assert spm.encoded(empty).count() == 0
