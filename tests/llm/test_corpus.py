"""Corpus operators against brute force and SQL, and on awkward input."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from oracle import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from tidegauge.llm import (
    chat,
    ctw,
    decontaminate,
    fingerprints,
    jaccard,
    language,
    mix,
    queries,
    repeats,
    scoring,
    site_lines,
    tokens,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, spans string"


@pytest.fixture(scope="module")
def rows():
    long = " ".join(f"word{i}é" for i in range(3000))
    base = " ".join(f"w{i}" for i in range(60))
    texts = [
        None, "", " \n ", "!!!", "one", "One two", base, base, base + " tail", "Head " + base,
        long, long[:9000] + " cut", "x" * 1500, "ab" * 900, base.upper(), "\\ [INST] <s>\n",
    ]
    made = [(i, t, "en" if i % 2 else None, None if i % 5 == 0 else f"s{i % 3}", 0, "x", "y") for i, t in enumerate(texts)]
    return made + [made[6], (None, base, "de", "s1", 0, "x", "y"), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark):
    items = [(1, " ".join(f"W{i}" for i in range(20, 50)), "x"), (2, "one", "x"), (3, None, "x"), (None, "", "x")]
    return spark.createDataFrame(items, "item_id bigint, text string, words string")


def item_words(text):
    return ITEM_WORD.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), connect(small), queries.ORACLE_SQL[name]) is None


def test_contamination(docs, rows, benchmark, empty):
    got = collections.Counter(
        (r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontaminate.contamination(docs, benchmark).collect()
    )
    windows = collections.defaultdict(set)
    for item, text in ((1, " ".join(f"w{i}" for i in range(20, 50))), (2, "one")):
        w = text.split()
        n = min(13, len(w))
        for i in range(len(w) - n + 1):
            windows[tuple(w[i : i + n])].add(str(item))
    want = collections.Counter()
    for doc_id, text, *_ in rows:
        w, hit, items = item_words(text), set(), set()
        for window, of in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    items |= of
        want[doc_id, len(w), len(hit), tuple(sorted(items))] += 1
    assert got == want
    assert decontaminate.contamination(empty, benchmark).count() == 0
    assert decontaminate.without_contaminated(docs, benchmark).columns == docs.columns


@pytest.mark.parametrize("keep_first", [False, True])
def test_repeats(docs, rows, empty, keep_first, monkeypatch):
    monkeypatch.setattr(repeats, "UNIT_BLOCKS", 2)
    size = 60
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    seen = collections.Counter(b[s : s + size] for _, b in raw for s in range(len(b) - size + 1))
    met, want = set(), collections.Counter()
    for doc_id, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            part = b[s : s + size]
            if (part in met) if keep_first else seen[part] > 1:
                gone[s : s + size] = b"\1" * size
            met.add(part)
        want[doc_id, bytes(x for x, g in zip(b, gone) if not g)] += 1
    got = collections.Counter()
    for r in repeats.without_repeats(docs.coalesce(1), min_bytes=size, keep_first=keep_first).collect():
        got[r.doc_id, bytes(r.kept)] += 1
    if keep_first:  # rows alike in id and text count as occurrences of each other
        got = {k: n for k, n in got.items() if k[0] != 6}
        want = {k: n for k, n in want.items() if k[0] != 6}
    assert got == want
    assert repeats.without_repeats(empty).count() == 0


def test_suffix_ranks_leave_out_what_is_met_once(monkeypatch):
    rng = np.random.default_rng(7)
    length, passage = 50, bytes(rng.integers(97, 123, 120, np.uint8))
    for letters in (2, 3, 26):
        blocks = [bytes(rng.integers(97, 97 + letters, n, np.uint8)) for n in (50, 51, 200, 333, 90)]
        blocks += [blocks[2][20:90], b"a" * 120, b"a" * 70, b"x" + passage, passage + b"y", blocks[3][:60] + blocks[0]]
        data, sizes = b"".join(blocks), np.array([len(b) for b in blocks])
        ends = np.cumsum(sizes)
        begin = np.concatenate([np.arange(e - z, e - length + 1) for e, z in zip(ends, sizes)])
        parts = [data[s : s + length] for s in begin.tolist()]
        ranks = repeats.suffix_ranks(np.frombuffer(data, np.uint8), length, begin)
        seen, of = collections.Counter(parts), collections.defaultdict(set)
        for part, rank in zip(parts, ranks.tolist()):
            of[part].add(rank)
            assert rank >= 0 or seen[part] == 1
        told = {p: r for p, (r, *more) in ((p, sorted(x)) for p, x in of.items()) if r >= 0 and not more}
        assert set(told) >= {p for p, n in seen.items() if n > 1} and len(set(told.values())) == len(told)
        assert sorted(told, key=told.get) == sorted(told)
    # blocks that share a gram and no more are not sorted once it is passed
    gram, sorted_ = passage[:32], []
    blocks = [bytes(rng.integers(97, 123, 384, np.uint8)) + gram + bytes(rng.integers(97, 123, 384, np.uint8)) for _ in range(50)]
    data = np.frombuffer(b"".join(blocks), np.uint8)
    begin = np.concatenate([np.arange(i * 800 + 100, i * 800 + 300) for i in range(50)])
    unique = np.unique
    monkeypatch.setattr(np, "unique", lambda x, **how: (sorted_.append(len(x)), unique(x, **how))[1])
    assert (repeats.suffix_ranks(data, 400, begin) == -1).all()
    assert sum(sorted_) < 2 * len(data)


def test_fingerprints(docs, rows, empty):
    got = fingerprints.fingerprints_of_edits(docs).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = collections.Counter()
    for r, after in zip(order, order[1:] + order[:1]):
        text, q = r[1] or "", len(r[1] or "") // 4
        want[r[0], len(text), text[: len(text) - q] + (after[1] or "")[:q]] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited) for r in got) == want
    sketches = collections.Counter()
    for r, after in zip(order, order[1:] + order[:1]):
        text, q = r[1] or "", len(r[1] or "") // 4
        edited = text[: len(text) - q] + (after[1] or "")[:q]
        own, other, beside = sketch_of(text), sketch_of(edited), sketch_of(after[1] or "")
        sketches[r[0], as_text(own), as_text(other), like(own, other), like(own, beside)] += 1
    assert sketches == collections.Counter(
        (r.doc_id, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got
    )
    assert len({r.fingerprint for r in got if r.doc_id in (6, 7)}) == 1
    assert fingerprints.fingerprints_of_edits(empty).count() == 0


def sketch_of(text):
    """The hashes kept of a text, hash by hash."""
    w = TOKEN.findall(text)
    hashes = set()
    for shingle in [w[i : i + 5] for i in range(len(w) - 4)] or ([[" ".join(w)]] if w else []):
        h = 42
        for word in shingle:
            h = xxhash.xxh64(word.encode(), seed=h).intdigest()
        hashes.add(h - (1 << 64) if h >> 63 else h)
    return {h for h in hashes if h < -(1 << 62)} or set(sorted(hashes)[:1])


def as_text(sketch):
    return "".join(f"{h & (1 << 64) - 1:016x}" for h in sorted(sketch))


def like(a, b):
    least = min(len(a), len(b))
    return len(a & b) / least if least else float(len(a) == len(b))


@pytest.mark.parametrize("limit", ["BLOCK", "BLOCK_SHINGLES"])
def test_jaccard_join(docs, rows, empty, monkeypatch, limit):
    monkeypatch.setattr(jaccard, limit, 2)
    sets = []
    for doc_id, text, *_ in rows:
        w = item_words(text)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    want = collections.Counter()
    for row, s in zip(rows, sets):
        near = {o for o in sets if s and o and o != s and len(s & o) >= 0.8 * len(s | o)}
        want[row[0], len(near), sum(o == s for o in sets) if s else 1] += 1
    got = jaccard.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.n_links, r.n_copies) for r in got) == want
    assert {r.class_id for r in got if r.doc_id in (6, 7, 8, 9, 14)} == {6}
    kept = jaccard.one_of_each_class(docs)
    assert kept.columns == docs.columns
    assert len([r for r in kept.collect() if r.doc_id in (6, 7, 8, 9, 14)]) == 1
    assert jaccard.near_duplicates(empty).count() == 0


def test_pruning_keeps_pairs_that_reach_the_threshold():
    needed = jaccard.needed_matches()
    assert list(needed) == sorted(needed) and needed[-1] < 0.8 * jaccard.HASHES


def test_token_counts(docs, rows, empty):
    pieces = [b" w", b"w", b"or", b"ord", b"word1", b" word", b"1\xc3"]
    vocabulary = {bytes([b]) for b in range(256)} | set(pieces)

    def greedy(said):
        n = 0
        while said:
            k = max(k for k in range(1, 7) if said[:k] in vocabulary)
            said, n = said[k:], n + 1
        return n

    want = collections.Counter(
        (i, len(w), sum(greedy(b" " + x.encode()) for x in w)) for i, t, *_ in rows for w in [TOKEN.findall(t or "")]
    )
    got = tokens.token_counts(docs, pieces).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_tokens) for r in got) == want
    assert tokens.token_counts(empty, pieces).count() == 0


def test_scores(docs, rows, empty):
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0 for i, *_ in rows}
    grams = [(i, ctw.pack(np.frombuffer(b"\0" * ctw.DEPTH + (t or "").translate(LOWER).encode() + b"\0", np.uint8))) for i, t, *_ in rows]
    every = np.unique(np.concatenate([g for _, g in grams]))
    counts = np.zeros(len(every), np.int64)
    words = collections.Counter()
    for (i, g), (_, t, *_) in zip(grams, rows):
        if not held[i]:
            np.add.at(counts, np.searchsorted(every, g), 1)
            words.update([*TOKEN.findall((t or "").translate(LOWER)), "\0"])
    levels = {d: ctw.nodes(every, counts, d) for d in range(ctw.DEPTH + 1)}
    ctw.weigh(levels, 0)
    p = sum(np.log10(x) for x in ctw.mix(levels, ctw.bits_of(every)))
    total = sum(words.values())
    want = sorted(
        (i is None, i or 0, round(float(p[np.searchsorted(every, g)].sum()), 4),
         round(sum(math.log10((words[w] + 0.1) / (total + 0.1 * (len(words) + 1))) for w in [*TOKEN.findall((t or "").translate(LOWER)), "\0"]), 4))
        for (i, g), (_, t, *_) in zip(grams, rows)
    )
    got = scoring.scores(docs, block_bytes=20_000).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, round(r.score, 4), round(r.base_score, 4)) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=2e-4)
    assert scoring.scores(empty).count() == 0


def test_language(spark, medium, docs, empty):
    table = queries.table(spark, medium, "documents")
    model = language.train(table.filter(~language.held_out()).select("text", "lang"))
    found = language.predict(table.filter(language.held_out()), model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    odd = language.predict(docs, model)
    assert set(odd.columns) == {*docs.columns, "lang_pred"}
    assert all(r.lang_pred == "und" for r in odd.collect() if r.text in (None, "", " \n ", "!!!"))
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_chat_layouts(spark):
    records = [
        (1, '{"prompt": "a<s>", "completion": "b\\\\"}'),
        (2, '{"messages": [{"role": "user", "content": "x"}, {"role": "assistant", "content": null}]}'),
        (3, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "<|end|>\\n"}], "id": 9}'),
        (4, '{"instruction": "i", "input": "n", "output": "o"}'),
        (5, "not json"),
        (6, '{"turn": 3, "role": null, "text": "t\\n[/INST]"}'),
    ]
    df = spark.createDataFrame(records, "conv_id bigint, record string")
    pieces = chat.formatted(chat.canonical_turns(df))
    assert not pieces.filter(F.col("piece").rlike(r"\[/INST\]|<s>")).count()
    got = sorted((r.conv_id, r.turn, r.role, r.text, r.loss_text) for r in chat.read_back(pieces).collect())
    assert got == [
        (1, 0, "user", "a<s>", ""), (1, 1, "assistant", "b\\", "b\\"),
        (2, 0, "user", "x", ""), (2, 1, "assistant", "", ""),
        (3, 0, "user", "q", ""), (3, 1, "assistant", "<|end|>\n", "<|end|>\n"),
        (4, 0, "user", "i\n\nn", ""), (4, 1, "assistant", "o", "o"),
        (5, 0, "unknown", "not json", ""), (6, 3, "", "t\n[/INST]", ""),
    ]
    digest = {r.conv_id: r for r in chat.conversation_digests(chat.read_back(pieces)).collect()}
    assert digest[1].turns_sha256 == hashlib.sha256(b"user\na<s>\nassistant\nb\\\n").hexdigest()


def test_mix_and_lines(docs, empty):
    rows = mix.mixture(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    by = collections.defaultdict(int)
    for r in rows:
        by[r.source_size, r.target] += r.taken
    assert all(abs(n - target) <= len(rows) for (_, target), n in by.items())
    parts = mix.mixed_documents(docs)
    assert parts.agg(F.sum("n_words_taken")).first()[0] == sum(r.taken for r in rows)
    assert mix.mixture(empty).count() == 0 and mix.mixed_documents(empty).count() == 0
    kept = site_lines.without_boilerplate(docs)
    assert kept.count() == docs.count()
    assert site_lines.without_boilerplate(empty).count() == 0


def test_pipeline(spark, small):
    docs = queries.table(spark, small, "documents")
    result = corpus_pipeline.run(spark, small)
    assert set(docs.columns) < set(result.columns)
    ids = {r.doc_id for r in result.select("doc_id").collect()}
    assert ids and ids < {r.doc_id for r in docs.select("doc_id").collect()}


def test_mix_draws_whole_documents(spark):
    made = [(i, " ".join(f"w{i}x{j}" for j in range(20 + i % 9)), "en", f"s{i % 3}", 0, "x", "y") for i in range(90)]
    made += [(None, "one two three four five", "en", "s0", k, "x", "y") for k in range(60)]
    docs = spark.createDataFrame(made, SCHEMA)
    whole = {r[1] for r in made}
    sizes = collections.Counter()
    for _, text, _, s, *_ in made:
        sizes[s] += len(text.split())
    assert len(set(sizes.values())) == 3  # a source is told by its size below
    draws = {}
    for seed in ("a", "b", "a"):
        got = mix.mixed_documents(docs, seed=seed).collect()
        total, cut = collections.Counter(), collections.Counter()
        for r in got:
            total[r.source] += r.n_words_taken
            assert len(r.text.split()) == r.n_words_taken
            cut[r.source] += r.text not in whole
        words = collections.Counter()
        for r in mix.mixture(docs, seed=seed).collect():
            words[r.source_size] += r.taken
        assert {s: total[s] for s in sizes} == {s: words[n] for s, n in sizes.items()}
        assert all(n <= 1 for n in cut.values())
        assert any(total[s] < sizes[s] for s in sizes)
        draws.setdefault(seed, []).append(collections.Counter((r.doc_id, r.text, r.repetition) for r in got))
    assert draws["a"][0] == draws["a"][1] and draws["a"][0] != draws["b"][0]


def test_copies_keep_their_lines(spark):
    clean = "\n".join(f"line {i} of the copied page with words of its own" for i in range(4))
    made = [(i, clean, "en", "s", 0, "x", "y") for i in range(5)]
    made += [(10 + i, f"page {i} says this\nall rights reserved", "en", "s", 0, "x", "y") for i in range(10)]
    docs = spark.createDataFrame(made, SCHEMA)
    stages = dict(corpus_pipeline.STAGES)
    lined = stages["line_dedup"](spark, docs, "")
    text = {r.doc_id: r.text for r in lined.collect()}
    assert len(text) == len(made)
    assert all(text[i] == clean for i in range(5))
    assert all(text[10 + i] == f"page {i} says this" for i in range(10))
    kept = stages["ngram_join"](spark, lined, "")
    assert [r.doc_id for r in kept.filter(F.col("text") == clean).collect()] == [0]


def test_equal_texts_without_words_share_a_class(spark):
    texts = ["", "", "!!", "!!", "??", None, None, "one two"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    classes = {r.doc_id: r.class_id for r in jaccard.near_duplicates(docs).collect()}
    assert classes == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 5, 7: 7}
    assert sorted(r.doc_id for r in jaccard.one_of_each_class(docs).collect()) == [0, 2, 4, 5, 7]


def test_least_score_follows_the_number_of_languages(spark, monkeypatch):
    model = language.Model(["a", "b"], np.ones(language.FEATURES), np.zeros((language.FEATURES, 2)), 1.0)
    monkeypatch.setattr(language, "train", lambda rows: model)
    docs = spark.createDataFrame([(1, "neither of both", "a", "s", 0, "x", "y")], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    assert stage(spark, docs, "").count() == 0  # both have 0.5
    model.weights[:, 0] = 1.0
    assert stage(spark, docs, "").count() == 1
    assert abs(language.min_score(4) - 0.3) < 1e-12 and language.min_score(1) == 1.0
    assert all(1 / n < language.min_score(n) < 1 / n + 0.07 for n in range(2, 200))
