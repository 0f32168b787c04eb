"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters are hashed to a fixed number of features.
Document frequencies are counted over all training rows. The weights are learned
with follow-the-regularised-leader and elastic-net penalties on a bounded, seeded
sample of the different training texts (``SAMPLE_ROWS`` over all languages, in equal
parts; copies of a text in one language are drawn and learned once); a part of the sample that is not learned from calibrates the temperature. What
reaches the driver is the model: features by languages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tidegauge.llm.batches import map_arrow, map_partitions, mixed, values
from tidegauge.session import materialize

FEATURES = 1 << 16
SAMPLE_ROWS = 6000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
CALIBRATION = 5  # one sample row in so many
UNDETERMINED = "und"
CHUNK = 1 << 16  # characters whose grams are held at once
ABOVE_CHANCE = 1 / 15  # of the way from an even score to certainty; 0.3 with four languages

_NOT_LETTER = re.compile(r"[\W\d_]+")


def has_letter(text: str) -> bool:
    """Whether a character is a letter, as ``\\p{L}`` has it: number signs such as ½ are none."""
    return any(map(str.isalpha, text))


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a whole text and how often each occurs."""
    said = f" {_NOT_LETTER.sub(' ', text.lower())} ".encode("utf-32-le")
    codes = np.frombuffer(said, np.uint32)
    last = len(codes) - 1
    counts = np.zeros(FEATURES, np.int64)
    for at in range(0, len(codes), CHUNK):
        one = codes[at : at + CHUNK + 2].astype(np.uint64)
        two = one[:-1] << np.uint64(21) | one[1:]
        three = one[:-2] << np.uint64(42) | two[1:]
        single = one[int(at == 0) : min(CHUNK, last - at)]
        grams = np.concatenate([single, two[:CHUNK] | np.uint64(1 << 63), three[:CHUNK]])
        slots = (mixed(grams) >> np.uint64(64 - 16)).astype(np.int64)
        counts += np.bincount(slots, minlength=FEATURES)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf[found]
    return x / np.sqrt((x * x).sum())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader, one row at a time, all languages at once."""

    def __init__(self, n_languages: int) -> None:
        self.z = np.zeros((FEATURES, n_languages))
        self.n = np.zeros((FEATURES, n_languages))

    def weights(self, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, found: np.ndarray, x: np.ndarray, language: int) -> None:
        w = self.weights(found)
        error = _softmax(x @ w)
        error[language] -= 1
        g = x[:, None] * error[None, :]
        n = self.n[found]
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[found] += g - step * w
        self.n[found] = n + g * g


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits that makes the held-back rows likeliest.

    Targets are smoothed by one row a language, else languages that separate
    without error would always get certainty.
    """
    if not len(truth):
        return 1.0
    k = logits.shape[1]
    target = np.full(logits.shape, 1.0 / (len(truth) + k))
    target[np.arange(len(truth)), truth] = (len(truth) + 1.0) / (len(truth) + k)

    def loss(log_t: float) -> float:
        return -(target * np.log(_softmax(logits / np.exp(log_t)) + 1e-300)).sum(1).mean()

    low, high, ratio = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def min_score(n_languages: int) -> float:
    """The score from which a text is in a learned language: above chance, for any number of them."""
    chance = 1.0 / max(1, n_languages)
    return chance + (1.0 - chance) * ABOVE_CHANCE


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if text is None or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        found, counts = features(text)
        p = _softmax(_weighted(found, counts, self.idf) @ self.weights[found] / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def document_frequencies(texts: DataFrame) -> DataFrame:
    """Rows (feature, n): in how many of all texts a feature occurs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n = np.zeros(FEATURES, np.int64)
        for batch in batches:
            for text in values(batch.column("text")):
                n[features(text)[0]] += 1
        found = np.flatnonzero(n)
        yield {"feature": found, "n": n[found]}

    counted = map_partitions(texts.select("text"), task, "feature int, n bigint")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from rows (text, lang); null texts, texts without letters and null langs are left out.

    The sample is ``sample_rows`` rows in expectation, however often a text is repeated.
    """
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros(FEATURES), np.zeros((FEATURES, 0)), 1.0)
    df = np.zeros(FEATURES)
    for feature, n in document_frequencies(rows).collect():
        df[feature] = n
    total = sum(counts.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    share = max(1, sample_rows // len(languages))
    chance = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, share / n))])
    order = F.xxhash64(F.lit("sample"), "text", "lang")
    drawn = (
        rows.select("text", "lang", order.alias("place"))
        .filter((F.pmod("place", F.lit(1 << 20)) / (1 << 20)) < chance[F.col("lang")])
        .distinct()
        .orderBy("place", "lang")
    )
    fitted = _fit(materialize(drawn, "language-sample"), languages, idf)
    weights = np.zeros((FEATURES, len(languages)))
    divisor = 1.0
    for feature, values in fitted.collect():
        if feature < 0:
            divisor = values[0]
        else:
            weights[feature] = values
    return Model(languages, idf, weights, divisor)


def _fit(sample: DataFrame, languages: list[str], idf: np.ndarray) -> DataFrame:
    """Rows (feature, weights), the temperature under feature -1; one task, as the sample is bounded."""
    number = {lang: i for i, lang in enumerate(languages)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        learned, held = [], []
        for batch in batches:
            for row in batch.to_pylist():
                found, counts = features(row["text"])
                one = (found, _weighted(found, counts, idf), number[row["lang"]], row["place"])
                (held if row["place"] // (1 << 20) % CALIBRATION == 0 else learned).append(one)
        for part in (learned, held):
            part.sort(key=lambda one: (one[3], one[2]))
        leader = Leader(len(languages))
        for _ in range(EPOCHS):
            for found, x, language, _ in learned:
                leader.learn(found, x, language)
        w = leader.weights()
        logits = np.array([x @ w[found] for found, x, _, _ in held]).reshape(-1, len(languages))
        divisor = temperature(logits, np.array([one[2] for one in held], int))
        used = np.flatnonzero(np.abs(w).sum(1))
        yield {
            "feature": np.concatenate([[-1], used]),
            "weights": [[divisor], *w[used].tolist()],
        }

    return map_partitions(sample.coalesce(1), task, "feature int, weights array<double>")


def predict(documents: DataFrame, model: Model, inside: str | None = None) -> DataFrame:
    """All columns of ``documents`` with lang_pred and score (these names are replaced).

    Null texts and texts without letters are ``und`` with score 0. Only the text
    is looked at. ``inside`` names the struct column the text is in, if it is in one.
    """
    kept = [c for c in documents.columns if c not in ("lang_pred", "score")]
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def rows(batch: pa.RecordBatch) -> Iterator[dict]:
        texts = batch.column(inside).field("text") if inside else batch.column("text")
        found = [shared.value.predict(t) for t in values(texts)]
        yield {c: batch.column(c) for c in kept} | {
            "lang_pred": [lang for lang, _ in found],
            "score": [score for _, score in found],
        }

    fields = [StructField(f.name, f.dataType) for f in documents.schema if f.name in kept]
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return map_arrow(documents, rows, StructType(fields + added))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept from learning; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2
