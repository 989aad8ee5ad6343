"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies cover all labelled training texts and are summed in Spark. The classifier is fitted on
a sample with a stated number of texts per language, by follow-the-regularised-leader with L1 and L2
penalties; a part of the sample that it is not fitted on sets the temperature of its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch

LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``per_language``: expected number of different sample texts per language, less where all languages together would have more
    than ``sample_texts``. ``features``: hash buckets of n-grams."""

    per_language: int = 600
    sample_texts: int = 150_000
    features: int = 1 << 14
    lengths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01


def counts(text: str, settings: Settings) -> np.ndarray:
    """How often each hashed character n-gram occurs in a whole text, white space, digits and signs of ASCII alike as spaces."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    plain = (chars < 128) & ((chars < 97) | (chars > 122))
    chars = np.where(plain, np.uint32(32), chars)
    total = np.zeros(settings.features, np.int64)
    shift = np.uint32(32 - settings.features.bit_length() + 1)
    rolled = np.zeros(len(chars), np.uint32)
    for n in range(1, max(settings.lengths) + 1):
        if len(chars) < n:
            break
        # One more character is mixed into the hash of every n-gram that is one shorter.
        rolled = (rolled[: len(chars) - n + 1] * np.uint32(0x01000193)) ^ (chars[n - 1 :] + np.uint32(n))
        if n in settings.lengths:
            mixed = rolled * np.uint32(0x9E3779B1)
            total += np.bincount((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77) >> shift, minlength=settings.features)
    return total


def weighted(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nonzero features of a text, with TF-IDF values of length one."""
    at = np.flatnonzero(found)
    values = np.log1p(found[at]) * idf[at]
    return at, values / max(float(np.sqrt(values @ values)), 1e-12)


def document_frequencies(docs: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts. A task hands over one row per feature."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, texts = np.zeros(settings.features + 1, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                seen[:-1] += counts(text.as_py(), settings) > 0
                texts += 1
        seen[-1] = texts
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["feature", "texts"])

    rows = docs.select("text").mapInArrow(task, "feature long, texts long").groupBy("feature").agg(F.sum("texts").alias("texts")).collect()
    total = np.zeros(settings.features + 1, np.int64)
    for feature, texts in rows:
        total[feature] = texts
    return total[:-1], int(total[-1])


def sample(docs: DataFrame, settings: Settings) -> tuple[list[str], DataFrame]:
    """All languages there are, and about ``per_language`` different texts of each, picked by the text's hash."""
    sizes = docs.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("texts"))
    found = sizes.select("lang", "texts").collect()
    each = min(settings.per_language, settings.sample_texts / max(1, len(found)))
    rates = {r["lang"]: each / r["texts"] for r in found}
    if not rates:
        return [], docs.limit(0)
    steps = 1 << 30
    rate = F.create_map(*[F.lit(x) for lang, r in rates.items() for x in (lang, int(min(1.0, r) * steps))])
    picked = docs.where(F.pmod(F.xxhash64("text"), F.lit(steps)) < rate[F.col("lang")])
    return sorted(rates), picked.select("lang", "text").dropDuplicates()


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader, one step size per coordinate, for a softmax over languages."""

    def __init__(self, features: int, classes: int, settings: Settings):
        self.z, self.n, self.s = np.zeros((features + 1, classes)), np.zeros((features + 1, classes)), settings

    def weights(self, at) -> np.ndarray:
        z, n, s = self.z[at], self.n[at], self.s
        shrunk = np.sign(z) * np.maximum(np.abs(z) - s.l1, 0.0)
        return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, language: int) -> None:
        at, values = np.r_[at, len(self.z) - 1], np.r_[values, 1.0]  # the last row is the bias
        w = self.weights(at)
        error = softmax(values @ w)
        error[language] -= 1.0
        g = values[:, None] * error
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.s.alpha * w
        self.n[at] = n + g * g


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model | None:
    """Learn from ``docs`` (text, lang); None if no row has both. Rows with a null text or lang teach nothing."""
    docs = docs.select("text", "lang").where("text is not null and lang is not null")
    seen, texts = document_frequencies(docs, settings)
    languages, picked = sample(docs, settings)
    if not languages:
        return None
    idf = np.log((1 + texts) / (1 + seen)) + 1.0

    def task():
        def rows(batch: pa.RecordBatch) -> dict:
            found = [weighted(counts(x.as_py(), settings), idf) for x in batch.column("text")]
            return {
                "lang": batch.column("lang"),
                "held": batch.column("held"),
                "at": [at.astype(np.int32) for at, _ in found],
                "value": [v.astype(np.float32) for _, v in found],
            }

        return rows

    fold = (F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(5)) == 0).alias("held")
    found = by_batch(picked.select("lang", "text", fold), task, "lang string, held boolean, at array<int>, value array<float>")
    rows = sorted(found.collect(), key=lambda r: (r["lang"], r["at"], r["value"]))
    number = {lang: i for i, lang in enumerate(languages)}
    examples = [(np.array(r["at"], np.int64), np.array(r["value"]), number[r["lang"]], r["held"]) for r in rows]
    learned = [x for x in examples if not x[3]] or examples
    leader = Leader(settings.features, len(languages), settings)
    rng = np.random.default_rng(0)
    for _ in range(settings.epochs):
        for i in rng.permutation(len(learned)):
            leader.learn(*learned[i][:3])
    everything = leader.weights(slice(None))
    model = Model(languages, idf, everything[:-1].astype(np.float32), everything[-1], 1.0)
    held = [x for x in examples if x[3]] or learned
    logits = np.array([model.logits(at, values) for at, values, _, _ in held])
    model.temperature = temperature(logits, np.array([x[2] for x in held]))
    return model


def temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature under which the truth is most likely, by golden-section search over its logarithm."""

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(truth)), truth]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    low, high, golden = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def predict(docs: DataFrame, model: Model | None, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of ``docs`` (doc_id, held_out, text)."""

    def task():
        def one(text: str | None) -> tuple[str, float]:
            if model is None or text is None or not LETTER.search(text):
                return UNKNOWN, 0.0
            p = softmax(model.logits(*weighted(counts(text, settings), model.idf)) / model.temperature)
            return model.languages[int(p.argmax())], float(p.max())

        def rows(batch: pa.RecordBatch) -> dict:
            found = [one(x.as_py()) for x in batch.column("text")]
            return {
                "doc_id": batch.column("doc_id"),
                "held_out": batch.column("held_out"),
                "lang_pred": [lang for lang, _ in found],
                "score": [score for _, score in found],
            }

        return rows

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text")
    return by_batch(columns, task, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out(folds: int) -> Column:
    """Whether a document is held out: the CRC-32 of its id as text is divisible by ``folds``. Rows without id are held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % folds == 0, F.lit(True))


def identify(docs: DataFrame, folds: int = 5, settings: Settings = Settings()) -> DataFrame:
    """Learn from the documents that are not held out, and predict all: doc_id, held_out, lang_pred, score.

    One row per row of ``docs`` (doc_id, text, lang). ``und`` with score 0 if the text is null or has no letter, or if nothing
    could be learned. Texts are read whole. Other columns are not read.
    """
    marked = docs.select("doc_id", "text", "lang", held_out(folds).alias("held_out"))
    return predict(marked, fit(marked.where("not held_out"), settings), settings)


