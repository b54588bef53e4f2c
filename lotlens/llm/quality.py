"""Quality classifier: hashed word n-gram logistic regression, trained with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotlens.llm.spans import WORDS_AND_MARKS, mix, per_text, runs, slices, token_hashes

#: Labelled documents the model learns from, at most about.
MAX_TRAIN_DOCS = 6_000
BITS = 18
ORDERS = 2
#: A text's features have this total weight, whatever its length.
SCALE = 12.0

_ALPHA, _BETA, _L1, _L2, _PASSES = 0.2, 1.0, 0.02, 0.2, 6


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A coarse form of each token: mark or word, case of its first and last byte, length class, same as the one before."""
    lead, tail = data[start], data[end - 1]
    upper = lambda c: ((c >= 65) & (c <= 90)).astype(np.uint64)
    digit = ((lead >= 48) & (lead <= 57)).astype(np.uint64)
    size = np.minimum(np.log2(end - start).astype(np.uint64), np.uint64(5))
    again = np.zeros(len(tokens), np.uint64)
    again[1:] = tokens[1:] == tokens[:-1]
    again[first[:-1][first[:-1] < len(tokens)]] = 0
    mark = (WORDS_AND_MARKS[lead] == 2).astype(np.uint64)
    parts = (mark, upper(lead), upper(tail) * (end - start > 1), digit, again, size)
    code = np.zeros(len(tokens), np.uint64)
    for p in parts:
        code = code * np.uint64(8) + p.astype(np.uint64)
    return mix(code + np.uint64(1 << 40))


def features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature of each n-gram, index of each text's first n-gram) for words and for their shapes, n = 1 .. ORDERS."""
    start, end, first = runs(data, offsets, WORDS_AND_MARKS)
    tokens = token_hashes(data, start, end, fold=False)
    out = []
    for kind, base in enumerate((tokens, _shapes(data, start, end, tokens, first) if len(tokens) else tokens)):
        gram = base
        for order in range(1, ORDERS + 1):
            if order > 1:
                gram = mix(gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + base[order - 1 :]) if len(base) >= order else base[:0]
                text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
                inside = text_of[: len(gram)] == text_of[order - 1 : order - 1 + len(gram)]
                own, own_first = gram[inside], np.searchsorted(text_of[: len(gram)][inside], np.arange(len(first)))
            else:
                own, own_first = gram, first
            place = (mix(own + np.uint64(kind * 16 + order)) >> np.uint64(64 - BITS)).astype(np.int32)
            out.append((place, own_first))
    return out


class QualityModel:
    """Weights of hashed n-grams and a bias; a text's score is the sigmoid of a sparse dot product."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), bias

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total, n = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for place, first in features(data, offsets):
            total += per_text(self.weights[place], first, np.add, 0)
            n += np.diff(first)
        return 1 / (1 + np.exp(-np.clip(self.bias + SCALE * total / np.maximum(n, 1), -30, 30)))


def train(texts: list[str | None], labels: list[int], passes: int = _PASSES) -> QualityModel:
    """Per-coordinate FTRL-proximal logistic regression; rows are taken in a fixed shuffled order in each pass."""
    examples = []
    for text in texts:
        _, _, data, offsets = next(iter(slices(pa.array([text], pa.string()), 1 << 62)))
        places = np.concatenate([p for p, _ in features(data, offsets)])
        index, n = np.unique(places, return_counts=True)
        examples.append((index, (SCALE * n / max(1, len(places))).astype(np.float64)))
    z, squares = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z_bias = squares_bias = 0.0
    y, order = np.array(labels, np.float64), np.random.default_rng(1)

    def weight(z, squares, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((_BETA + np.sqrt(squares)) / _ALPHA + _L2))

    for _ in range(passes):
        for i in order.permutation(len(examples)):
            index, x = examples[i]
            zi, ni = z[index], squares[index]
            w = weight(zi, ni, _L1)
            b = float(weight(np.float64(z_bias), np.float64(squares_bias), 0.0))
            error = 1 / (1 + np.exp(-np.clip(b + w @ x, -30, 30))) - y[i]
            g = error * x
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / _ALPHA
            z[index] = zi + g - step * w
            squares[index] = ni + g * g
            step = (np.sqrt(squares_bias + error * error) - np.sqrt(squares_bias)) / _ALPHA
            z_bias += error - step * b
            squares_bias += error * error
    return QualityModel(weight(z, squares, _L1), float(weight(np.float64(z_bias), np.float64(squares_bias), 0.0)))


def sample(docs: DataFrame, labels: DataFrame, label: str, most: int, text: str = "text", doc_id: str = "doc_id", *more: str) -> DataFrame:
    """(text, label, more) of about ``most`` labelled documents, chosen by a hash of the id; null labels are left out."""
    own = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label")).where("label is not null and __id is not null")
    n = own.count()
    if n > most:
        own = own.where(F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(1 << 30)) < int(most / n * (1 << 30)))
    return _joined(docs, F.broadcast(own), text, doc_id, more)  # about ``most`` rows of two numbers


def labelled(docs: DataFrame, labels: DataFrame, label: str, text: str = "text", doc_id: str = "doc_id", *more: str, send: int = 2_000_000) -> DataFrame:
    """(text, label, more) of all labelled documents; up to ``send`` labels, which are two numbers each, go to every task."""
    own = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("label")).where("label is not null and __id is not null")
    return _joined(docs, F.broadcast(own) if own.count() <= send else own, text, doc_id, more)


def _joined(docs: DataFrame, own: DataFrame, text: str, doc_id: str, more: tuple[str, ...]) -> DataFrame:
    wanted = docs.select(F.col(doc_id).alias("__doc"), F.col(text).alias("__text"), F.struct(*[F.col(c).alias(c) for c in more] or [F.lit(0).alias("none")]).alias("__more"))
    return wanted.join(own, F.col("__doc") == F.col("__id")).select(F.col("__text").alias("text"), "label", *[F.col("__more").getField(c).alias(c) for c in more])


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text", doc_id: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS) -> QualityModel:
    """A model from the labelled rows among ``docs``: about ``max_docs`` of them with their whole texts."""
    rows = sample(docs, labels, label, max_docs, text, doc_id).toArrow()  # bounded by max_docs
    return train(rows["text"].to_pylist(), rows["label"].to_pylist())


def probability(model: QualityModel, docs: DataFrame, text: Column) -> Column:
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        parts: Iterator[np.ndarray] = (sent.value.score(data, offsets) for _, _, data, offsets in slices(texts))
        return pa.array(np.concatenate([np.empty(0), *parts]))

    return of(text)


def classify(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 if score >= threshold, else 0); such columns are replaced.

    Null and empty texts have no n-grams and get the model's bias alone; a model without training rows gives 0.5.
    Repeated rows get equal scores, and rows and other columns stay as they are.
    """
    own = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    found = docs.select(*[F.col(f"`{c}`") for c in own], probability(model, docs, F.col(text)).alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
