"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct unigrams (and the stems of words), bigrams and skip-grams (one word left out) of a text, hashed
to ``DIMENSIONS`` coordinates. Each coordinate has its own learning rate, and the L1 term keeps most weights at exactly zero, so what goes
to the tasks is a short list of coordinates and weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import written
from rankloom.llm.words import ALNUM, Words, words_of

BITS = 20
#: A word also counts by its first so many bytes, so that an inflected form is known by its stem.
STEMS = (3, 4, 5, 6, 7, 8)
DIMENSIONS = 1 << BITS
#: The model is fitted on at most so many labelled rows, those with the smallest hash of their id.
MAX_LABELLED_ROWS = 12_000
EPOCHS = 3


@dataclass(frozen=True)
class Weights:
    """The non-zero weights, by coordinate, and the intercept."""

    at: np.ndarray
    value: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """The score of each text. Coordinates without a weight are left out before they are sorted."""
        dense = np.zeros(DIMENSIONS)
        dense[self.at] = self.value
        out = [np.zeros(0)]
        for words in words_of(column, ALNUM, lower=True):
            sums = np.full(words.last - words.first, self.bias)
            key = np.unique(np.concatenate([
                ((text << BITS) | at)[dense[at] != 0] for text, at in _grams(words)]))
            np.add.at(sums, key >> BITS, dense[key & (DIMENSIONS - 1)])
            out.append(1 / (1 + np.exp(-np.clip(sums, -35, 35))))
        return np.concatenate(out)


def _coordinate(h: np.ndarray, salt: int) -> np.ndarray:
    return (((h ^ np.uint64(salt)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS)).astype(np.int64)


def _grams(words: Words):
    """(text, coordinate) of the unigrams, of the stems of each size, of the bigrams and of the skip-grams."""
    h = words.hashes()
    yield words.text, _coordinate(h, 0)
    for size in STEMS:
        text, stem = words.stems(size)
        yield text, _coordinate(stem, size)
    for gap in (1, 2):
        if len(h) > gap:
            same = words.text[gap:] == words.text[:-gap]
            yield words.text[gap:][same], _coordinate((h[:-gap] * np.uint64(2 * gap + 1) + h[gap:])[same], 16 + gap)


def features_of(column: pa.Array):
    """The sorted distinct coordinates of each text; none for null or blank texts."""
    for words in words_of(column, ALNUM, lower=True):
        key = np.unique(np.concatenate([(text << BITS) | at for text, at in _grams(words)]))
        cuts = np.searchsorted(key, np.arange(words.last - words.first + 1) << BITS)
        key = (key & (DIMENSIONS - 1)).astype(np.int32)
        for a, b in zip(cuts, cuts[1:]):
            yield key[a:b]


class Ftrl:
    """Follow the regularised leader, proximal form: z and n for each coordinate, weights in closed form."""

    def __init__(self, dimensions: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 4.0, l2: float = 1.0):
        self.z, self.n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)  # the last one is the intercept
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        small = np.abs(z) <= np.where(at == len(self.z) - 1, 0.0, self.l1)
        l1 = np.where(at == len(self.z) - 1, 0.0, self.l1)
        return np.where(small, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2))

    def learn(self, features: np.ndarray, label: int) -> None:
        at = np.append(features, np.int32(len(self.z) - 1))
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(docs: DataFrame, labels: DataFrame, training: Column, max_rows: int = MAX_LABELLED_ROWS) -> Weights:
    """Fit on the rows of ``labels`` (``doc_id``, ``toxic``) where ``training`` (of ``doc_id``) holds.

    Null labels and ids are left out, an id with several labels counts as toxic if any is. At most ``max_rows`` rows are
    used, by the hash of their id, and one task takes them in that order; equal texts of an id are one row.
    Without any row the score is one half throughout.
    """
    known = labels.where(training).where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(
        F.max("toxic").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = written(chosen, "labelled")  # bounded by max_rows, so it may be broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # An id may have many rows: equal texts teach once, and the limit holds for rows, whatever their ids.
    rows = rows.withColumn("t", F.xxhash64("text")).dropDuplicates(["doc_id", "t"]).orderBy(
        F.xxhash64("doc_id"), "doc_id", "t").limit(max_rows)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["h", "doc_id", "t"], kind="stable")
        texts, labels_ = pa.array(pdf["text"], pa.string()), pdf["label"].to_numpy()
        model, rows_ = Ftrl(DIMENSIONS), list(features_of(texts))
        for _ in range(EPOCHS):
            for features, label in zip(rows_, labels_):
                model.learn(features, int(label))
        at = np.flatnonzero(model.n)
        w = model.weights(at)
        keep = (w != 0) | (at == DIMENSIONS)
        return pd.DataFrame({"at": at[keep], "w": w[keep]})

    found = rows.withColumn("h", F.xxhash64("doc_id")).groupBy(F.lit(0).alias("all")).applyInPandas(
        train, "at bigint, w double").toPandas().sort_values("at")
    bias = found.loc[found["at"] == DIMENSIONS, "w"]
    found = found[found["at"] < DIMENSIONS]
    return Weights(found["at"].to_numpy(np.int64), found["w"].to_numpy(float), float(bias.iloc[0]) if len(bias) else 0.0)


def scores(docs: DataFrame, weights: Weights) -> DataFrame:
    """``doc_id`` and ``score`` of every row, from its whole text; a null or blank text has the intercept's score."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        known = shared.value
        return pa.array(known.scores(column))

    return docs.select("doc_id", score(F.col("text").cast("string")).alias("score"))
