"""Quality by positive-unlabelled learning: a linear scorer that minimises the non-negative unbiased risk.

Positives are trusted; the web text beside them is unlabelled, a mixture of good and bad whose share of good text is the
class prior. The risk of calling unlabelled text good is corrected by what the positives contribute to it and never taken
below zero.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.llm.common import buckets_for, joined, written
from rankloom.llm.words import UNSPACED, Words, mixed, words_of

BITS = 12
DIMENSIONS = 1 << BITS
#: A task fits a model on about so many trusted positives and so many unlabelled rows; the models of all tasks are averaged.
MAX_POSITIVES = 6_000
MAX_UNLABELLED = 12_000
STEPS = 300
#: The score at which a text counts as good: the share of unlabelled text above it is the class prior.
ACCEPT = 0.7

#: Bytes by what they look like: lower, upper, digit, other beyond ASCII is lower; signs stay themselves.
_LOOKS = np.arange(256, dtype=np.uint8)
_LOOKS[97:123] = _LOOKS[128:] = ord("x")
_LOOKS[65:91] = ord("X")
_LOOKS[48:58] = ord("0")
STATISTICS = 10


@dataclass(frozen=True)
class Scorer:
    weights: np.ndarray  # of the shape coordinates, then of the statistics
    bias: float
    scale: np.ndarray  # mean and spread of the statistics


def _squeezed(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words' shapes, with runs of one kind of character as one; and the looks of all bytes."""
    looks = _LOOKS[words.data]
    keep = np.ones(len(looks), dtype=bool)
    keep[1:] = looks[1:] != looks[:-1]
    keep[words.start] = True
    place = np.concatenate(([0], np.cumsum(keep)))
    short = Words(words.first, words.last, looks[keep], place[words.offsets], place[words.start], place[words.end], words.text)
    return short.hashes(), looks


def features_of(column: pa.Array):
    """(coordinates, values, statistics) of each text; shapes and pairs of shapes count by their share of the words."""
    for words in words_of(column, UNSPACED, lower=False):
        shape, looks = _squeezed(words)
        rows, n = words.last - words.first, words.counts()
        exact = words.hashes()
        texts, grams = [words.text], [shape]
        if len(shape) > 1:
            same = words.text[1:] == words.text[:-1]
            texts.append(words.text[1:][same])
            grams.append((shape[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ shape[1:])[same])
        at = (mixed(np.concatenate(grams)) >> np.uint64(64 - BITS)).astype(np.int64)
        key, count = np.unique((np.concatenate(texts) << BITS) | at, return_counts=True)
        cuts = np.searchsorted(key, np.arange(rows + 1) << BITS)
        upto = np.concatenate([np.zeros((1, 6)), np.cumsum(np.stack([
            looks == 88, looks == 48, looks == 120, looks == 10, looks == 32, looks > -1], axis=1), axis=0)])
        kinds = np.diff(upto[words.offsets], axis=0)
        distinct = np.bincount(np.unique(np.stack([words.text.astype(np.uint64), exact]), axis=1)[0].astype(np.int64),
                               minlength=rows) if len(exact) else np.zeros(rows)
        size = np.maximum(1, kinds[:, 5])
        per = np.maximum(1, n)
        statistics = np.stack([
            np.log1p(n), kinds[:, 0] / size, kinds[:, 1] / size, kinds[:, 2] / size,
            (size - kinds[:, :5].sum(axis=1)) / size, kinds[:, 3] / per, distinct / per,
            np.log1p(distinct), size / per, (n == 0).astype(float)], axis=1)
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            yield key[a:b] & (DIMENSIONS - 1), np.sqrt(count[a:b] / per[i]), statistics[i]


def _words(statistics: np.ndarray) -> float:
    return max(1.0, np.rint(np.expm1(statistics[0])))


def _packed(text: str) -> Column:
    """A text's statistics, the counts of its coordinates and these, as bytes: a third of the text, and read without its words."""

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        return pa.array([
            s.astype("<f8").tobytes() + np.rint(v * v * _words(s)).astype("<u4").tobytes() + at.astype("<u2").tobytes()
            for at, v, s in features_of(column)], pa.binary())

    return pack(text)


class _Table:
    """Sparse rows with their statistics, for products with a weight vector."""

    def __init__(self, texts: pa.Array):
        at, values, statistics = [], [], []
        for a, v, s in features_of(texts):
            at.append(a)
            values.append(v)
            statistics.append(s)
        self.size = len(at)
        self.row = np.repeat(np.arange(self.size), [len(a) for a in at])
        self.at = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
        self.value = np.concatenate(values) if values else np.zeros(0)
        self.statistics = np.array(statistics).reshape(-1, STATISTICS)

    @classmethod
    def of(cls, packed: list[bytes]) -> _Table:
        """From the rows of ``_packed``."""
        new, size = cls(pa.array([], pa.string())), len(packed)
        counts, at = [np.zeros(0)] * size, [np.zeros(0, dtype=np.int64)] * size
        statistics = np.zeros((size, STATISTICS))
        for i, b in enumerate(packed):
            statistics[i] = np.frombuffer(b, "<f8", STATISTICS)
            n = (len(b) - 8 * STATISTICS) // 6
            counts[i] = np.frombuffer(b, "<u4", n, 8 * STATISTICS) / _words(statistics[i])
            at[i] = np.frombuffer(b, "<u2", n, 8 * STATISTICS + 4 * n).astype(np.int64)
        new.size, new.statistics = size, statistics
        new.row = np.repeat(np.arange(size), [len(a) for a in at])
        new.at, new.value = (np.concatenate(at), np.sqrt(np.concatenate(counts))) if size else (new.at, new.value)
        return new

    def scaled(self, scale: np.ndarray) -> None:
        self.statistics = (self.statistics - scale[0]) / scale[1]

    def times(self, w: np.ndarray, b: float) -> np.ndarray:
        sparse = np.bincount(self.row, self.value * w[self.at], minlength=self.size)
        return sparse + self.statistics @ w[DIMENSIONS:] + b

    def gradient(self, g: np.ndarray) -> np.ndarray:
        return np.concatenate([
            np.bincount(self.at, self.value * g[self.row], minlength=DIMENSIONS), self.statistics.T @ g])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def minimise(positive: _Table, unlabelled: _Table, prior: float, steps: int = STEPS, ridge: float = 1e-4):
    """Adam on the non-negative risk with the sigmoid loss. Where the corrected risk of the unlabelled text falls below
    zero, the step goes the other way on that part alone."""
    w, b = np.zeros(DIMENSIONS + STATISTICS), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        p, u = _sigmoid(positive.times(w, b)), _sigmoid(unlabelled.times(w, b))
        slope_p, slope_u = p * (1 - p) / max(1, positive.size), u * (1 - u) / max(1, unlabelled.size)
        corrected = u.mean() - prior * p.mean()
        if corrected >= 0:
            gp, gu = -2 * prior * slope_p, slope_u
        else:
            gp, gu = prior * slope_p, -slope_u
        grad = np.append(positive.gradient(gp) + unlabelled.gradient(gu) + ridge * w, gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        change = 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, training: Column) -> Scorer:
    """Fit on trusted positives (``labels.quality`` 1) and unlabelled rows of ``docs``, both where ``training`` (of
    ``doc_id``) holds. The class prior is the share of positives among the labelled rows there.

    Null labels and ids are left out; an id with several labels is good if all of them are; equal texts of an id are one row.
    Every row teaches. The rows are dealt by their hash, so many to a task as the two limits say, each task fits a model and the
    models are averaged. Where positives are few against the unlabelled rows, several tasks have the same ones.
    Without positives or unlabelled rows the score is one half throughout.
    """
    known = labels.where(training).where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("good"))
    prior = known.agg(F.avg(F.col("good").cast("double"))).first()[0]
    good = written(known.where("good = 1").select("doc_id", F.lit(True).alias("positive")), "good")
    n_good = good.count()
    text = F.col("text").cast("string")
    texts = docs.where(training).where("doc_id IS NOT NULL").select("doc_id", F.xxhash64(text).alias("t"), text.alias("text"))
    counted = joined(texts.select("doc_id", "t").distinct(), good, "doc_id", "left", n_good, 16).agg(
        F.count(F.lit(1)).alias("rows"), F.count("positive").alias("positives")).first()
    shares = buckets_for(counted["positives"], MAX_POSITIVES)
    groups = max(shares, buckets_for(counted["rows"], MAX_UNLABELLED))
    if 2 * shares >= groups:
        shares = groups

    rows = texts.select("doc_id", "t", _packed("text").alias("packed")).dropDuplicates(["doc_id", "t"])
    rows = joined(rows, good, "doc_id", "left", n_good, 16)
    mark, own = F.col("positive").isNotNull(), F.pmod(F.xxhash64("doc_id", "t", F.lit(1)), F.lit(groups)).cast("int")
    if shares == groups:
        rows = rows.select("doc_id", "t", "packed", own.alias("group"), F.lit(True).alias("as_unlabelled"), mark.alias("as_positive"))
    else:  # a share of the positives goes to every so many groups
        share = F.pmod(F.xxhash64("doc_id", "t", F.lit(2)), F.lit(shares)).cast("int")
        places = F.transform(F.sequence(share, F.lit(groups - 1), F.lit(shares)), lambda g: F.struct(
            g.alias("group"), F.lit(False).alias("as_unlabelled"), F.lit(True).alias("as_positive")))
        mine = F.array(F.struct(own.alias("group"), F.lit(True).alias("as_unlabelled"), F.lit(False).alias("as_positive")))
        rows = rows.select("doc_id", "t", "packed", F.explode(F.when(mark, F.concat(mine, places)).otherwise(mine)).alias("at")).select(
            "doc_id", "t", "packed", "at.*")

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "t"], kind="stable")
        positive, unlabelled = (_Table.of(pdf.loc[pdf[k], "packed"].tolist()) for k in ("as_positive", "as_unlabelled"))
        if not positive.size or not unlabelled.size:
            return pd.DataFrame({k: pd.Series([], dtype=object) for k in ("w", "b")})
        share = float(np.clip(prior, 0.01, 0.99))
        scale = np.stack([unlabelled.statistics.mean(axis=0), unlabelled.statistics.std(axis=0) + 1e-6])
        positive.scaled(scale)
        unlabelled.scaled(scale)
        w, b = minimise(positive, unlabelled, share)
        at = np.quantile(unlabelled.times(w, b), 1 - share)  # the prior's share of unlabelled text lies above
        b = b - at + np.log(ACCEPT / (1 - ACCEPT))
        w[DIMENSIONS:] /= scale[1]  # of the statistics as they are, so that the tasks' models have one scale
        return pd.DataFrame({"w": [w.tolist()], "b": [b - w[DIMENSIONS:] @ scale[0]]})

    plain = np.stack([np.zeros(STATISTICS), np.ones(STATISTICS)])
    if not counted["positives"]:
        return Scorer(np.zeros(DIMENSIONS + STATISTICS), 0.0, plain)
    fitted = rows.groupBy("group").applyInPandas(train, "w array<double>, b double")
    cells = fitted.select(F.posexplode(F.array_append("w", F.col("b"))).alias("i", "v")).groupBy("i").agg(F.avg("v").alias("v"))
    mean = np.array([r["v"] for r in sorted(cells.collect())])
    return Scorer(mean[:-1], float(mean[-1]), plain)


def scores(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """``doc_id`` and ``score`` of every row, from its whole text; null and blank texts are scored by their statistics."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        s = shared.value
        out = []
        for at, value, statistics in features_of(column):
            x = (value * s.weights[at]).sum() + ((statistics - s.scale[0]) / s.scale[1]) @ s.weights[DIMENSIONS:] + s.bias
            out.append(float(_sigmoid(np.float64(x))))
        return pa.array(out, pa.float64())

    return docs.select("doc_id", score(F.col("text").cast("string")).alias("score"))
