"""Boosting of several classes: one softmax round for all classes at a time (E5), and reweighted trees (SAMME)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.models.gradient import matrix
from rankloom.models.multi_tree import (
    LOCAL_ROWS, Tree, _bin_kind, _binned_rows, _lists, _raw, _TreeParams, _unraw, grown, rounding, thresholds_of,
)
from rankloom.operators.state import TableModel
from rankloom.session import durable

PIN_EVERY = 10  # rounds between two reliable checkpoints of the rows' scores or weights


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class SoftmaxBooster(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient boosting for several classes. The features are binned once; each round grows one tree whose outputs are the
    classes, on the gradients of the log-loss, and its leaves take one Newton step per class. Labels are 0, 1, ..."""

    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a step that is taken", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rounds=100, rate=0.1, depth=5,
                 leaf=1, split=2, subset="all", bins=64, seed=0, localRows=LOCAL_ROWS):
        super().__init__()
        self._tree_defaults(rounds=100, rate=0.1)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        limits, n_bins = self.limits(), self.getOrDefault("bins")
        rate, local = self.getOrDefault("rate"), self.getOrDefault("localRows")
        label = F.col(self.getLabelCol()).cast("int")
        plain = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), label.alias("label"))
        plain = plain.where("x IS NOT NULL AND label IS NOT NULL").persist()
        try:
            counts = {r["label"]: r["count"] for r in plain.groupBy("label").count().collect()}
            if not counts or min(counts) < 0:
                raise ValueError("labels are 0, 1, ... and at least one row has one")
            classes, n = max(2, max(counts) + 1), sum(counts.values())
            width = len(plain.first()["x"])
            # A class without rows starts as one with half a row.
            start = np.log(np.array([max(0.5, counts.get(k, 0)) for k in range(classes)]) / n)
            thresholds = thresholds_of(plain, "x", n_bins)
            kind = _bin_kind(n_bins)
            rows, before = _started(_binned_rows(plain, "x", thresholds, n_bins), start).persist(), None
            trees = []
            for number in range(self.getOrDefault("rounds")):
                # The first pass over new rows also keeps them; then those they are made of can go.
                tree = grown(rows.select("b", "y"), n, np.zeros(classes), width, n_bins, limits, local)
                leaves = self._steps(rows, tree, classes, rate, kind)
                if before is not None:
                    before.unpersist()
                trees.append((tree, leaves))
                if number + 1 < self.getOrDefault("rounds"):
                    moved = _moved(rows, tree, leaves, kind)
                    before, rows = rows, (durable(moved) if (number + 1) % PIN_EVERY == 0 else moved).persist()
            rows.unpersist()
        finally:
            plain.unpersist()
        return self._copyValues(SoftmaxBoosterModel())._with(dataset, trees, thresholds, start)

    @staticmethod
    def _steps(rows: DataFrame, tree: list[tuple], classes: int, rate: float, kind: np.dtype) -> np.ndarray:
        """One Newton step for each leaf and class, from sums of gradients and curvatures; one row per leaf reaches the driver."""
        walk = rows.sparkSession.sparkContext.broadcast(Tree(tree))
        schema = pa.schema([("leaf", pa.int32()), ("k", pa.int32()), ("g", pa.float64()), ("h", pa.float64())])

        def add(batches):
            g = h = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                at = walk.value.leaves(_unraw(batch.column("b"), kind))
                p = softmax(_unraw(batch.column("scores"), np.dtype(np.float64)))
                off = _pull(p, batch.column("label"))
                if g is None:
                    g, h = np.zeros((len(tree), classes)), np.zeros((len(tree), classes))
                for k in range(classes):
                    g[:, k] += np.bincount(at, off[:, k], minlength=len(tree))
                    h[:, k] += np.bincount(at, p[:, k] * (1 - p[:, k]), minlength=len(tree))
            if g is not None:
                leaf, k = np.nonzero(h)
                yield pa.RecordBatch.from_arrays([
                    pa.array(leaf, pa.int32()), pa.array(k, pa.int32()), pa.array(g[leaf, k]), pa.array(h[leaf, k])], schema=schema)

        # Rounded to nine digits, so that the order of the sums does not show.
        found = rows.select("b", "label", "scores").mapInArrow(add, "leaf int, k int, g double, h double").groupBy("leaf", "k").agg(
            F.round(F.sum("g"), 9).alias("g"), F.round(F.sum("h"), 9).alias("h")).collect()
        walk.destroy()
        steps = np.zeros((len(tree), classes))
        for r in found:
            steps[r["leaf"], r["k"]] = rate * (classes - 1) / classes * r["g"] / max(r["h"], 1e-9)
        return np.clip(steps, -4.0, 4.0)


def _pull(p: np.ndarray, label: pa.Array) -> np.ndarray:
    """The gradients: how far each class's probability is from the label."""
    off = -p
    off[np.arange(len(off)), label.to_numpy()] += 1
    return off


def _scored(label: pa.Array, scores: np.ndarray) -> list[pa.Array]:
    """The scores, and the rounded gradients that the next tree is grown on, as bytes."""
    return [_raw(scores), _raw(np.rint(_pull(softmax(scores), label) * rounding(1.0)))]


_ROWS = "b binary, label int, scores binary, y binary"
_ROWS_NAMES = ["b", "label", "scores", "y"]


def _started(df: DataFrame, start: np.ndarray) -> DataFrame:
    def begin(batches):
        for batch in batches:
            if batch.num_rows:
                b, label = batch.column("b"), batch.column("label")
                yield pa.RecordBatch.from_arrays([b, label, *_scored(label, np.tile(start, (len(label), 1)))], names=_ROWS_NAMES)

    return df.select("b", "label").mapInArrow(begin, _ROWS)


def _moved(df: DataFrame, tree: list[tuple], leaves: np.ndarray, kind: np.dtype) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast((Tree(tree), leaves))

    def move(batches):
        walk, steps = shared.value
        for batch in batches:
            if batch.num_rows:
                b, label = batch.column("b"), batch.column("label")
                scores = _unraw(batch.column("scores"), np.dtype(np.float64)) + steps[walk.leaves(_unraw(b, kind))]
                yield pa.RecordBatch.from_arrays([b, label, *_scored(label, scores)], names=_ROWS_NAMES)

    return df.select("b", "label", "scores").mapInArrow(move, _ROWS)


class SoftmaxBoosterModel(TableModel, _TreeParams):
    """``tree, node, feature, threshold, left, right, step`` of all rounds, and the first scores as tree -1."""

    rounds, rate = SoftmaxBooster.rounds, SoftmaxBooster.rate

    def __init__(self):
        super().__init__()
        self._tree_defaults(rounds=100, rate=0.1)

    def _with(self, df: DataFrame, trees, thresholds, start):
        rows = [(-1, 0, -1, None, -1, -1, start.tolist())]
        for t, (tree, steps) in enumerate(trees):
            rows += [(t, r[0], r[2], float(thresholds[r[2]][r[3]]) if r[2] >= 0 else None, r[4], r[5], s.tolist())
                     for r, s in zip(tree, steps)]
        schema = "tree int, node bigint, feature int, threshold double, left bigint, right bigint, step array<double>"
        return self.with_tables(trees=df.sparkSession.createDataFrame(rows, schema))

    def _transform(self, dataset):
        by_tree: dict[int, list] = {}
        for r in self.tables["trees"].collect():  # bounded when fitted: rounds times nodes of a tree
            by_tree.setdefault(r["tree"], []).append(r)
        start = np.array(by_tree.pop(-1)[0]["step"])
        walks = [(Tree([(r["node"], 0, r["feature"], r["threshold"], r["left"], r["right"]) for r in by_tree[t]]),
                  np.array([r["step"] for r in by_tree[t]])) for t in sorted(by_tree)]
        shared = dataset.sparkSession.sparkContext.broadcast((start, walks))

        @F.arrow_udf("array<double>")
        def score(x: pa.Array) -> pa.Array:
            start, walks = shared.value
            if not len(x):
                return pa.array([], pa.list_(pa.float64()))
            values = matrix(x)
            out = np.tile(start, (len(values), 1))
            for walk, steps in walks:
                out += steps[walk.leaves(values)]
            return _lists(softmax(out), pa.float64())

        p = score(vector_to_array(self.getFeaturesCol()))
        best = F.array_position(F.col("probabilities"), F.array_max("probabilities")) - 1
        return dataset.withColumn("probabilities", p).withColumn(self.getPredictionCol(), best.cast("double"))


# --- reweighted trees -----------------------------------------------------------------------------------------------

class AdaBoostClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """SAMME: trees fitted one after another on weights that grow where the last one erred. It stops when a tree is no better
    than chance, which is not kept unless it is the first, or has no error, which is kept."""

    rounds = Param(Params._dummy(), "rounds", "trees at most", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a tree's weight that counts", TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "bins of a feature", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rounds=50, depth=1, rate=1.0,
                 bins=64, seed=0):
        super().__init__()
        self._setDefault(rounds=50, depth=1, rate=1.0, bins=64, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        features, label = self.getFeaturesCol(), self.getLabelCol()
        rows = dataset.where(F.col(label).isNotNull()).select(
            F.col(features).alias("features"), F.col(label).cast("double").alias("label")).persist()
        try:
            n, top = rows.agg(F.count(F.lit(1)), F.max("label")).first()
            if not n:
                raise ValueError("no rows to fit on")
            classes = max(2, int(top) + 1)
            tree = DecisionTreeClassifier(
                weightCol="w", maxDepth=self.getOrDefault("depth"), maxBins=self.getOrDefault("bins"), seed=self.getOrDefault("seed"),
                minWeightFractionPerNode=0.0, predictionCol="_p", rawPredictionCol="_raw", probabilityCol="_prob")
            weighted = rows.withColumn("w", F.lit(1.0)).persist()
            trees, alphas, errors = [], [], []
            for number in range(self.getOrDefault("rounds")):
                fitted = tree.fit(weighted)
                scored = fitted.transform(weighted).select("features", "label", "w", (F.col("_p") != F.col("label")).alias("miss"))
                missed, total = scored.agg(F.sum(F.when(F.col("miss"), F.col("w")).otherwise(0.0)), F.sum("w")).first()
                error = missed / total
                if error >= 1 - 1 / classes and trees:
                    break
                alpha = self.getOrDefault("rate") * (math.log((1 - error) / error) + math.log(classes - 1)) if error > 1e-12 else 1.0
                trees, alphas, errors = [*trees, fitted], [*alphas, alpha], [*errors, error]
                if error <= 1e-12 or error >= 1 - 1 / classes:
                    break
                # The mean weight stays one; the last round's rows are kept until this one's are.
                mean = (total - missed + missed * math.exp(alpha)) / n
                moved = scored.select("features", "label", (F.col("w") * F.when(F.col("miss"), math.exp(alpha)).otherwise(1.0) / mean).alias("w"))
                moved = (durable(moved) if (number + 1) % PIN_EVERY == 0 else moved).persist()
                moved.count()
                weighted.unpersist()
                weighted = moved
            weighted.unpersist()
        finally:
            rows.unpersist()
        model = self._copyValues(AdaBoostModel())
        model.trees = trees
        return model._set(alphas=[float(a) for a in alphas], errors=[float(e) for e in errors], classes=classes)


class AdaBoostModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Trees with a vote each; the class with most votes wins, the smallest of several."""

    rounds, depth, rate, bins, seed = (getattr(AdaBoostClassifier, p) for p in ("rounds", "depth", "rate", "bins", "seed"))
    alphas = Param(Params._dummy(), "alphas", "the trees' votes", TypeConverters.toListFloat)
    errors = Param(Params._dummy(), "errors", "the weighted error of each round", TypeConverters.toListFloat)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self.trees: list[DecisionTreeClassificationModel] = []

    def _transform(self, dataset):
        out, names = dataset, []
        for t, tree in enumerate(self.trees):
            one = tree.copy({tree.featuresCol: self.getFeaturesCol(), tree.predictionCol: f"_p{t}", tree.rawPredictionCol: "",
                             tree.probabilityCol: ""})
            out = one.transform(out)
            names.append(f"_p{t}")
        alphas, classes = self.getOrDefault("alphas"), self.getOrDefault("classes")

        # Outside of Catalyst's lambdas, which would ask every tree anew for each class.
        @F.arrow_udf("double")
        def most(guesses: pa.Array) -> pa.Array:
            each = matrix(guesses).astype(np.int64)
            votes, rows = np.zeros((len(each), classes)), np.arange(len(each))
            for t, alpha in enumerate(alphas if len(each) else []):
                votes[rows, each[:, t]] += alpha
            return pa.array(votes.argmax(axis=1).astype(np.float64))

        return out.withColumn(self.getPredictionCol(), most(F.array(*names))).drop(*names)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.trees = self.trees
        return out

    def write(self):
        return _AdaBoostWriter(self)

    def save(self, path: str) -> None:
        self.write().save(path)

    @classmethod
    def read(cls):
        return _AdaBoostReader(cls)

    @classmethod
    def load(cls, path: str):
        return cls.read().load(path)


class _AdaBoostWriter(MLWriter):
    def __init__(self, model: AdaBoostModel):
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self._model, path, self.sparkSession, extraMetadata={"trees": len(self._model.trees)})
        for t, tree in enumerate(self._model.trees):
            tree.write().save(f"{path}/trees/{t}")


class _AdaBoostReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self._cls = cls

    def load(self, path: str) -> AdaBoostModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self._cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.trees = [DecisionTreeClassificationModel.load(f"{path}/trees/{t}") for t in range(metadata["trees"])]
        return model
