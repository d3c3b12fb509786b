"""Regressors and feature maps that Spark lacks: a multilayer perceptron regressor, support vector regression and random
Fourier features for radial kernels, as pyspark.ml stages on ``features`` and ``label``."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.models.gradient import fitted, matrix
from rankloom.operators.state import TableModel


def _number(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toFloat)


def _whole(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toInt)


def _moments(df: DataFrame, *cols: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and spread of each component; a spread of zero counts as one."""
    stats = df.agg(*[Summarizer.metrics("mean", "std").summary(F.col(c)).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    out = []
    for m in stats:
        spread = np.array(m["std"])
        out.append((np.array(m["mean"]), np.where(spread > 0, spread, 1.0)))
    return out


def _vectors(df: DataFrame, features: str, label: str) -> DataFrame:
    return df.where(F.col(label).isNotNull()).select(
        vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))


class _WeightModel(TableModel, HasFeaturesCol, HasPredictionCol):
    """A model of one weight vector, kept as a table of blocks."""

    def with_weights(self, weights: np.ndarray, df: DataFrame):
        rows = [(a, weights[a:a + 4096].tolist()) for a in range(0, len(weights), 4096)]
        return self.with_tables(weights=df.sparkSession.createDataFrame(rows, "first bigint, w array<double>"))

    def weights(self) -> np.ndarray:
        return np.concatenate([r["w"] for r in self.tables["weights"].orderBy("first").collect()])

    def _predicted(self, dataset: DataFrame, of) -> DataFrame:
        """``of``: from (rows, width) and the weights to the predictions."""
        shared = dataset.sparkSession.sparkContext.broadcast(self.weights())

        @F.arrow_udf("double")
        def predict(x: pa.Array) -> pa.Array:
            return pa.array(of(matrix(x), shared.value)) if len(x) else pa.array([], pa.float64())

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))


# --- multilayer perceptron ------------------------------------------------------------------------------------------

def layers_of(weights: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The matrices and offsets of a network in its weight vector, as views."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((weights[at:at + a * b].reshape(a, b), weights[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def start_weights(sizes: list[int], rng: np.random.Generator) -> np.ndarray:
    """Uniform within the bounds that keep the spread of what passes through the layers; offsets are zero."""
    return np.concatenate([np.concatenate([rng.uniform(-1, 1, a * b) * np.sqrt(6.0 / (a + b)), np.zeros(b)])
                           for a, b in zip(sizes, sizes[1:])])


def forward(x: np.ndarray, layers) -> list[np.ndarray]:
    """The input and what each layer gives; all but the last are cut at zero."""
    seen = [x]
    for i, (w, b) in enumerate(layers):
        x = x @ w + b
        if i + 1 < len(layers):
            x = np.maximum(x, 0.0)
        seen.append(x)
    return seen


def backward(seen: list[np.ndarray], layers, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The gradients with respect to the weights and to the input, from that with respect to the output."""
    parts = []
    for i in range(len(layers) - 1, -1, -1):
        parts += [out.sum(axis=0), (seen[i].T @ out).ravel()]
        out = out @ layers[i][0].T
        if i:
            out = out * (seen[i] > 0)
    return np.concatenate(parts[::-1]), out


def squared_error(sizes: list[int]):
    """Half the squared error of a network with one output."""

    def of(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[float, np.ndarray]:
        x, y = matrix(batch.column("x")), batch.column("y").to_numpy()
        layers = layers_of(weights, sizes)
        seen = forward(x, layers)
        off = seen[-1][:, 0] - y
        return 0.5 * float(off @ off), backward(seen, layers, off[:, None])[0]

    return of


class _MlpParams(HasFeaturesCol, HasPredictionCol):
    sizes = Param(Params._dummy(), "sizes", "layer sizes, input and output included", TypeConverters.toListInt)
    centre = Param(Params._dummy(), "centre", "means of the features, then of the label", TypeConverters.toListFloat)
    spread = Param(Params._dummy(), "spread", "spreads of the features, then of the label", TypeConverters.toListFloat)


class MlpRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """A multilayer perceptron for regression: cut-off linear layers, squared error, L-BFGS over the summed gradient.
    Features and label are centred and scaled first."""

    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    maxIter = _whole("maxIter", "iterations")
    penalty = _number("penalty", "weight of the squared weights")
    seed = _whole("seed", "seed")

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", hidden=None, maxIter=200,
                 penalty=1e-4, seed=0):
        super().__init__()
        self._setDefault(hidden=[100], maxIter=200, penalty=1e-4, seed=0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        rows = dataset.where(F.col(self.getLabelCol()).isNotNull())
        rows = rows.select(F.col(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        (mean, spread), (y_mean, y_spread) = _moments(rows.withColumn("_y", array_to_vector(F.array("y"))), "x", "_y")
        sizes = [len(mean), *self.getOrDefault("hidden"), 1]
        scaled = rows.select(vector_to_array("x").alias("x"), ((F.col("y") - float(y_mean[0])) / float(y_spread[0])).alias("y"))
        plain = squared_error(sizes)

        def of(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[float, np.ndarray]:
            x = (matrix(batch.column("x")) - mean) / spread
            flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(mean)).cast(pa.list_(pa.float64()))
            return plain(pa.RecordBatch.from_arrays([flat, batch.column("y")], names=["x", "y"]), weights)

        start = start_weights(sizes, np.random.default_rng(self.getOrDefault("seed")))
        weights = fitted(scaled, of, start, self.getOrDefault("maxIter"), self.getOrDefault("penalty"))
        model = self._copyValues(MlpRegressorModel()).with_weights(weights, dataset)
        return model._set(sizes=sizes, centre=[*mean, *y_mean], spread=[*spread, *y_spread])


class MlpRegressorModel(_WeightModel, _MlpParams):
    def _transform(self, dataset):
        sizes = self.getOrDefault("sizes")
        centre, spread = (np.array(self.getOrDefault(p)) for p in ("centre", "spread"))

        def of(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
            out = forward((x - centre[:-1]) / spread[:-1], layers_of(weights, sizes))[-1][:, 0]
            return out * spread[-1] + centre[-1]

        return self._predicted(dataset, of)


# --- support vector regression --------------------------------------------------------------------------------------

def tube_error(epsilon: float, mean: np.ndarray, spread: np.ndarray):
    """Half the square of what an error exceeds ``epsilon`` by, of a linear function with its offset last."""

    def of(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[float, np.ndarray]:
        x, y = (matrix(batch.column("x")) - mean) / spread, batch.column("y").to_numpy()
        off = x @ weights[:-1] + weights[-1] - y
        off = np.sign(off) * np.maximum(np.abs(off) - epsilon, 0.0)
        return 0.5 * float(off @ off), np.concatenate([x.T @ off, [off.sum()]])

    return of


class SupportVectorRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable,
                             DefaultParamsWritable):
    """Linear regression that ignores errors up to ``epsilon`` and squares what exceeds it. ``cost`` is how much an error
    counts against the squared weights, per row. The features are centred and scaled; the label is taken as it is."""

    epsilon = _number("epsilon", "errors up to this are none")
    cost = _number("cost", "weight of the errors")
    maxIter = _whole("maxIter", "iterations")

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", epsilon=0.1, cost=1.0,
                 maxIter=100):
        super().__init__()
        self._setDefault(epsilon=0.1, cost=1.0, maxIter=100)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        rows = dataset.where(F.col(self.getLabelCol()).isNotNull()).select(
            F.col(self.getFeaturesCol()).alias("v"), F.col(self.getLabelCol()).cast("double").alias("y")).persist()
        try:
            (mean, spread), = _moments(rows, "v")
            n = rows.count()
            penalty = np.full(len(mean) + 1, 1.0 / (self.getOrDefault("cost") * max(1, n)))
            penalty[-1] = 0.0
            weights = fitted(rows.select(vector_to_array("v").alias("x"), "y"),
                             tube_error(self.getOrDefault("epsilon"), mean, spread), np.zeros(len(mean) + 1),
                             self.getOrDefault("maxIter"), penalty)
        finally:
            rows.unpersist()
        slope = weights[:-1] / spread
        model = self._copyValues(SupportVectorRegressionModel())
        return model.with_weights(np.concatenate([slope, [weights[-1] - slope @ mean]]), dataset)


class SupportVectorRegressionModel(_WeightModel):
    def _transform(self, dataset):
        return self._predicted(dataset, lambda x, w: x @ w[:-1] + w[-1])


# --- random Fourier features ----------------------------------------------------------------------------------------

class RandomFourierFeatures(Estimator, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose inner products approximate the radial kernel exp(-gamma * squared distance); the error of a kernel
    value has a spread of about one over the root of ``components``. ``gamma`` None: one over the number of features times
    their variance."""

    components = _whole("components", "how many features")
    gamma = _number("gamma", "the kernel's factor of squared distances")
    seed = _whole("seed", "seed")

    @keyword_only
    def __init__(self, *, featuresCol="features", outputCol="fourier", components=512, gamma=None, seed=0):
        super().__init__()
        self._setDefault(components=512, seed=0, outputCol="fourier")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        name = self.getFeaturesCol()
        stats = dataset.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col(name)).alias("m")).first()[0]
        mean, n = np.array(stats["mean"]), stats["count"]
        # The variance of all numbers together: that inside the columns and that between their means.
        variance = float(np.mean(np.array(stats["variance"]) * (n - 1) / max(1, n)) + mean.var())
        gamma = self.getOrDefault("gamma") if self.isDefined("gamma") else 1.0 / (len(mean) * (variance or 1.0))
        model = self._copyValues(RandomFourierModel())
        return model._set(width=len(mean), gamma=gamma)


class RandomFourierModel(Model, HasFeaturesCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    components, gamma, seed = RandomFourierFeatures.components, RandomFourierFeatures.gamma, RandomFourierFeatures.seed
    width = _whole("width", "number of input features")

    def __init__(self):
        super().__init__()
        self._setDefault(components=512, seed=0, outputCol="fourier")

    def _transform(self, dataset):
        n, width, gamma = (self.getOrDefault(p) for p in ("components", "width", "gamma"))
        seed = self.getOrDefault("seed")

        @F.arrow_udf("array<double>")
        def cosines(x: pa.Array) -> pa.Array:
            rng = np.random.default_rng(seed)  # the same in every task
            w, b = rng.normal(size=(width, n)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, n)
            out = np.sqrt(2.0 / n) * np.cos(matrix(x).reshape(-1, width) @ w + b)
            return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), n).cast(pa.list_(pa.float64()))

        made: Column = cosines(vector_to_array(self.getFeaturesCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(made))


