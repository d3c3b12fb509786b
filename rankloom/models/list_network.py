"""A scoring network trained on whole lists (E11): the likelihood of the observed order under the Plackett-Luce model.

Every level of every factor and every item has a vector; the vectors of a row's factor levels are added, set beside the item's
and scored by a small network. The loss of a list is ``-sum_i (s_i - log sum_{j >= i} exp s_j)`` over its items in their true
order, best first. Levels and items that were not seen have the zero vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from rankloom.models.gradient import fitted, matrix
from rankloom.models.networks import _WeightModel, backward, forward, layers_of, start_weights


def order_loss(scores: np.ndarray) -> tuple[float, np.ndarray]:
    """Loss and gradient of lists of equal length (lists, items) whose items stand in their true order."""
    rest = np.logaddexp.accumulate(scores[:, ::-1], axis=1)[:, ::-1]  # of each place and those after it, as logarithms
    share = np.logaddexp.accumulate(-rest, axis=1)  # every place up to here has this item among its rest
    return float((rest - scores).sum()), np.exp(scores + share) - 1.0


class _Shape:
    """Where what lies in the weight vector: a row of ``size`` for each level (row 0 is the zero vector), then the network."""

    def __init__(self, levels: list[int], size: int, hidden: list[int]):
        self.levels, self.size = levels, size
        self.first = np.cumsum([0, *levels[:-1]]) + 1  # the first row of each column's levels
        self.rows = sum(levels)
        self.sizes = [2 * size, *hidden, 1]

    def start(self, seed: int) -> np.ndarray:
        rng = np.random.default_rng(seed)
        return np.concatenate([rng.normal(size=self.rows * self.size) * 0.5, start_weights(self.sizes, rng)])

    def vectors(self, weights: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros((1, self.size)), weights[: self.rows * self.size].reshape(-1, self.size)])

    def at(self, codes: np.ndarray) -> np.ndarray:
        """The vector's row for codes 1, 2, ... of each column; anything else is unseen."""
        known = (codes > 0) & (codes <= np.array(self.levels))
        return np.where(known, codes - 1 + self.first, 0)

    def loss(self, batch: pa.RecordBatch, weights: np.ndarray) -> tuple[float, np.ndarray]:
        """Rows are lists: ``g``, the codes of its factor levels, and ``i``, those of its items in their true order."""
        group, items = matrix(batch.column("g")).astype(np.int64), matrix(batch.column("i")).astype(np.int64)
        lists, n = items.shape
        factor_at = self.at(np.concatenate([group, np.zeros((lists, 1), dtype=np.int64)], axis=1))[:, :-1]
        item_at = np.where((items > 0) & (items <= self.levels[-1]), items - 1 + self.first[-1], 0)
        vectors = self.vectors(weights)
        x = np.concatenate([np.repeat(vectors[factor_at].sum(axis=1), n, axis=0), vectors[item_at.ravel()]], axis=1)
        layers = layers_of(weights[self.rows * self.size:], self.sizes)
        seen = forward(x, layers)
        loss, pull = order_loss(seen[-1].reshape(lists, n))
        network, back = backward(seen, layers, pull.reshape(-1, 1))
        moved = np.zeros_like(vectors)
        per_list = back[:, : self.size].reshape(lists, n, -1).sum(axis=1)
        for k in range(factor_at.shape[1]):
            np.add.at(moved, factor_at[:, k], per_list)
        np.add.at(moved, item_at.ravel(), back[:, self.size:])
        return loss, np.concatenate([moved[1:].ravel(), network])

    def scores(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Rows are items: the codes of the factor levels, then that of the item."""
        at, vectors = self.at(codes), self.vectors(weights)
        x = np.concatenate([vectors[at[:, :-1]].sum(axis=1), vectors[at[:, -1]]], axis=1)
        return forward(x, layers_of(weights[self.rows * self.size:], self.sizes))[-1][:, 0]


class _ListParams(HasPredictionCol):
    factorCols = Param(Params._dummy(), "factorCols", "columns with codes of factor levels from 1", TypeConverters.toListString)
    itemCol = Param(Params._dummy(), "itemCol", "column with codes of items from 1", TypeConverters.toString)
    targetCol = Param(Params._dummy(), "targetCol", "the smaller the better", TypeConverters.toString)
    listCols = Param(Params._dummy(), "listCols", "columns that name a list", TypeConverters.toListString)
    size = Param(Params._dummy(), "size", "length of a vector", TypeConverters.toInt)
    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    penalty = Param(Params._dummy(), "penalty", "weight of the squared weights", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    levels = Param(Params._dummy(), "levels", "levels of each factor column, then items", TypeConverters.toListInt)

    def _list_defaults(self):
        self._setDefault(size=32, hidden=[256, 64], maxIter=100, penalty=1e-4, seed=0)

    def shape(self) -> _Shape:
        return _Shape(self.getOrDefault("levels"), self.getOrDefault("size"), self.getOrDefault("hidden"))


class ListScorer(Estimator, _ListParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits on rows of (list, item); lists are gathered by ``listCols``, so their length has to be bounded, as that of sampled
    lists is. The prediction is small for the best item, like the target. Rows without a target are left out; equal targets
    stand in the order of the item codes."""

    @keyword_only
    def __init__(self, *, factorCols=None, itemCol=None, targetCol=None, listCols=None, predictionCol="prediction", size=32,
                 hidden=None, maxIter=100, penalty=1e-4, seed=0):
        super().__init__()
        self._list_defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        factors, item = self.getOrDefault("factorCols"), self.getOrDefault("itemCol")
        rows = dataset.where(F.col(self.getOrDefault("targetCol")).isNotNull())
        entry = F.struct(F.col(self.getOrDefault("targetCol")).alias("t"), F.col(item).cast("int").alias("i"))
        lists = rows.groupBy(*self.getOrDefault("listCols")).agg(
            F.array(*[F.max(F.col(c).cast("int")) for c in factors]).alias("_codes"),
            F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["i"]).alias("_items")).select(
            F.col("_codes").alias("g"), F.col("_items").alias("i")).persist()
        try:
            top = lists.agg(*[F.max(F.col("g")[k]) for k in range(len(factors))], F.max(F.array_max("i"))).first()
            if top[-1] is None:
                raise ValueError("no lists to fit on")
            levels = [max(1, v or 0) for v in top]
            shape = _Shape(levels, self.getOrDefault("size"), self.getOrDefault("hidden"))

            def of(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[float, np.ndarray]:
                """Lists of one batch by length, as they are arrays."""
                sizes = np.diff(batch.column("i").offsets.to_numpy())
                loss, gradient = 0.0, np.zeros(len(weights))
                for n in np.unique(sizes[sizes > 0]):
                    part = batch.filter(pa.array(sizes == n))
                    a, b = shape.loss(part, weights)
                    loss, gradient = loss + a, gradient + b
                return loss, gradient

            weights = fitted(lists, of, shape.start(self.getOrDefault("seed")), self.getOrDefault("maxIter"),
                             self.getOrDefault("penalty"))
        finally:
            lists.unpersist()
        return self._copyValues(ListScorerModel())._set(levels=levels).with_weights(weights, dataset)


class ListScorerModel(_WeightModel, _ListParams):
    def __init__(self):
        super().__init__()
        self._list_defaults()

    def _transform(self, dataset):
        shape, shared = self.shape(), dataset.sparkSession.sparkContext.broadcast(self.weights())

        @F.arrow_udf("double")
        def score(codes: pa.Array) -> pa.Array:
            return pa.array(-shape.scores(matrix(codes).astype(np.int64), shared.value)) if len(codes) else pa.array([], pa.float64())

        codes = [F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in [*self.getOrDefault("factorCols"), self.getOrDefault("itemCol")]]
        return dataset.withColumn(self.getPredictionCol(), score(F.array(*codes)))
