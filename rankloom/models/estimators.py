"""The estimator behind each name (E1-E11), on the columns ``features`` and ``label``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from rankloom.models.baseline import BaselineEstimator
from rankloom.models.boosting import AdaBoostClassifier, SoftmaxBooster
from rankloom.models.multi_tree import MultiOutputTree
from rankloom.models.networks import MlpRegressor, RandomFourierFeatures, SupportVectorRegressor
from rankloom.session import DEALT_ROWS, packed

MAX_TREE_DEPTH = 30  # Spark's own limit; an unbounded depth means this one


class MlpClassifier(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable,
                    DefaultParamsWritable):
    """A multilayer perceptron whose input and output layers follow the data."""

    hidden = Param(Params._dummy(), "hidden", "hidden layer sizes", TypeConverters.toListInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", hidden=None,
                 maxIter=100, seed=0):
        super().__init__()
        self._setDefault(hidden=[100], maxIter=100, seed=0)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        width = len(dataset.select(self.getFeaturesCol()).first()[0])
        classes = int(dataset.agg(F.max(self.getLabelCol())).first()[0]) + 1
        return C.MultilayerPerceptronClassifier(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol(),
            layers=[width, *self.getOrDefault("hidden"), max(classes, 2)], maxIter=self.getOrDefault("maxIter"),
            seed=self.getOrDefault("seed"),
        ).fit(dataset)


class SharedOneVsRest(C.OneVsRest):
    """One model for each class, some at a time, which share the cores: each reads a part of as many partitions as there are
    cores. An evaluation of a gradient then is one wave of tasks, and its sums are added in one step and not in two."""

    def _fit(self, dataset):
        with packed(dataset) as rows:
            cores = rows.sparkSession.sparkContext.defaultParallelism
            wanted = max(-(-cores // self.getParallelism()), -(-rows.count() // DEALT_ROWS))
            few = rows.coalesce(wanted) if rows.rdd.getNumPartitions() > wanted else rows
            return super()._fit(few)


def _one_vs_rest(base: Estimator, features: str = "features") -> Estimator:
    return SharedOneVsRest(classifier=base, labelCol="label", featuresCol=features, predictionCol="prediction", parallelism=4)


def _tree(cls, depth=10, leaf=1, bins=64, seed=0, **other) -> Estimator:
    depth = MAX_TREE_DEPTH if depth is None else int(depth)
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"depth {depth}: trees have at most {MAX_TREE_DEPTH} levels here; None stands for that")
    return cls(maxDepth=depth, minInstancesPerNode=int(leaf), maxBins=bins, seed=seed, maxMemoryInMB=512,
               labelCol="label", **other)


SUBSETS = {None: "all", "sqrt": "sqrt", "log2": "log2"}


def _forest(cls, trees=100, subset=None, **settings) -> Estimator:
    return _tree(cls, numTrees=int(trees), featureSubsetStrategy=SUBSETS.get(subset, subset), **settings)


def _one_tree(cls, forest, subset=None, **settings) -> Estimator:
    """One tree; with a subset of the features for each node it is a forest of one on all rows."""
    return _tree(cls, **settings) if subset is None else _forest(forest, 1, subset, bootstrap=False, **settings)


def _multi_tree(depth=None, leaf=1, split=2, subset=None, **settings) -> Estimator:
    return MultiOutputTree(depth=int(depth or 0), leaf=int(leaf), split=int(split), subset=SUBSETS.get(subset, subset), **settings)


def _kernel(last: Estimator, components=512, gamma=None, seed=0) -> Estimator:
    """A linear model on random Fourier features, which stand for a radial kernel."""
    return Pipeline(stages=[RandomFourierFeatures(components=components, gamma=gamma, seed=seed), last])


def _fourier_svc(iterations=50, penalty=1e-4, **kernel) -> Estimator:
    base = C.LinearSVC(maxIter=iterations, regParam=penalty)
    return _kernel(_one_vs_rest(base, "fourier"), **kernel)


def _fourier_svr(epsilon=0.1, cost=1.0, maxIter=100, **kernel) -> Estimator:
    return _kernel(SupportVectorRegressor(featuresCol="fourier", epsilon=epsilon, cost=cost, maxIter=maxIter), **kernel)


ESTIMATORS: dict[str, Callable[..., Estimator]] = {
    "mean": lambda strategy="mean", **s: BaselineEstimator(strategy=strategy, **s),
    "median": lambda strategy="median", **s: BaselineEstimator(strategy=strategy, **s),
    "most_frequent": lambda strategy="most_frequent", **s: BaselineEstimator(strategy=strategy, **s),
    "linear": lambda **s: R.LinearRegression(labelCol="label", **s),
    "tree": lambda **s: _one_tree(R.DecisionTreeRegressor, R.RandomForestRegressor, **s),
    "multi_tree": _multi_tree,
    "forest": lambda **s: _forest(R.RandomForestRegressor, **s),
    "boosting": lambda depth=5, rounds=100, **s: _tree(R.GBTRegressor, depth=depth, maxIter=rounds, **s),
    "factorization": lambda **s: R.FMRegressor(labelCol="label", **s),
    "mlp": lambda **s: MlpRegressor(**s),
    "svr": lambda **s: SupportVectorRegressor(**s),
    "kernel_svr": _fourier_svr,
    "tree_classifier": lambda **s: _one_tree(C.DecisionTreeClassifier, C.RandomForestClassifier, **s),
    "forest_classifier": lambda subset="sqrt", **s: _forest(C.RandomForestClassifier, subset=subset, **s),
    "boosting_classifier": lambda depth=5, rounds=100, **s: SoftmaxBooster(depth=depth, rounds=rounds, **s),
    "boosting_one_vs_rest": lambda depth=5, rounds=100, **s: _one_vs_rest(
        _tree(C.GBTClassifier, depth=depth, maxIter=rounds, **s)),
    "adaboost_classifier": lambda **s: AdaBoostClassifier(**s),
    "mlp_classifier": lambda **s: MlpClassifier(**s),
    "svc_classifier": lambda iterations=50, **s: _one_vs_rest(C.LinearSVC(maxIter=iterations, **s)),
    "kernel_svc_classifier": _fourier_svc,
}


def make_estimator(kind: str, **settings) -> Estimator:
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown estimator {kind!r}, expected one of {sorted(ESTIMATORS)}")
    return ESTIMATORS[kind](**settings)


class PerOutputEstimator:
    """A copy of one estimator per target column, fitted concurrently on one cached frame.

    The fitted stages form an ordinary ``PipelineModel``; ``prediction_name`` gives the column of each output.
    """

    def __init__(self, kind: str, outputs: Sequence[str], parallelism: int = 4, **settings):
        self.kind, self.outputs, self.parallelism, self.settings = kind, list(outputs), parallelism, settings

    @staticmethod
    def prediction_name(output: str) -> str:
        return f"prediction__{output}"

    def _fit_one(self, frame, output: str):
        one = make_estimator(self.kind, **self.settings)
        one = one.copy({one.labelCol: output, one.predictionCol: self.prediction_name(output)})
        return one.fit(frame)

    def fit(self, df) -> PipelineModel:
        with packed(df) as frame, ThreadPool(self.parallelism) as pool:
            fit_one = inheritable_thread_target(df.sparkSession)(lambda o: self._fit_one(frame, o))
            models = pool.map(fit_one, self.outputs)
        return PipelineModel(stages=models)
