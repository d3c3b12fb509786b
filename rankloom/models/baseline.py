"""Constant predictors."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from rankloom.operators.profile import exact_quantiles


class _Constant(HasLabelCol, HasPredictionCol):
    strategy = Param(Params._dummy(), "strategy", "'mean', 'median' or 'most_frequent'", TypeConverters.toString)


class BaselineEstimator(Estimator, _Constant, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the mean, the median or the most frequent label (smallest among equals)."""

    @keyword_only
    def __init__(self, *, labelCol="label", predictionCol="prediction", strategy="mean"):
        super().__init__()
        self._setDefault(strategy="mean")
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        label, strategy = self.getLabelCol(), self.getOrDefault("strategy")
        if strategy == "mean":
            value = dataset.agg(F.avg(label)).first()[0]
        elif strategy == "median":
            value = exact_quantiles(dataset, label, [0.5]).first()["value"]
        elif strategy == "most_frequent":
            counts = dataset.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
            value = counts.orderBy(F.desc("n"), label).first()[0]
        else:
            raise ValueError(f"unknown strategy {strategy!r}")
        return self._copyValues(BaselineModel())._set(value=float(value))


class BaselineModel(Model, _Constant, DefaultParamsReadable, DefaultParamsWritable):
    value = Param(Params._dummy(), "value", "the constant", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(strategy="mean")

    def _transform(self, dataset):
        return dataset.withColumn(self.getPredictionCol(), F.lit(self.getOrDefault("value")))
