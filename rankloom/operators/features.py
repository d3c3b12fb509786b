"""Numeric feature preparation and side-table features."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.state import TableModel
from rankloom.session import pin_state

FEATURE_PREFIX = "f_"


def column_statistics(df: DataFrame, columns: list[str]) -> dict[str, dict[str, float]]:
    """Rows, filled rows, mean and population variance of every column: one pass, one row on the driver."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}")]
    row = df.agg(*aggs).first()
    return {
        c: {"rows": row["n"], "filled": row[f"c{i}"], "mean": row[f"m{i}"] or 0.0, "var": row[f"v{i}"] or 0.0}
        for i, c in enumerate(columns)
    }


class _Fixed(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose state is one small number table, bounded by the number of columns."""

    values = Param(Params._dummy(), "values", "fitted numbers as JSON", TypeConverters.toString)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault("values"))


class MeanImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """missing values become the column mean."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        means = {c: s["mean"] for c, s in column_statistics(dataset, self.getInputCols()).items()}
        return self._copyValues(MeanImputerModel())._set(values=json.dumps(means))


class MeanImputerModel(_Fixed):
    def _transform(self, dataset):
        return dataset.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.fitted().items()})


class PopulationScaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """centre and divide by the population standard deviation; a constant column becomes 0."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        stats = column_statistics(dataset, self.getInputCols())
        scales = {c: [s["mean"], s["var"] ** 0.5 or 1.0] for c, s in stats.items()}
        return self._copyValues(PopulationScalerModel())._set(values=json.dumps(scales))


class PopulationScalerModel(_Fixed):
    def _transform(self, dataset):
        return dataset.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.fitted().items()})


class _SideParams(Params):
    key = Param(Params._dummy(), "key", "entity column", TypeConverters.toString)
    threshold = Param(Params._dummy(), "threshold", "drop columns with this null ratio or more", TypeConverters.toFloat)
    variance = Param(Params._dummy(), "variance", "explained variance kept by PCA; 1 = no PCA", TypeConverters.toFloat)
    prefix = Param(Params._dummy(), "prefix", "prefix of the feature columns", TypeConverters.toString)
    handleUnknown = Param(Params._dummy(), "handleUnknown", "unknown entity: 'null', 'impute' or 'error'",
                          TypeConverters.toString)

    def _defaults(self):
        self._setDefault(key="dataset", threshold=0.4, variance=1.0, prefix="dataset_metafeature_",
                         handleUnknown="null")


class SideTableFeatures(Estimator, _SideParams):
    """F8: features of an entity from a side table, restricted to the entities seen in training.

    Columns with too many missing values are dropped, the rest mean-imputed and standardised, optionally rotated and
    cut by PCA, then left-joined. Statistics come from one pass; only one row per column reaches the driver.
    """

    @keyword_only
    def __init__(self, *, key="dataset", threshold=0.4, variance=1.0, prefix="dataset_metafeature_",
                 handleUnknown="null"):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)
        self.side: DataFrame | None = None

    def on(self, side: DataFrame) -> SideTableFeatures:
        self.side = side
        return self

    def _fit(self, dataset):
        key, prefix = self.getOrDefault("key"), self.getOrDefault("prefix")
        side = self.side.join(dataset.select(key).distinct(), key, "left_semi")
        side = pin_state(side)
        columns = [c for c in side.columns if c != key]
        stats = column_statistics(side, columns)
        threshold = self.getOrDefault("threshold")
        stats = {c: s for c, s in stats.items() if s["rows"] and 1 - s["filled"] / s["rows"] < threshold}
        model = self._copyValues(SideTableModel())
        if not stats:
            return model.with_tables(features=side.select(key))
        scaled = {}
        for c, s in stats.items():
            # Imputing the mean keeps the mean and shrinks the variance by the filled share.
            std = (s["var"] * s["filled"] / max(s["rows"], 1)) ** 0.5 or 1.0
            scaled[c] = (F.coalesce(F.col(c).cast("double"), F.lit(s["mean"])) - F.lit(s["mean"])) / F.lit(std)
        ready = side.select(key, *[x.alias(f"{prefix}{i}") for i, x in enumerate(scaled.values())])
        if self.getOrDefault("variance") < 1:
            ready = principal_components(ready, key, self.getOrDefault("variance"), prefix)
        return model.with_tables(features=pin_state(ready))


def principal_components(df: DataFrame, key: str, variance: float, prefix: str) -> DataFrame:
    """the smallest number of components whose cumulative explained variance exceeds ``variance``."""
    columns = [c for c in df.columns if c != key]
    vectors = VectorAssembler(inputCols=columns, outputCol="_v").transform(df).select(key, "_v")
    pca = PCA(k=len(columns), inputCol="_v", outputCol="_p").fit(vectors)
    total, k = 0.0, 0
    for share in pca.explainedVariance.toArray():
        total, k = total + share, k + 1
        if total > variance:
            break
    parts = vector_to_array("_p")
    return pca.transform(vectors).select(key, *[parts[i].alias(f"{prefix}{i}") for i in range(k)])


class SideTableModel(TableModel, _SideParams):
    def __init__(self):
        super().__init__()
        self._defaults()

    def feature_names(self) -> list[str]:
        return [c for c in self.tables["features"].columns if c != self.getOrDefault("key")]

    def _transform(self, dataset):
        key, names = self.getOrDefault("key"), self.feature_names()
        side = self.tables["features"].withColumn("_known", F.lit(True))
        out = dataset.join(side, key, "left").select(*dataset.columns, *names, "_known")
        how = self.getOrDefault("handleUnknown")
        if how == "impute":  # the mean of a standardised column
            out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in names})
        elif how == "error":
            message = F.concat(F.lit(f"unknown {key} "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
            fail = F.raise_error(message).cast(dataset.schema[key].dataType)
            out = out.withColumn(key, F.when(F.col("_known"), F.col(key)).otherwise(fail))
        return out.drop("_known")


class AssembleFeatures(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """gather the prepared columns (those with the feature prefix, in name order) into one vector; every other
    column passes through."""

    prefix = Param(Params._dummy(), "prefix", "prefix of the prepared columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, prefix=FEATURE_PREFIX, outputCol="features"):
        super().__init__()
        self._setDefault(prefix=FEATURE_PREFIX, outputCol="features")
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        names = sorted(c for c in dataset.columns if c.startswith(self.getOrDefault("prefix")))
        if not names:  # baselines need no features
            names = ["_none"]
            dataset = dataset.withColumn("_none", F.lit(0.0))
        out = VectorAssembler(inputCols=names, outputCol=self.getOutputCol()).transform(dataset)
        return out.drop(*names)


class KeepColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """P1 as a stage: keep the listed columns that are present."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return dataset.select(*[c for c in self.getInputCols() if c in dataset.columns])


class DropColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """P2 as a stage."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        return dataset.drop(*self.getInputCols())
