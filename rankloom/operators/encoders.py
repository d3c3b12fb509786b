"""Categorical encoders as Estimator -> Model pairs. Level order is by value, since a table has no row order."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators.skew import value_positions
from rankloom.operators.state import TableModel, join_state
from rankloom.session import pin_state


class _Encoder(HasInputCol, HasOutputCol, HasLabelCol):
    """Shared parameters. ``outputCol`` is the column, or the prefix when there are several."""

    handleInvalid = Param(Params._dummy(), "handleInvalid", "unseen levels: 'keep' or 'error'",
                          TypeConverters.toString)

    needs_target = False

    def _defaults(self, **kwargs):
        self._setDefault(handleInvalid="keep", **kwargs)

    def _unseen(self, dtype: str):
        name = self.getInputCol()
        message = F.concat(F.lit(f"unseen level in {name}: "), F.coalesce(F.col(name).cast("string"), F.lit("null")))
        return F.raise_error(message).cast(dtype)

    def _or_invalid(self, value, fallback, dtype: str):
        other = self._unseen(dtype) if self.getOrDefault("handleInvalid") == "error" else F.lit(fallback)
        return F.when(value.isNotNull(), value).otherwise(other).cast(dtype)


class _EncoderEstimator(Estimator, _Encoder, DefaultParamsReadable, DefaultParamsWritable):
    def _levels(self, df: DataFrame) -> DataFrame:
        """Sorted levels with codes 1..n, evaluated once."""
        col = self.getInputCol()
        places = value_positions(df, [], col)
        return pin_state(places.select(F.col(col), (F.col("distinct_before") + 1).cast("int").alias("code")))


class OrdinalEncoder(_EncoderEstimator):
    """level -> 1..n by value; unseen -> -1."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid="keep"):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        return self._copyValues(OrdinalEncoderModel().with_tables(levels=self._levels(dataset)))


class OrdinalEncoderModel(TableModel, _Encoder):
    def __init__(self):
        super().__init__()
        self._defaults()

    def _transform(self, dataset):
        out, code = join_state(dataset, self.tables["levels"], [self.getInputCol()], "code")
        return out.withColumn(self.getOutputCol(), self._or_invalid(code, -1, "int")).drop("_state_code")


class BinaryEncoder(_EncoderEstimator):
    """the ordinal code as base-2 digit columns ``prefix_0`` (highest) onwards; unseen -> all zero."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid="keep"):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        levels = self._levels(dataset)
        top = levels.agg(F.max("code")).first()[0] or 1
        model = self._copyValues(BinaryEncoderModel().with_tables(levels=levels))
        return model._set(digits=top.bit_length())


class BinaryEncoderModel(TableModel, _Encoder):
    digits = Param(Params._dummy(), "digits", "number of digit columns", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._defaults(digits=1)

    def _transform(self, dataset):
        out, code = join_state(dataset, self.tables["levels"], [self.getInputCol()], "code")
        known, n = self._or_invalid(code, 0, "int"), self.getOrDefault("digits")
        bits = {f"{self.getOutputCol()}_{i}": F.shiftright(known, n - 1 - i).bitwiseAND(1) for i in range(n)}
        return out.withColumns(bits).drop("_state_code")


class OneHotColumns(_EncoderEstimator):
    """one 0/1 column ``prefix_1..prefix_n`` per level; unseen -> all zero.

    The column set is part of the plan, so the number of levels is held to Spark's own limit for pivots.
    ``orderCol`` numbers the levels by their first appearance in that column instead of by value.
    """

    orderCol = Param(Params._dummy(), "orderCol", "column giving the order of appearance", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid="keep", orderCol=None):
        super().__init__()
        self._defaults()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset):
        col = self.getInputCol()
        limit = int(dataset.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        seen = dataset.where(F.col(col).isNotNull())
        if self.isSet("orderCol"):
            found = seen.groupBy(col).agg(F.min(self.getOrDefault("orderCol")).alias("_o"))
        else:
            found = seen.select(col, F.col(col).alias("_o")).distinct()
        rows = found.limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{col} has more than {limit} levels: use the ordinal or target encoder")
        ordered = [(r[0], i + 1) for i, r in enumerate(sorted(rows, key=lambda r: r[1]))]
        schema = T.StructType([*dataset.select(col).schema.fields, T.StructField("code", T.IntegerType())])
        levels = dataset.sparkSession.createDataFrame(ordered, schema)
        return self._copyValues(OneHotColumnsModel().with_tables(levels=levels))


class OneHotColumnsModel(TableModel, _Encoder):
    orderCol = OneHotColumns.orderCol

    def __init__(self):
        super().__init__()
        self._defaults()
        self._levels = None

    def levels(self) -> list:
        """The levels in column order; at most as many as a pivot may have columns."""
        if self._levels is None:
            self._levels = [r[0] for r in self.tables["levels"].orderBy("code").collect()]
        return self._levels

    def output_names(self) -> list[str]:
        return [f"{self.getOutputCol()}_{i + 1}" for i in range(len(self.levels()))]

    def _transform(self, dataset):
        col = F.col(self.getInputCol())
        if self.getOrDefault("handleInvalid") == "error":
            known = F.when(col.isin(self.levels()), col).otherwise(
                self._unseen(dataset.schema[self.getInputCol()].dataType.simpleString()))
        else:
            known = col
        hot = {n: F.when(known == F.lit(v), 1).otherwise(0) for n, v in zip(self.output_names(), self.levels())}
        return dataset.withColumns(hot)


class SmoothedTargetEncoder(_EncoderEstimator):
    """``w·mean(level) + (1-w)·prior`` with ``w = 1/(1+exp(-(n-k)/f))``; unseen -> prior.

    Two map-side combined aggregates; a level holding any share of the rows costs no more than a rare one.
    """

    k = Param(Params._dummy(), "k", "rows at which level mean and prior weigh the same", TypeConverters.toFloat)
    f = Param(Params._dummy(), "f", "smoothing slope", TypeConverters.toFloat)
    needs_target = True

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol="label", k=20.0, f=10.0, handleInvalid="keep"):
        super().__init__()
        self._defaults(k=20.0, f=10.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        col, label = self.getInputCol(), self.getLabelCol()
        if label not in dataset.columns:
            raise ValueError(f"the target encoder of {col} needs the single target column {label!r}")
        y = F.col(label).cast("double")
        # Level sums and the overall sum in one pass; the row of the overall sum is told apart by its grouping id.
        stats = pin_state(
            dataset.where(y.isNotNull()).rollup(col).agg(
                F.sum(y).alias("s"), F.count(F.lit(1)).alias("n"), F.grouping_id().alias("overall")
            )
        )
        total = stats.where("overall = 1").first()
        if total is None or not total["n"]:
            raise ValueError(f"the target encoder of {col} needs at least one row with a {label!r}")
        prior = total["s"] / total["n"]
        w = 1 / (1 + F.exp(-(F.col("n") - self.getOrDefault("k")) / self.getOrDefault("f")))
        levels = stats.where((F.col("overall") == 0) & F.col(col).isNotNull()).select(
            col, (w * F.col("s") / F.col("n") + (1 - w) * F.lit(prior)).alias("value")
        )
        model = SmoothedTargetEncoderModel().with_tables(levels=levels)
        return self._copyValues(model)._set(prior=prior)


class SmoothedTargetEncoderModel(TableModel, _Encoder):
    k = SmoothedTargetEncoder.k
    f = SmoothedTargetEncoder.f
    prior = Param(Params._dummy(), "prior", "mean target of the training rows", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._defaults(k=20.0, f=10.0)

    def _transform(self, dataset):
        out, value = join_state(dataset, self.tables["levels"], [self.getInputCol()], "value")
        encoded = self._or_invalid(value, self.getOrDefault("prior"), "double")
        return out.withColumn(self.getOutputCol(), encoded).drop("_state_value")


def random_intercepts(
    n: np.ndarray, levels: np.ndarray, means: np.ndarray, squares: np.ndarray, within: float, iterations: int = 2000,
    tolerance: float = 1e-10,
) -> tuple[float, float, float]:
    """Mean, variance between levels and variance inside them of ``y = mean + level + error``, by expectation maximisation.

    Levels with equally many rows share all that the steps need, so the input is one entry for each number of rows ``n``: how
    many ``levels`` have it, the sum of their ``means`` and of its ``squares``; ``within`` is the sum of squared deviations from
    the levels' means.
    """
    rows, count = float((n * levels).sum()), float(levels.sum())
    mean = float((n * means).sum() / rows)
    between = max(float((squares - 2 * mean * means + mean * mean * levels).sum() / count), 1e-12)
    error = max(within / rows, 1e-12)
    for _ in range(iterations):
        share = n * between / (n * between + error)
        off = squares - 2 * mean * means + mean * mean * levels
        spread = between * error / (n * between + error)
        new_between = float((share ** 2 * off + levels * spread).sum() / count)
        new_error = float((within + (n * ((1 - share) ** 2 * off + levels * spread)).sum()) / rows)
        new_mean = float((n * (means - share * (means - levels * mean))).sum() / rows)
        moved = max(abs(new_between - between) / max(between, 1e-12), abs(new_error - error) / max(error, 1e-12),
                    abs(new_mean - mean) / max(abs(mean), 1.0))
        mean, between, error = new_mean, max(new_between, 0.0), max(new_error, 1e-300)
        if moved < tolerance:
            break
    return mean, between, error


class MixedModelEncoder(_EncoderEstimator):
    """The level's random intercept in a linear mixed model of the target: its mean's deviation, shrunk by how much of the spread
    of level means is error. Unseen and null levels have none: 0.

    Rows are read once, into counts and sums of the levels; levels of equally many rows are added up before they reach the
    driver, so that it sees one row for each size that occurs.
    """

    needs_target = True

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, labelCol="label", handleInvalid="keep"):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        col, label = self.getInputCol(), self.getLabelCol()
        if label not in dataset.columns:
            raise ValueError(f"the mixed model of {col} needs the single target column {label!r}")
        y = F.col(label).cast("double")
        stats = pin_state(dataset.where(y.isNotNull() & F.col(col).isNotNull()).groupBy(col).agg(
            F.count(F.lit(1)).alias("n"), F.avg(y).alias("m"), F.var_pop(y).alias("v")))
        sizes = stats.groupBy("n").agg(
            F.count(F.lit(1)).alias("levels"), F.sum("m").alias("means"), F.sum(F.col("m") * F.col("m")).alias("squares"),
            F.sum(F.col("n") * F.col("v")).alias("within")).orderBy("n").collect()
        if not sizes:
            raise ValueError(f"the mixed model of {col} needs at least one row with a {label!r}")
        n, levels, means, squares, within = (np.array(c, dtype=float) for c in zip(*sizes))
        # Deviations from the first mean, so that squares do not swamp them.
        origin = float(means.sum() / levels.sum())
        mean, between, error = random_intercepts(
            n, levels, means - origin * levels, squares - 2 * origin * means + origin * origin * levels, float(within.sum()))
        share = F.col("n") * F.lit(between) / (F.col("n") * F.lit(between) + F.lit(error))
        values = stats.select(col, (share * (F.col("m") - F.lit(origin) - F.lit(mean))).alias("value"))
        model = MixedModelEncoderModel().with_tables(levels=values)
        return self._copyValues(model)._set(mean=mean + origin, between=between, error=error)


class MixedModelEncoderModel(TableModel, _Encoder):
    mean = Param(Params._dummy(), "mean", "the model's mean", TypeConverters.toFloat)
    between = Param(Params._dummy(), "between", "variance of the levels' intercepts", TypeConverters.toFloat)
    error = Param(Params._dummy(), "error", "variance of the rows around them", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._defaults()

    def _transform(self, dataset):
        out, value = join_state(dataset, self.tables["levels"], [self.getInputCol()], "value")
        return out.withColumn(self.getOutputCol(), self._or_invalid(value, 0.0, "double")).drop("_state_value")


ENCODERS = {
    "glmm": MixedModelEncoder,
    "ordinal": OrdinalEncoder, "onehot": OneHotColumns, "binary": BinaryEncoder, "target": SmoothedTargetEncoder,
}


def make_encoder(kind: str | None, inputCol: str, outputCol: str, labelCol: str | None = None) -> list[Estimator]:
    """The encoder stage of a kind, as a list that is empty for ``None``.

    An encoder that needs the target says so up front (F6): without a single target column it is an error, not a
    silent refit without one. The others never see a target (F7).
    """
    if kind is None:
        return []
    if kind not in ENCODERS:
        raise ValueError(f"unknown encoder {kind!r}, expected one of {sorted(ENCODERS)}")
    cls = ENCODERS[kind]
    if not cls.needs_target:
        return [cls(inputCol=inputCol, outputCol=outputCol)]
    if labelCol is None:
        raise ValueError(f"the {kind} encoder needs a single target column")
    return [cls(inputCol=inputCol, outputCol=outputCol, labelCol=labelCol)]


def factor_encoders(kinds: dict[str, str | None], labelCol: str | None = None, prefix: str = "f_") -> list[Estimator]:
    """one encoder per factor column, each writing columns that start with ``prefix``."""
    return [e for col, kind in kinds.items() for e in make_encoder(kind, col, f"{prefix}{col}", labelCol)]
