"""Invertible target transforms. The fitted state is a table keyed by group, never a dictionary on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.operators.encoders import OneHotColumns
from rankloom.operators.reshape import distinct_items, melt_target, pivot_target
from rankloom.session import pin_state


class MinMax:
    """To [0, 1]; a constant group maps to 0 and back to its value."""

    state = {"_lo": F.min, "_hi": F.max}

    @staticmethod
    def _span() -> Column:
        return F.when(F.col("_hi") == F.col("_lo"), F.lit(1.0)).otherwise(F.col("_hi") - F.col("_lo"))

    @classmethod
    def forward(cls, y: Column) -> Column:
        return (y - F.col("_lo")) / cls._span()

    @classmethod
    def backward(cls, y: Column) -> Column:
        return y * cls._span() + F.col("_lo")


class Standard:
    """Zero mean and unit population deviation; a constant group maps to 0 and back."""

    state = {"_mean": F.avg, "_std": F.stddev_pop}

    @staticmethod
    def _scale() -> Column:
        return F.when(F.col("_std") > 0, F.col("_std")).otherwise(F.lit(1.0))

    @classmethod
    def forward(cls, y: Column) -> Column:
        return (y - F.col("_mean")) / cls._scale()

    @classmethod
    def backward(cls, y: Column) -> Column:
        return y * cls._scale() + F.col("_mean")


SCALERS = {"minmax": MinMax, "standard": Standard}


class GroupwiseTarget:
    """A scaler fitted per group of ``group_by`` columns (none: one global state) and invertible."""

    def __init__(self, target: str, group_by: Sequence[str] = (), scaler: str = "minmax"):
        if scaler not in SCALERS:
            raise ValueError(f"unknown scaler {scaler!r}")
        self.target, self.group_by, self.scaler = target, list(group_by), SCALERS[scaler]

    def fit(self, df: DataFrame) -> GroupwiseTargetModel:
        y = F.col(self.target).cast("double")
        state = df.groupBy(*self.group_by).agg(*[agg(y).alias(n) for n, agg in self.scaler.state.items()])
        return GroupwiseTargetModel(self, pin_state(state))


class GroupwiseTargetModel:
    def __init__(self, spec: GroupwiseTarget, state: DataFrame):
        self.spec, self.state = spec, state

    def _with_state(self, df: DataFrame) -> DataFrame:
        if self.spec.group_by:
            return df.join(self.state, self.spec.group_by, "left")
        one = self.state.first()  # the global state is one row
        return df.withColumns({n: F.lit(one[n]) for n in self.spec.scaler.state})

    def _apply(self, df: DataFrame, column: str, out: str, function) -> DataFrame:
        keep = [c for c in df.columns if c != out]
        joined = self._with_state(df)
        return joined.select(*[F.col(c) for c in keep], function(F.col(column).cast("double")).alias(out))

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        return self._apply(df, self.spec.target, out or self.spec.target, self.spec.scaler.forward)

    def inverse(self, df: DataFrame, column: str | None = None, out: str | None = None) -> DataFrame:
        column = column or self.spec.target
        return self._apply(df, column, out or column, self.spec.scaler.backward)


class GroupMinMax(GroupwiseTarget):
    """T2."""

    def __init__(self, target: str, factors: Sequence[str]):
        super().__init__(target, factors, "minmax")


class RankBinarizer:
    """Rank r in 0..M becomes M columns ``r > i``; the inverse is their sum.

    M is the largest rank seen, or ``top`` where the column set has to be fixed beforehand (items - 1).
    """

    def __init__(self, target: str, top: int | None = None):
        self.target, self.top = target, top

    def fit(self, df: DataFrame) -> RankBinarizerModel:
        y = F.col(self.target)
        bad = F.sum(F.when((y < 0) | (y != F.floor(y)), 1).otherwise(0))
        top, wrong = df.agg(F.max(y).cast("int"), bad).first()
        if wrong:
            raise ValueError(f"{self.target}: {wrong} values are not non-negative integers")
        if self.top is not None and (top or 0) > self.top:
            raise ValueError(f"{self.target}: rank {top} is above the stated largest rank {self.top}")
        return RankBinarizerModel(self.target, (top or 0) if self.top is None else self.top)


class RankBinarizerModel:
    def __init__(self, target: str, top: int):
        self.target, self.top = target, top

    def output_names(self) -> list[str]:
        return [self.target] if self.top == 1 else [f"{self.target}_{i}" for i in range(self.top)]

    def transform(self, df: DataFrame) -> DataFrame:
        y = F.col(self.target)
        steps = [F.when(y.isNotNull(), (y > i).cast("int")).alias(n) for i, n in enumerate(self.output_names())]
        return df.select(*[c for c in df.columns if c != self.target], *steps)

    def inverse(self, df: DataFrame, columns: Sequence[str] | None = None, out: str | None = None) -> DataFrame:
        columns = list(columns or self.output_names())
        total = sum([F.col(c) for c in columns[1:]], start=F.col(columns[0])) if columns else F.lit(0)
        return df.select(*[c for c in df.columns if c not in set(columns)], total.alias(out or self.target))

    def steps(self) -> Column:
        """The binary targets as an array column, for the long layout (one row per threshold)."""
        if not self.top:  # one rank only: no threshold
            return F.expr("cast(array() as array<struct<step: int, above: int>>)")
        return F.transform(
            F.sequence(F.lit(0), F.lit(self.top - 1)),
            lambda i: F.struct(i.alias("step"), (F.col(self.target) > i).cast("int").alias("above")),
        )


class TargetOneHot:
    """T4: indicator columns of the target and back."""

    def __init__(self, target: str, order_col: str | None = None):
        self.target, self.order_col = target, order_col

    def fit(self, df: DataFrame) -> TargetOneHotModel:
        encoder = OneHotColumns(inputCol=self.target, outputCol=self.target, orderCol=self.order_col)
        return TargetOneHotModel(self.target, encoder.fit(df))


class TargetOneHotModel:
    def __init__(self, target: str, encoder):
        self.target, self.encoder = target, encoder

    def transform(self, df: DataFrame) -> DataFrame:
        return self.encoder.transform(df).drop(self.target)

    def inverse(self, df: DataFrame, out: str | None = None) -> DataFrame:
        names = self.encoder.output_names()
        value = F.coalesce(*[F.when(F.col(n) == 1, F.lit(v)) for n, v in zip(names, self.encoder.levels())])
        return df.select(*[c for c in df.columns if c not in set(names)], value.alias(out or self.target))


class TargetPivot:
    """T5: one row per group with a column per item, and back."""

    def __init__(self, factors: Sequence[str], item: str, target: str, fill: str | None = "global"):
        self.factors, self.item, self.target, self.fill = list(factors), item, target, fill

    def fit(self, df: DataFrame) -> TargetPivotModel:
        return TargetPivotModel(self, distinct_items(df, self.item))


class TargetPivotModel:
    def __init__(self, spec: TargetPivot, items: list):
        self.spec, self.items = spec, items

    def transform(self, df: DataFrame) -> DataFrame:
        s = self.spec
        return pivot_target(df, s.factors, s.item, s.target, self.items, s.fill)

    def inverse(self, df: DataFrame, out: str | None = None) -> DataFrame:
        s = self.spec
        return melt_target(df, s.factors, self.items, s.item, out or s.target)
