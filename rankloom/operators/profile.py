"""Counts, coverage, missing values, histograms and score reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.functions.numbers import fixed_text, safe_ratio
from rankloom.operators.reshape import to_matrix
from rankloom.operators.skew import not_null_keys, value_positions


def group_mean(df: DataFrame, factors: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """A1: mean per group; groups with a missing factor are left out."""
    return not_null_keys(df, factors).groupBy(*factors).agg(F.avg(value).alias(out or value))


def value_counts(df: DataFrame, value: str, groups: Sequence[str] = (), ordered: bool = False) -> DataFrame:
    """A2/A3: rows per value, optionally per group; ``ordered`` puts the most frequent first."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(*groups, F.desc("count"), value) if ordered else counts


def distinct_report(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """A4: distinct values per column, one row per column. ``approximate`` uses a sketch of constant size."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    wide = df.agg(*[count(F.col(c)).alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "distinct_values")


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: the distinct values themselves, long and as text, so that no list has to fit in one cell."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
    return long.where(F.col("value").isNotNull()).distinct()


def coverage(df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """A5: observed factor combinations against the product of the distinct values of each factor.

    The rows are first reduced to the distinct combinations, so the distinct counts run on that small table.
    """
    groups = not_null_keys(df.select(*factors), factors).distinct()
    counted = groups.agg(
        F.count(F.lit(1)).alias("observed"), *[F.count_distinct(F.col(f)).alias(f"_{f}") for f in factors]
    )
    possible = prod([F.col(f"_{f}") for f in factors], start=F.lit(1).cast("bigint"))
    return counted.select("observed", possible.alias("possible")).withColumn(
        "ratio", safe_ratio(F.col("observed"), F.col("possible"))
    )


def _is_null(c: str) -> Column:
    return F.when(F.col(c).isNull(), 1).otherwise(0)


def null_ratio_by_column(df: DataFrame, columns: Sequence[str] | None = None, threshold: float | None = None
                         ) -> DataFrame:
    """Null ratio of every column in one pass, one row per column; with a threshold only ratios at or above it."""
    columns = df.columns if columns is None else list(columns)
    n = F.count(F.lit(1))
    wide = df.agg(*[safe_ratio(n - F.count(F.col(c)), n).alias(c) for c in columns])
    long = wide.unpivot([], columns, "column", "null_ratio")
    return long if threshold is None else long.where(F.col("null_ratio") >= threshold)


def null_ratio_by_row(df: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Null ratio of every row or entity."""
    nulls = sum([_is_null(c) for c in columns], start=F.lit(0))
    return df.select(*key, nulls.alias("nulls"), safe_ratio(nulls, F.lit(len(columns))).alias("null_ratio"))


def null_ratio_overall(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing cells of the whole table."""
    n = F.count(F.lit(1)) * len(columns)
    filled = sum([F.count(F.col(c)) for c in columns], start=F.lit(0).cast("bigint"))
    return df.agg((n - filled).alias("nulls"), n.alias("cells")).withColumn(
        "null_ratio", safe_ratio(F.col("nulls"), F.col("cells"))
    )


def null_ratio_by_level(df: DataFrame, levels: Sequence[str], value: str) -> DataFrame:
    """Missing values per level of each listed factor, all factors in one pass with grouping sets. A row without a
    level of one factor still counts for the others."""
    base = df.select(*[F.col(c).cast("string").alias(c) for c in levels], value)
    grouped = base.groupingSets([[F.col(c)] for c in levels], *[F.col(c) for c in levels]).agg(
        F.count(F.lit(1)).alias("cells"), (F.count(F.lit(1)) - F.count(value)).alias("nulls"),
        F.coalesce(*[F.when(F.grouping(c) == 0, F.lit(c)) for c in levels]).alias("_factor"),
    )
    factor = F.col("_factor")
    return grouped.where(F.coalesce(*levels).isNotNull()).select(
        factor.alias("factor"), F.coalesce(*levels).alias("level"), "cells", "nulls",
        safe_ratio(F.col("nulls"), F.col("cells")).alias("null_ratio"),
    )


def null_ratio_by_item_level(df: DataFrame, item: str, level: str, value: str, threshold: float = 0.0) -> DataFrame:
    """A10: missing values per item and level, from the threshold upwards."""
    counted = df.groupBy(item, level).agg(
        F.count(F.lit(1)).alias("cells"), (F.count(F.lit(1)) - F.count(value)).alias("nulls")
    )
    return counted.withColumn("null_ratio", safe_ratio(F.col("nulls"), F.col("cells"))).where(
        F.col("null_ratio") >= threshold
    )


def null_ratio_matrix(df: DataFrame, item: str, level: str, value: str, labels: Sequence, threshold: float = 0.0,
                      digits: int = 4) -> DataFrame:
    """A10/R5 as an item x level matrix with blanks below the threshold."""
    found = null_ratio_by_item_level(df, item, level, value, threshold)
    shown = found.withColumn("null_ratio", fixed_text(F.col("null_ratio"), digits))
    return to_matrix(shown, item, level, "null_ratio", labels)


def columns_sharing_ratio(ratios: DataFrame) -> DataFrame:
    """How many columns share each null ratio."""
    return ratios.groupBy("null_ratio").agg(F.count(F.lit(1)).alias("columns"))


def mean_and_spread(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Mean and population standard deviation."""
    return df.groupBy(*groups).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def score_report(df: DataFrame, approach: str, values: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Mean of each value per approach, with the position of the approach in a fixed order."""
    means = df.groupBy(approach).agg(*[F.avg(v).alias(v) for v in values])
    if order is None:
        return means
    position = F.array_position(F.array(*[F.lit(o) for o in order]), F.col(approach)).cast("int")
    return means.where(position > 0).withColumn("position", position)


def best_by(df: DataFrame, score: str, groups: Sequence[str] = (), tie: Sequence[str] = ()) -> DataFrame:
    """The row with the largest score, per group if given; among equals the smallest ``tie`` columns.

    ``min_by`` keeps one row per task and group: one pass, no sort and no join.
    """
    rest = [c for c in df.columns if c not in set(groups)]
    order = F.struct((-F.col(score)).alias("_minus"), *[F.col(c) for c in tie])
    winner = df.where(F.col(score).isNotNull()).groupBy(*groups).agg(F.min_by(F.struct(*rest), order).alias("_w"))
    return winner.select(*groups, *[F.col("_w").getField(c).alias(c) for c in rest])


def summary_statistics(df: DataFrame, value: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample standard deviation, extremes and exact linear-interpolated quantiles, one per row."""
    moments = df.agg(
        F.count(value).cast("double").alias("count"), F.avg(value).alias("mean"), F.stddev(value).alias("std"),
        F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"),
    ).unpivot([], ["count", "mean", "std", "min", "max"], "statistic", "value")
    return moments.unionByName(exact_quantiles(df, value, probabilities))


def exact_quantiles(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles of a column of any size: positions of the distinct values, then a filter on the positions."""
    places = value_positions(df, [], value)
    wanted = F.explode(F.array(*[
        F.struct(F.lit(f"{p:.0%}").alias("statistic"), F.lit(float(p)).alias("p")) for p in probabilities]))
    n = df.agg(F.count(value)).first()[0]
    at = places.select(F.col(value).cast("double").alias("_v"), "before", "n", wanted.alias("_q")).select(
        "_v", "before", "n", "_q.statistic", (F.col("_q.p") * (n - 1)).alias("at")
    )
    low, high = F.floor("at"), F.ceil("at")

    def holds(pos: Column) -> Column:
        return (F.col("before") <= pos) & (pos < F.col("before") + F.col("n"))

    ends = at.where(holds(low) | holds(high)).groupBy("statistic", "at").agg(
        F.max(F.when(holds(low), F.col("_v"))).alias("lo"), F.max(F.when(holds(high), F.col("_v"))).alias("hi")
    )
    return ends.select("statistic", (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("at") - low)).alias("value"))


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Fixed-width histogram over the observed range, empty bins included; the last bin holds the maximum."""
    lo, hi = df.agg(F.min(value).cast("double"), F.max(value).cast("double")).first()
    if lo is None:
        raise ValueError(f"no values in {value!r}")
    width = (hi - lo) / bins
    if width > 0:
        place = F.least(F.floor((F.col(value) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    else:
        place = F.lit(0)
    counted = df.where(F.col(value).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("from"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )


def compare_configurations(df: DataFrame, configuration: Sequence[str], score: str, where: Mapping | None = None
                           ) -> DataFrame:
    """Mean score of each configuration over its folds, best first, optionally on a slice."""
    from rankloom.operators.relational import where_given

    sliced = where_given(df, **(where or {}))
    means = sliced.groupBy(*configuration).agg(F.avg(score).alias("mean_score"), F.count(score).alias("folds"))
    return means.orderBy(F.desc("mean_score"), *configuration)
