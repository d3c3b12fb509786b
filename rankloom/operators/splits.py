"""Splits and folds that keep a factor group together. A split is a column, so one cached frame serves every fold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.keys import fold_hash
from rankloom.operators.relational import distinct_groups
from rankloom.operators.skew import hash_positions
from rankloom.session import durable


def group_split_keys(
    df: DataFrame, factors: Sequence[str], strata: Sequence[str] = ("dataset",), frac: float = 0.75, seed: int = 0
) -> DataFrame:
    """V1: every factor group with ``is_train``: in each stratum the ``round(frac·n)`` groups of smallest hash."""
    factors, strata = list(factors), list(strata)
    groups = distinct_groups(df, factors)
    placed = hash_positions(groups, strata, factors, seed, "_pos")
    if strata:
        sizes = groups.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
        placed = placed.join(sizes, strata)
    else:
        placed = placed.withColumn("_n", F.lit(groups.count()))
    return placed.select(*factors, (F.col("_pos") <= F.round(F.col("_n") * F.lit(frac))).alias("is_train"))


def group_split(
    df: DataFrame, factors: Sequence[str], strata: Sequence[str] = ("dataset",), frac: float = 0.75, seed: int = 0
) -> DataFrame:
    """V1: the rows with ``is_train``; all items of a group fall on one side."""
    return df.join(group_split_keys(df, factors, strata, frac, seed), list(factors))


def row_split(df: DataFrame, row_id: str, frac: float = 0.8, seed: int = 42) -> DataFrame:
    """V2: split single rows by a seeded hash of their key; a projection, without any exchange."""
    return df.withColumn("is_train", fold_hash(seed, [row_id]) % 1000 < int(round(frac * 1000)))


def group_kfold_keys(df: DataFrame, factors: Sequence[str], k: int, seed: int | None = 0) -> DataFrame:
    """V3: every factor group with ``fold`` in 0..k-1.

    With a seed the groups are dealt in hash order; with ``seed=None`` they are cut into k runs of the sorted groups.
    """
    factors = list(factors)
    groups = distinct_groups(df, factors)
    if seed is not None:
        placed = hash_positions(groups, [], factors, seed, "_pos")
        return placed.select(*factors, ((F.col("_pos") - 1) % k).cast("int").alias("fold"))
    n = groups.count()
    size, larger = divmod(n, k)
    at = F.col("_at")
    fold = F.when(at < larger * (size + 1), F.floor(at / (size + 1))).otherwise(
        larger + F.floor((at - larger * (size + 1)) / max(size, 1))
    )
    return _sorted_offsets(groups.withColumn("_w", F.lit(1)), factors).select(*factors, fold.cast("int").alias("fold"))


def _sorted_offsets(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows ahead of each distinct row in sorted order: those of the ranges before it, and those before it in its range. No
    task sorts more than a range, however the values are spread over the columns."""
    # Pinned: a range exchange that runs anew may cut elsewhere, and both branches below must see the same ranges.
    placed = durable(df.repartitionByRange(*cols).withColumn("_cut", F.spark_partition_id()))
    running = Window.partitionBy("_cut").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    # One row for each range: as many as there are partitions.
    before = Window.orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    ahead = placed.groupBy("_cut").agg(F.sum("_w").alias("_in")).select(
        "_cut", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_ahead"))
    local = placed.withColumn("_local", F.sum("_w").over(running) - F.col("_w"))
    return local.join(ahead, "_cut").withColumn("_at", F.col("_local") + F.col("_ahead")).drop("_local", "_ahead", "_cut")


def group_kfold(df: DataFrame, factors: Sequence[str], k: int, seed: int | None = 0) -> DataFrame:
    """V3: the rows with ``fold``; a group never spans two folds."""
    return df.join(group_kfold_keys(df, factors, k, seed), list(factors))
