"""Order statistics inside groups of any size.

A window partitioned by the grouping key sorts each group in one task. That is the best plan while groups are small,
and it breaks when one group holds a large share of the table. The operators here first size the groups with one
aggregate over the key columns only; when no group is too large they keep the plain window, otherwise they

1. reduce each group to its distinct values with counts (combined map-side, so repeated values cost nothing),
2. deal these by a range exchange on (group, value), so that a group spreads over as many tasks as it needs,
3. number the values inside each range and add the totals of the ranges before it.

A row with a missing group key belongs to no group, whichever plan runs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.keys import md5_order
from rankloom.session import durable, pin_state

HOT_ROWS_CONF = "rankloom.hotGroupRows"
HOT_ROWS_DEFAULT = 2_000_000
# Hash order is cut by its first hex digits: a million cuts, so that neither the rows of a cut nor the cuts of a group are
# more than one task sorts, up to 10^12 rows in a group.
PREFIX_DIGITS = 5


def hot_limit(df: DataFrame) -> int:
    """Rows of one group that a single task may sort."""
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame:
    """Keys of the groups above the limit with their row count ``n``, evaluated once."""
    limit = hot_limit(df) if limit is None else limit
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return pin_state(sizes.where(F.col("n") > limit))


def has_hot_group(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> bool:
    """One aggregate over the key columns; without keys the table is the group."""
    limit = hot_limit(df) if limit is None else limit
    if limit <= 0:  # every group counts as hot
        return True
    if not keys:
        return df.count() > limit
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).isEmpty()


def value_positions(
    df: DataFrame, keys: Sequence[str], value: str, ascending: bool = True, limit: int | None = None
) -> DataFrame:
    """Distinct non-null values per group with ``n`` (rows), ``before`` (rows ahead) and ``distinct_before``.

    Every tie-aware rank follows from these three numbers, and the table is never larger than the distinct values.
    ``keys`` may be empty: the whole table is then one group. Rows with a missing key are left out.
    """
    keys = list(keys)
    vals = not_null_keys(df, keys).where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    if has_hot_group(vals, keys, limit):
        return _range_positions(vals, keys, value, ascending)
    w = Window.partitionBy(*keys).orderBy(F.col(value).asc() if ascending else F.col(value).desc())
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return vals.select(
        *keys, value, "n",
        (F.sum("n").over(running) - F.col("n")).alias("before"),
        (F.row_number().over(w) - 1).cast("bigint").alias("distinct_before"),
    )


def _range_positions(vals: DataFrame, keys: list[str], value: str, ascending: bool) -> DataFrame:
    order = F.col(value).asc() if ascending else F.col(value).desc()
    # Pinned: a range exchange that runs anew may cut elsewhere, and both branches below must see the same ranges.
    placed = durable(vals.repartitionByRange(*keys, order).withColumn("_cut", F.spark_partition_id()))
    in_cut = Window.partitionBy(*keys, "_cut").orderBy(order)
    running = in_cut.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select(
        *keys, value, "n", "_cut",
        (F.sum("n").over(running) - F.col("n")).alias("_before"),
        (F.row_number().over(in_cut) - 1).alias("_distinct"),
    )
    # One row per group and range: the window below sees no more rows of a group than there are partitions.
    before = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        placed.groupBy(*keys, "_cut").agg(F.sum("n").alias("_rows"), F.count(F.lit(1)).alias("_vals"))
        .select(
            *keys, "_cut",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_ahead"),
            F.coalesce(F.sum("_vals").over(before), F.lit(0)).alias("_vals_ahead"),
        )
    )
    return local.join(totals, [*keys, "_cut"]).select(
        *keys, value, "n",
        (F.col("_before") + F.col("_rows_ahead")).alias("before"),
        (F.col("_distinct") + F.col("_vals_ahead")).cast("bigint").alias("distinct_before"),
    )


def hash_positions(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], seed: int, name: str) -> DataFrame:
    """1-based position of each row inside its group in the seeded hash order of ``order_cols``.

    Rows with a missing key form a group of their own. The hash is uniform, so cutting it by its leading hex digits spreads
    a group evenly whatever its size, and no sizing pass is needed: position = position inside the cut + rows of the cuts ahead.
    """
    keys = list(keys)
    base = df.withColumn("_h", md5_order(seed, order_cols)).withColumn("_cut", F.substring("_h", 1, PREFIX_DIGITS))
    in_cut = Window.partitionBy(*keys, "_cut").orderBy("_h", *order_cols)
    before = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    # At most 16**PREFIX_DIGITS rows per group reach this window, also when there are no keys.
    ahead = base.groupBy(*keys, "_cut").agg(F.count(F.lit(1)).alias("_rows")).select(
        *keys, "_cut", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_ahead")
    )
    local = base.withColumn("_local", F.row_number().over(in_cut))
    # A missing key is a key here: every row gets a position.
    ahead = ahead.withColumnsRenamed({k: f"_k_{k}" for k in [*keys, "_cut"]})
    same = reduce(and_, [local[k].eqNullSafe(ahead[f"_k_{k}"]) for k in [*keys, "_cut"]])
    placed = local.join(ahead, same).drop(*[f"_k_{k}" for k in [*keys, "_cut"]])
    return placed.withColumn(name, (F.col("_local") + F.col("_ahead")).cast("bigint")).drop(
        "_h", "_cut", "_local", "_ahead"
    )


def salted(left: DataFrame, right: DataFrame, keys: Sequence[str], spread_by: str) -> tuple[DataFrame, DataFrame, str]:
    """Add a salt column so that an equi-join on ``keys`` + salt spreads the large groups of ``left``.

    A group of n rows makes n * n pairs, so that is what is held against the limit. Rows of an ordinary group keep salt 0.
    A large group's left rows are dealt over ``ceil(n * n / limit)`` salts, n at most, and its right rows are repeated once
    per salt, so every pair still meets exactly once.
    """
    limit = hot_limit(left)
    hot = hot_groups(left, keys, math.isqrt(limit))
    if hot.isEmpty():
        return left.withColumn("_salt", F.lit(0)), right.withColumn("_salt", F.lit(0)), "_salt"
    ways = hot.select(*keys, F.least(F.col("n"), F.ceil(F.col("n") * F.col("n") / F.lit(limit))).cast("int").alias("_ways"))
    n_ways = F.coalesce(F.col("_ways"), F.lit(1))
    spread = left.join(ways, list(keys), "left").withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), n_ways).cast("int")
    ).drop("_ways")
    repeated = right.join(ways, list(keys), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), n_ways - 1))
    ).drop("_ways")
    return spread, repeated, "_salt"


def not_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping columns are all present; a null key belongs to no group."""
    cond: Column | None = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df if cond is None else df.where(cond)
