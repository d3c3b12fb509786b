"""Listwise layout: ordered item arrays, sampled lists, and the way back to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.keys import SEPARATOR
from rankloom.operators.pairs import one_row_per_item
from rankloom.operators.ranking import group_ranks
from rankloom.operators.reshape import explode_lists
from rankloom.operators.skew import hash_positions, not_null_keys


def ordered_items(df: DataFrame, factors: Sequence[str], item: str, target: str) -> DataFrame:
    """Each group's items by descending target (then item), as parallel arrays ``items`` and ``ranks``.

    The rows are reduced to one per (group, item) first, so an array is never longer than the item vocabulary. For a
    vocabulary too large for one cell use :func:`ordered_rows`.
    """
    rows = one_row_per_item(not_null_keys(df, factors), factors, item, target)
    entry = F.struct((-F.col(target)).alias("minus"), F.col(item).alias("i"), F.col(target).alias("t"))
    lists = rows.where(F.col(target).isNotNull()).groupBy(*factors).agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    return lists.select(
        *factors, F.transform("_l", lambda e: e["i"]).alias("items"), F.transform("_l", lambda e: e["t"]).alias("ranks")
    )


def ordered_rows(
    df: DataFrame, factors: Sequence[str], item: str, target: str, seed: int = 0, limit: int | None = None
) -> DataFrame:
    """W7 in long layout, for groups of any size: ``position`` by descending target, ties in seeded hash order. Rows without
    a target have no position and are left out, rows with a missing factor belong to no group."""
    rows = not_null_keys(df, factors).where(F.col(target).isNotNull())
    first = group_ranks(rows, factors, target, "_first", "min", False, limit=limit)
    return hash_positions(first, [*factors, target], [item], seed, "_tie").withColumn(
        "position", (F.col("_first") + F.col("_tie")).cast("bigint")
    ).drop("_first", "_tie")


def sample_lists(
    df: DataFrame, factors: Sequence[str], item: str, target: str, n: int, lists: int = 1, seed: int = 0
) -> DataFrame:
    """``lists`` samples of ``n`` rows without replacement per group, as ``items`` and ``ranks`` arrays.

    Sampling is by the n smallest seeded hashes, so it repeats exactly. Groups with fewer than n rows give no list.
    The limit on the row number is applied before the exchange: no task ever ships more than n rows of a list.
    """
    drawn = not_null_keys(df, factors).select(*factors, item, target, F.explode(F.sequence(F.lit(1), F.lit(lists))).alias("list_no"))
    text = [F.lit(str(seed)), F.col("list_no").cast("string"), *[F.col(c).cast("string") for c in [*factors, item]]]
    drawn = drawn.withColumn("_h", F.md5(F.concat_ws(SEPARATOR, *text)))
    w = Window.partitionBy(*factors, "list_no").orderBy("_h", item, target)
    kept = drawn.withColumn("_pos", F.row_number().over(w)).where(F.col("_pos") <= n)
    entry = F.struct("_pos", F.col(item).alias("i"), F.col(target).alias("t"))
    packed = kept.groupBy(*factors, "list_no").agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    return packed.where(F.size("_l") == n).select(
        *factors, "list_no",
        F.transform("_l", lambda e: e["i"]).alias("items"), F.transform("_l", lambda e: e["t"]).alias("ranks"),
    )


def restore_lists(
    original: DataFrame, lists: DataFrame, factors: Sequence[str], item: str,
    items: str = "items", predictions: str = "predictions", out: str = "rank_pred",
) -> DataFrame:
    """The list predictions as a column of the original rows; rows in no list get 0.

    An item that is in several lists of its group gets the mean of its predictions, so no row is repeated.
    """
    flat = explode_lists(lists.select(*factors, items, predictions), [items, predictions])
    flat = flat.select(
        *[F.col(f).cast(original.schema[f].dataType).alias(f) for f in factors],
        F.col(items).cast(original.schema[item].dataType).alias(item),
        F.col(predictions).cast("double").alias(out),
    ).groupBy(*factors, item).agg(F.avg(out).alias(out))
    return original.join(flat, [*factors, item], "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))
