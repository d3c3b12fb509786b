"""Item pairs inside a group, and the ranking that follows from pairwise wins."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.numbers import indicator
from rankloom.operators.ranking import group_ranks, window_rank
from rankloom.operators.reshape import distinct_items, pivot_target
from rankloom.operators.skew import not_null_keys, salted

PAIR_SEPARATOR = "__"


def one_row_per_item(df: DataFrame, factors: Sequence[str], item: str, target: str) -> DataFrame:
    """Reduce to one row per (group, item), map-side first; different targets for one item are an error.

    After this a group is never larger than the item vocabulary, whatever share of the raw rows it had.
    """
    clash = F.raise_error(F.lit(f"several targets for one ({', '.join(factors)}, {item})"))
    kind = df.schema[target].dataType
    lo, hi = F.min(target), F.max(target)
    return df.groupBy(*factors, item).agg(F.when(lo < hi, clash.cast(kind)).otherwise(hi).alias(target))


def pairwise_target(
    df: DataFrame,
    factors: Sequence[str],
    item: str,
    target: str,
    wide: bool = False,
    items: Sequence | None = None,
    fill: int | None = None,
) -> DataFrame:
    """Which item of a pair has the smaller target, strictly; ties give 0 in both directions.

    Long (J2): a row per group and unordered item pair ``item_a < item_b`` with ``a_better`` and ``b_better``; only
    pairs with both items present. Rows are first reduced to one per item, so a row meets fewer partners than there
    are items, and groups still too large for a task are salted.

    Wide (J3): a row per group and a column per ordered pair. No pair rows are built: the group is pivoted once and
    each pair column compares two cells of the same row. ``fill=0`` writes 0 where an item is missing (J4).
    """
    factors = list(factors)
    if wide:
        return _wide_pairs(df, factors, item, target, items, fill)
    rows = one_row_per_item(df, factors, item, target)
    left = rows.select(*factors, F.col(item).alias("item_a"), F.col(target).alias("_ta"))
    right = rows.select(*factors, F.col(item).alias("item_b"), F.col(target).alias("_tb"))
    left, right, salt = salted(left, right, factors, "item_a")
    pairs = left.join(right, [*factors, salt]).where(F.col("item_a") < F.col("item_b"))
    return pairs.select(
        *factors, "item_a", "item_b",
        indicator(F.col("_ta") < F.col("_tb")).alias("a_better"),
        indicator(F.col("_tb") < F.col("_ta")).alias("b_better"),
    )


def _wide_pairs(df, factors, item, target, items, fill) -> DataFrame:
    items = distinct_items(df, item) if items is None else sorted(items)
    wide = pivot_target(df, factors, item, target, items, fill=None)

    def cell(i) -> Column:
        return F.col(f"`{i}`")

    columns = []
    for a in items:
        for b in items:
            if a != b:
                both = cell(a).isNotNull() & cell(b).isNotNull()
                better = F.when(both, indicator(cell(a) < cell(b)))
                columns.append((better if fill is None else F.coalesce(better, F.lit(fill))).alias(pair_name(a, b)))
    return wide.select(*factors, *columns)


def pair_name(a, b) -> str:
    """``a__b``. Underscores of an item that could be taken for the separator, and the escape sign, are escaped."""
    return PAIR_SEPARATOR.join(re.sub("^_|_$|_(?=_)|(?<=_)_", "%5F", str(i).replace("%", "%25")) for i in (a, b))


def split_pair_name(name: str) -> list[Column]:
    """The two items of a wide pair column's name."""
    parts = F.split(F.col(name), PAIR_SEPARATOR)

    def item(k: int) -> Column:
        return F.replace(F.replace(parts.getItem(k), F.lit("%5F"), F.lit("_")), F.lit("%25"), F.lit("%"))

    return [item(0).alias("item_a"), item(1).alias("item_b")]


def wins(pairs: DataFrame, factors: Sequence[str], item: str = "encoder", a_better: str = "a_better",
         b_better: str = "b_better") -> DataFrame:
    """Wins of each item in each group."""
    sides = F.explode(
        F.array(
            F.struct(F.col("item_a").alias(item), F.col(a_better).alias("won")),
            F.struct(F.col("item_b").alias(item), F.col(b_better).alias("won")),
        )
    )
    return pairs.select(*factors, sides.alias("_s")).groupBy(*factors, F.col(f"_s.{item}").alias(item)).agg(
        F.sum("_s.won").alias("wins")
    )


def wins_without_pairs(df: DataFrame, factors: Sequence[str], item: str, target: str, bounded: bool = False
                       ) -> DataFrame:
    """A12 straight from an observed target: an item beats exactly the items with a larger target, so its wins are
    its descending min-rank. Linear in the rows; no pair is ever formed."""
    rows = not_null_keys(df, factors).where(F.col(target).isNotNull())
    ranked = group_ranks(rows, factors, target, "wins", "min", False, bounded)
    return ranked.select(*factors, item, F.col("wins").cast("bigint").alias("wins"))


def wins_to_ranking(
    pairs: DataFrame,
    factors: Sequence[str],
    item: str = "encoder",
    scope: str = "group",
    out: str = "rank_pred",
    a_better: str = "a_better",
    b_better: str = "b_better",
) -> DataFrame:
    """More wins, better rank; ranked inside the group or (``scope='global'``) over the whole table."""
    won = wins(pairs, factors, item, a_better, b_better)
    if scope == "group":  # one row per item in a group
        return won.select(*factors, item, window_rank(factors, "wins", "dense", False).alias(out))
    if scope != "global":
        raise ValueError(f"unknown scope {scope!r}")
    # Win counts run from 0 to the number of items, so the table of distinct counts is tiny.
    levels = won.select("wins").distinct().select(
        "wins", (F.row_number().over(Window.partitionBy().orderBy(F.desc("wins"))) - 1).alias(out)
    )
    return won.join(levels, "wins").select(*factors, item, out)
