"""Ranks inside factor groups and the agreement of two rankings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.keys import md5_order
from rankloom.functions.numbers import pearson_from_sums
from rankloom.operators.skew import has_hot_group, hash_positions, not_null_keys, value_positions

SALTS = 64  # parts of a group that a top-k is taken of first
RANK_KINDS = ("dense", "min", "average")


def _ordered(col: str, ascending: bool) -> Column:
    return F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()


def group_ranks(
    df: DataFrame,
    factors: Sequence[str],
    value: str,
    out: str,
    kind: str = "dense",
    ascending: bool = False,
    bounded: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Add the 0-based ``dense`` or ``min`` rank, or the 1-based ``average`` rank, of ``value`` in its group.

    NULL gets a NULL rank, and so does a row with a missing factor, which belongs to no group. Groups above ``limit`` rows
    (default: the configured one) are not sorted in one task. ``bounded=True`` states that the rows of a group
    are few by construction (for instance one
    row per item after an aggregate) and keeps the single-exchange window without sizing the groups first.
    """
    if kind not in RANK_KINDS:
        raise ValueError(f"unknown rank kind {kind!r}")
    factors = list(factors)
    if bounded or not has_hot_group(df, factors, limit):
        return df.withColumn(out, window_rank(factors, value, kind, ascending))
    table = value_positions(df, factors, value, ascending, limit).select(
        *factors, value,
        {
            "dense": F.col("distinct_before").cast("int"),
            "min": F.col("before"),
            "average": F.col("before") + (F.col("n") + 1) / 2,
        }[kind].alias(out),
    )
    return df.join(table, [*factors, value], "left").select(*df.columns, out)


def window_rank(factors: Sequence[str], value: str, kind: str, ascending: bool) -> Column:
    """The rank as one window column; all of them over the same factors share a single exchange."""
    w = Window.partitionBy(*factors).orderBy(_ordered(value, ascending))
    if kind == "dense":
        rank = F.dense_rank().over(w) - 1
    elif kind == "min":
        rank = F.rank().over(w) - 1
    else:
        ties = F.count(F.lit(1)).over(Window.partitionBy(*factors, value))
        rank = F.rank().over(w) + (ties - 1) / 2
    return F.when(reduce(and_, [F.col(c).isNotNull() for c in [*factors, value]]), rank)


def score_to_rank(
    df: DataFrame,
    factors: Sequence[str],
    score: str,
    ascending: bool = False,
    out: str = "rank",
    bounded: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """0-based dense rank; ``ascending=False`` puts the largest score first."""
    return group_ranks(df, factors, score, out, "dense", ascending, bounded, limit)


def rankings(
    df: DataFrame,
    factors: Sequence[str],
    item: str,
    score: str,
    wide: bool = False,
    items: Sequence | None = None,
    bounded: bool = False,
) -> DataFrame:
    """The descending ranking of every group, long, or as the item x group matrix turned group-per-row."""
    ranked = score_to_rank(df, factors, score, False, "rank", bounded).select(*factors, item, "rank")
    if not wide:
        return ranked
    from rankloom.operators.reshape import pivot_target

    return pivot_target(ranked, factors, item, "rank", items=items, fill=None)


def spearman_by_group(
    df: DataFrame, factors: Sequence[str], a: str, b: str, bounded: bool = False, limit: int | None = None
) -> DataFrame:
    """Tie-aware Spearman correlation of two columns per group.

    Rows where either side is NULL are left out, rows with a missing factor belong to no group.
    ``rho`` is NULL for a group with a constant side or no usable row.
    """
    factors = list(factors)
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    pairs = not_null_keys(df, factors).select(
        *factors,
        F.when(both, F.col(a).cast("double")).alias("_a"),
        F.when(both, F.col(b).cast("double")).alias("_b"),
    )
    if bounded or not has_hot_group(pairs, factors, limit):
        ranked = pairs.withColumns(
            {"_ra": window_rank(factors, "_a", "average", True), "_rb": window_rank(factors, "_b", "average", True)}
        )
    else:
        ranked = group_ranks(pairs, factors, "_a", "_ra", "average", True, limit=0)  # sized already
        ranked = group_ranks(ranked, factors, "_b", "_rb", "average", True, limit=0)
    x, y = F.col("_ra"), F.col("_rb")
    sums = ranked.groupBy(*factors).agg(
        F.count("_ra").alias("n"),
        F.sum(x).alias("_sx"), F.sum(y).alias("_sy"), F.sum(x * y).alias("_sxy"),
        F.sum(x * x).alias("_sxx"), F.sum(y * y).alias("_syy"),
    )
    rho = pearson_from_sums(*[F.col(c) for c in ("n", "_sx", "_sy", "_sxy", "_sxx", "_syy")])
    return sums.select(*factors, "n", rho.alias("rho"))


def average_spearman(df: DataFrame, factors: Sequence[str], a: str, b: str, bounded: bool = False) -> DataFrame:
    """Mean of the defined group correlations."""
    return spearman_by_group(df, factors, a, b, bounded).agg(
        F.avg("rho").alias("mean_rho"), F.count("rho").alias("groups_used"), F.count(F.lit(1)).alias("groups")
    )


def ndcg_by_group(
    df: DataFrame,
    factors: Sequence[str],
    item: str,
    relevance: str,
    score: str,
    k: int | None = None,
    seed: int = 0,
    bounded: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """NDCG of the order by descending ``score``; larger relevance is more relevant, ties by seeded item hash. Rows
    without relevance or score are left out, rows with a missing factor belong to no group."""
    factors = list(factors)
    known = F.col(relevance).isNotNull() & F.col(score).isNotNull()
    rows = not_null_keys(df, factors).where(known).select(*factors, item, relevance, score)
    if bounded or not has_hot_group(rows, factors, limit):
        tie = [md5_order(seed, [item]), F.col(item)]
        placed = rows.withColumns(
            {
                "_pos": F.row_number().over(Window.partitionBy(*factors).orderBy(F.desc(score), *tie)),
                "_ideal": F.row_number().over(Window.partitionBy(*factors).orderBy(F.desc(relevance), *tie)),
            }
        )
    else:
        placed = _positions(rows, factors, score, item, seed, "_pos")
        placed = _positions(placed, factors, relevance, item, seed, "_ideal")
    gain = F.pow(F.lit(2.0), F.col(relevance)) - 1

    def discounted(pos: str) -> Column:
        part = gain / F.log2(F.col(pos) + 1)
        return _exact_sum(part if k is None else F.when(F.col(pos) <= k, part).otherwise(0.0))

    dcg = placed.groupBy(*factors).agg(discounted("_pos").alias("_dcg"), discounted("_ideal").alias("_best"))
    return dcg.select(*factors, F.coalesce(F.try_divide("_dcg", "_best"), F.lit(0.0)).alias("ndcg"))


def _exact_sum(part: Column) -> Column:
    """A sum of doubles that does not depend on their order: of decimals of twelve places. Above 10**16 (relevances above 53) it
    is the sum of the doubles themselves."""
    decimal = part.try_cast("decimal(28,12)")
    beyond = F.count(F.when(decimal.isNull() & part.isNotNull(), 1))
    return F.when(beyond == 0, F.try_sum(decimal).cast("double")).otherwise(F.sum(part))


def _positions(df: DataFrame, factors: list[str], value: str, item: str, seed: int, out: str) -> DataFrame:
    """Row number by descending value, ties in hash order, for groups and tie runs of any size."""
    first = group_ranks(df, factors, value, "_first", "min", False, limit=0)  # sized already
    return hash_positions(first, [*factors, value], [item], seed, "_tie").withColumn(
        out, F.col("_first") + F.col("_tie")
    ).drop("_first", "_tie")


def top_k_items(df: DataFrame, factors: Sequence[str], item: str, score: str, k: int) -> DataFrame:
    """The k best items of each group; rows with a missing factor belong to none.

    A first stage keeps the k best of each of ``SALTS`` parts of a group, so that no task sorts a large group, whatever k
    is; the second picks among these.
    """
    order = [F.desc_nulls_last(score), F.col(item)]
    part = F.pmod(F.xxhash64(item, score), F.lit(SALTS))
    inner = Window.partitionBy(*factors, "_part").orderBy(*order)
    rows = not_null_keys(df, factors).withColumn("_part", part)
    best = rows.withColumn("_n", F.row_number().over(inner)).where(F.col("_n") <= k).drop("_n", "_part")
    w = Window.partitionBy(*factors).orderBy(*order)
    return best.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k)
