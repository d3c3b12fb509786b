"""Long, wide and list layouts of the same rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.functions.keys import join_key, split_key

FILLS = (None, "global", "column", "row")


def distinct_items(df: DataFrame, item: str) -> list:
    """The sorted item vocabulary, for wide layouts. Refuses what Spark's own pivot would refuse."""
    limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = df.select(item).where(F.col(item).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} items: keep the long layout")
    return sorted(r[0] for r in rows)


def pivot_target(
    df: DataFrame,
    factors: Sequence[str],
    item: str,
    target: str,
    items: Sequence | None = None,
    fill: str | None = "global",
) -> DataFrame:
    """One row per group, one column per item.

    Missing cells get the worst (largest) target of the whole frame, of their column or of their row. Two rows for one
    (group, item) are an error, and so is a row whose item is not among ``items``. Rows without an item are no cells.
    """
    if fill not in FILLS:
        raise ValueError(f"unknown fill {fill!r}")
    if items is None:
        items = distinct_items(df, item)
    else:
        items = list(items)
        unlisted = F.raise_error(F.concat(F.lit(f"not among the listed items of {item}: "), F.col(item).cast("string")))
        known = F.col(item).isin(items) | F.col(item).isNull()
        df = df.withColumn(item, F.when(known, F.col(item)).otherwise(unlisted.cast(df.schema[item].dataType)))
    clash = F.raise_error(F.lit(f"two rows for one ({', '.join(factors)}, {item})"))
    kind = df.schema[target].dataType
    once = F.when(F.count(F.lit(1)) > 1, clash.cast(kind)).otherwise(F.max(target))
    wide = df.groupBy(*factors).pivot(item, items).agg(once)
    if fill is None:
        return wide
    names = [str(i) for i in items]
    cells = [F.col(f"`{n}`") for n in names]
    if fill == "row":
        worst = F.greatest(*cells) if len(cells) > 1 else cells[0]
        return wide.select(*factors, *[F.coalesce(c, worst).alias(n) for n, c in zip(names, cells)])
    # The maxima come from the long rows: one pass, no second pivot.
    if fill == "global":
        top = df.where(F.col(item).isin(items)).agg(F.max(target)).first()[0]
        worst_of = dict.fromkeys(names, top)
    else:
        tops = df.where(F.col(item).isin(items)).groupBy(item).agg(F.max(target)).collect()
        worst_of = {str(r[0]): r[1] for r in tops}
    return wide.select(
        *factors, *[F.coalesce(c, F.lit(worst_of.get(n)).cast(kind)).alias(n) for n, c in zip(names, cells)]
    )


def melt_target(df: DataFrame, factors: Sequence[str], items: Sequence | None, item: str, value: str,
                keep_null: bool = False) -> DataFrame:
    """R2: one row per (group, item) again; empty cells are dropped unless asked for."""
    columns = [c for c in df.columns if c not in set(factors)] if items is None else [str(i) for i in items]
    long = df.unpivot([F.col(f) for f in factors], [F.col(f"`{c}`") for c in columns], item, value)
    return long if keep_null else long.where(F.col(value).isNotNull())


def complete_grid(df: DataFrame, factors: Sequence[str], item: str, value: str, items: Sequence | None = None
                  ) -> DataFrame:
    """Every observed group with every item, the value NULL where the item is absent: the ranking matrix, long."""
    items = distinct_items(df, item) if items is None else list(items)
    return melt_target(pivot_target(df, factors, item, value, items, fill=None), factors, items, item, value, True)


def to_matrix(df: DataFrame, rows: str, columns: str, value: str, labels: Sequence, blank: str = "") -> DataFrame:
    """A sparse text matrix with blanks where there is no entry."""
    wide = df.groupBy(rows).pivot(columns, list(labels)).agg(F.max(F.col(value).cast("string")))
    return wide.fillna(blank, subset=[str(x) for x in labels])


def with_group_key(df: DataFrame, factors: Sequence[str], out: str = "features", sep: str = " ") -> DataFrame:
    """The group as one text key, beside its columns."""
    return df.withColumn(out, join_key(factors, sep))


def from_group_key(df: DataFrame, factors: Sequence[str], key: str = "features", sep: str = " ") -> DataFrame:
    """The factor columns (as text) of a text key."""
    rest = [c for c in df.columns if c not in set(factors)]
    return df.select(*rest, *split_key(key, factors, sep))


def explode_lists(df: DataFrame, arrays: Sequence[str]) -> DataFrame:
    """Parallel arrays to rows, one per position."""
    rest = [c for c in df.columns if c not in set(arrays)]
    zipped = df.select(*rest, F.explode(F.arrays_zip(*arrays)).alias("_z"))
    return zipped.select(*rest, *[F.col("_z").getField(a).alias(a) for a in arrays])
