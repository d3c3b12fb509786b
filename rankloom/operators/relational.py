"""Projections, filters, joins and unions on results tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.operators.skew import not_null_keys


def keep_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P1."""
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unknown names are an error, as a misspelt column should be."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.drop(*columns)


def distinct_groups(df: DataFrame, factors: Sequence[str]) -> DataFrame:
    """One row per factor group; rows with a missing factor belong to no group."""
    return not_null_keys(df.select(*factors), factors).distinct()


def contiguous_groups(df: DataFrame, factors: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Order rows so that each group is contiguous.

    A range exchange, not a hash exchange: a group larger than a task runs on over the neighbouring partitions when
    ``within`` gives it something to be cut by.
    """
    return not_null_keys(df, factors).orderBy(*factors, *within)


def split_target(df: DataFrame, target: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """P5: the feature columns and the target columns of the same rows."""
    targets = [target] if isinstance(target, str) else list(target)
    return df.drop(*targets), df.select(*targets)


def drop_for_prediction(df: DataFrame, targets: Sequence[str], item: str | None = None) -> DataFrame:
    """Drop whichever target and item columns are present."""
    return df.drop(*targets, *([item] if item else []))


def where_given(df: DataFrame, **conditions) -> DataFrame:
    """Keep rows equal to every argument that is not None."""
    given = [F.col(c) == v for c, v in conditions.items() if v is not None]
    return df.where(reduce(and_, given)) if given else df


def replace_values(df: DataFrame, mapping: Mapping, columns: Sequence[str]) -> DataFrame:
    """P10: replace listed values, leave the others."""
    return df.replace(dict(mapping), subset=list(columns))


def map_values(df: DataFrame, column: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """P10: look values up; a value without an entry becomes NULL."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return df.withColumn(out or column, F.try_element_at(F.create_map(*pairs), F.col(column)))


def label_by(df: DataFrame, columns: Sequence[str], mapping: DataFrame, label: str = "category") -> DataFrame:
    """Tag rows from a lookup table keyed by several columns, where a missing part matches a missing part.

    A row without an entry is an error, raised when it is met.
    """
    m = mapping.select(*[F.col(c).alias(f"_k_{c}") for c in columns], F.col(label).alias("_label"))
    cond = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in columns])
    checked = F.when(F.col("_label").isNotNull(), F.col("_label")).otherwise(
        F.raise_error(F.concat(F.lit("no category for "), F.concat_ws(", ", *[
            F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]))).cast("string")
    )
    return df.join(m, cond, "left").select(*df.columns, checked.alias(label))


def groups_covering_all(df: DataFrame, group: str, member: str) -> DataFrame:
    """Keep the groups in which every member of the table occurs."""
    pairs = df.select(group, member).distinct()  # one small table; both counts read it
    total = pairs.agg(F.count_distinct(member)).first()[0]
    covering = pairs.groupBy(group).agg(F.count(member).alias("_n")).where(F.col("_n") == total).select(group)
    return df.join(covering, group, "left_semi")


def mask_rows(df: DataFrame, cond: Column) -> DataFrame:
    """Rows that miss the condition stay, with every column NULL."""
    return df.select(*[F.when(cond, F.col(c)).alias(c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str] | None = None, prefix: str = "", suffix: str = "",
           only: Sequence[str] | None = None) -> DataFrame:
    """Rename listed columns, then add a prefix or suffix to ``only`` (default: all)."""
    df = df.withColumnsRenamed(dict(names or {}))
    touched = df.columns if only is None else only
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in touched}) if prefix or suffix else df


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """``strict=False`` gives NULL for a value that cannot be cast."""
    return df.withColumns({c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()})


def rows_of_groups(df: DataFrame, groups: DataFrame, factors: Sequence[str]) -> DataFrame:
    """The rows that belong to the listed groups."""
    return df.join(groups.select(*factors).distinct(), list(factors), "left_semi")


def truth_with_prediction(truth: DataFrame, predicted: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Bring true and predicted values of the same (factors, item) together."""
    return truth.join(predicted, list(keys), how)


def side_features(df: DataFrame, side: DataFrame, key: str, keep_key: bool = False) -> DataFrame:
    """Features of an entity; an unknown key gets NULL features. The join strategy follows the side's size."""
    out = df.join(side, key, "left")
    return out if keep_key else out.drop(key)


def lookup_vectors(df: DataFrame, vectors: DataFrame, node: str, handle_invalid: str = "error",
                   vector: str = "vec") -> DataFrame:
    """The vector of each row's node; an unknown node is an error, or NULL with ``handle_invalid='keep'``."""
    v = vectors.select(F.col("node").alias(node), F.col(vector).alias("_vec"))
    out = df.join(v, node, "left")
    if handle_invalid == "error":
        missing = F.raise_error(F.concat(F.lit("no vector for node "), F.col(node).cast("string")))
        value = F.when(F.col("_vec").isNotNull(), F.col("_vec")).otherwise(missing.cast(v.schema["_vec"].dataType))
    else:
        value = F.col("_vec")
    return out.withColumn(vector, value).drop("_vec")


def first_rows(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """O2: the first n rows of a stated order; a distributed top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def stack(*frames: DataFrame) -> DataFrame:
    """Rows of several frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def parameter_grid(spark: SparkSession, grid: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of the listed parameter values, as ``trial`` and a text map. Built from the parameter
    lists alone; its size never depends on data."""
    names = list(grid)
    rows = [(i, {n: str(v) for n, v in zip(names, combo)}) for i, combo in enumerate(product(*grid.values()))]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("trial", T.LongType()), T.StructField("params", T.MapType(T.StringType(), T.StringType()))]))


def value_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """U2 on data: all combinations of the distinct values of a few low-cardinality columns.

    Each value list is one aggregated array in a one-row frame, exploded in turn.
    """
    out = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in columns])
    for c in columns:
        out = out.withColumn(c, F.explode(c))
    return out
