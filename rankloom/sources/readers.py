"""Readers. Every reader is lazy, takes an explicit schema and leaves pruning and pushdown to the scan."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULTS_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("dataset", T.IntegerType()),
    T.StructField("model", T.StringType()),
    T.StructField("tuning", T.StringType()),
    T.StructField("scoring", T.StringType()),
    T.StructField("encoder", T.StringType()),
    T.StructField("cv_score", T.DoubleType()),
    T.StructField("rank", T.DoubleType()),
])

REPORT_SCHEMAS = {
    "scores": "approach string, preprocessing string, estimator string, tuning string, score double, runtime double",
    "best_scores": "approach string, tuning string, metric string, score double, fold int, runtime double",
    "rank_counts": "model string, tuning string, scoring string, rank double, count long",
}


def read_results(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    fmt: str = "csv",
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """A long results table from headed CSV or from Parquet.

    ``columns`` maps a column of the file to the name wanted here; only mapped columns are then read. NaN in a double
    column becomes NULL, the one form of "missing" the operators know.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", columns is None)
        df = reader.schema(schema or RESULTS_SCHEMA).csv(path)
    else:
        df = (reader.schema(schema) if schema is not None else reader).format(fmt).load(path)
    if columns is not None:
        df = df.select(*[F.col(old).alias(new) for old, new in columns.items()])
    return nan_to_null(df)


def nan_to_null(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns]
    )


def read_wide_rankings(
    spark: SparkSession,
    path: str,
    header_rows: int = 4,
    item: str = "encoder",
    value: str = "rank",
    levels: Sequence[str] = ("dataset", "model", "tuning", "scoring"),
) -> DataFrame:
    """A matrix CSV (items down, one column per group, one header line per factor) melted to long rows.

    Only the header lines of the file whose name comes first reach the driver. A line in a file's first block that repeats one
    of them whole, as each further file does, is none of the data; the others are parsed with generated column names, unpivoted on the cluster and joined with the header
    table. Quoted labels may hold commas; missing cells stay as NULL.
    """
    text = spark.read.text(path)
    header = [r.value for r in spark.read.text(min(text.inputFiles())).limit(header_rows).collect()]
    head = list(csv.reader(header))
    groups = [(f"c{j}", *[line[j] for line in head]) for j in range(1, len(head[0]))]
    names = [item, *[g[0] for g in groups]]
    cells = F.from_csv("value", ", ".join(f"`{n}` STRING" for n in names)).alias("_row")
    raw = text.where(~((F.col("_metadata.file_block_start") == 0) & F.col("value").isin(header))).select(cells).select("_row.*")
    long = raw.unpivot([item], names[1:], "_column", "_cell")
    labels = spark.createDataFrame(groups, ["_column", *levels])
    keep = F.col(item).isNotNull() & (F.trim(item) != "")
    return long.where(keep).join(labels, "_column").select(
        *levels, item, F.expr("try_cast(_cell AS DOUBLE)").alias(value)
    )


def attach_target(df: DataFrame, target_df: DataFrame, key: str | Sequence[str], target: str) -> DataFrame:
    """S3: join a separate target table on an explicit row key, replacing the column if it is already there."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.drop(target).join(target_df.select(*keys, target), keys, "inner")


def read_adjacency(spark: SparkSession, path: str, directed: bool = False, comment: str = "#") -> DataFrame:
    """An adjacency list (node, then its neighbours) as distinct edges ``src, dst``.

    Undirected edges appear in both directions.
    """
    tokens = F.split(F.trim(F.col("value")), r"\s+")
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith(comment))
    edges = lines.select(tokens.alias("t")).select(
        F.col("t")[0].alias("src"), F.explode(F.slice("t", 2, F.greatest(F.size("t") - 1, F.lit(0)))).alias("dst")
    )
    return edges.distinct() if directed else both_directions(edges)


def both_directions(edges: DataFrame) -> DataFrame:
    """An undirected edge list: each edge once per direction. One scan, one exchange."""
    turned = edges.select(
        F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
        .alias("e")
    )
    return turned.select("e.src", "e.dst").distinct()


def read_metafeatures(spark: SparkSession, path: str, key: str = "dataset", fmt: str = "parquet",
                      name: str | None = None, value: str | None = None, names: Sequence[str] | None = None
                      ) -> DataFrame:
    """A side table per entity; a long ``(key, name, value)`` table is turned wide over the given names."""
    df = spark.read.format(fmt).load(path)
    return df if name is None else spread_features(df, key, name, value, names)


def spread_features(df: DataFrame, key: str, name: str, value: str, names: Sequence[str]) -> DataFrame:
    return df.groupBy(key).pivot(name, list(names)).agg(F.max(value))


def read_score_reports(spark: SparkSession, path: str, kind: str = "best_scores") -> DataFrame:
    """A score report with one of the known layouts."""
    return spark.read.schema(REPORT_SCHEMAS[kind]).option("header", True).csv(path)
