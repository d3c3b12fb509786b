"""Sinks. Every writer runs on the executors and leaves the number of files to the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rankloom.operators.profile import value_counts


def write_predictions(df: DataFrame, path: str, keys: Sequence[str], prediction: str = "prediction",
                      fmt: str = "csv", header: bool = False) -> None:
    """Predictions beside the keys they belong to; a file has no row order to rely on."""
    out = df.select(*keys, prediction)
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", header).csv(path)
    else:
        writer.format(fmt).save(path)


def write_value_counts(df: DataFrame, groups: Sequence[str], value: str, path: str) -> None:
    """Counts per group and value as headed CSV."""
    value_counts(df, value, groups).write.mode("overwrite").option("header", True).csv(path)
