"""Quality of predictions as plain aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """RMSE, MAE and R2 in one pass."""
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sums = rows.agg(
        F.avg((y - p) * (y - p)).alias("mse"), F.avg(F.abs(y - p)).alias("mae"), F.var_pop(y).alias("var")
    )
    return sums.select(
        F.sqrt("mse").alias("rmse"), "mae", (1 - F.try_divide("mse", "var")).alias("r2"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy, macro F1 and multiclass Matthews correlation from confusion counts.

    The rows are reduced to one per (label, prediction) at once; everything after runs on that small table.
    """
    rows = df.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    cells = rows.groupBy(F.col(label).cast("double").alias("y"), F.col(prediction).cast("double").alias("p")).agg(
        F.count(F.lit(1)).cast("double").alias("n")
    )
    sides = cells.select(
        F.explode(F.array(
            F.struct(F.col("y").alias("c"), F.col("n").alias("t"), F.lit(0.0).alias("q")),
            F.struct(F.col("p").alias("c"), F.lit(0.0).alias("t"), F.col("n").alias("q")),
        )).alias("s"),
        F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0.0).alias("hit"),
    )
    # A hit row appears once as a label side and once as a prediction side, hence the halving.
    by_class = sides.groupBy("s.c").agg(
        F.sum("s.t").alias("t"), F.sum("s.q").alias("q"), (F.sum("hit") / 2).alias("hit")
    )
    totals = by_class.agg(
        F.sum("t").alias("s"), F.sum("hit").alias("c"), F.avg(F.col("hit") * 2 / (F.col("t") + F.col("q"))).alias("f1"),
        F.sum(F.col("t") * F.col("q")).alias("tq"), F.sum(F.col("t") * F.col("t")).alias("tt"),
        F.sum(F.col("q") * F.col("q")).alias("qq"),
    )
    s, c = F.col("s"), F.col("c")
    spread = F.sqrt((s * s - F.col("qq")) * (s * s - F.col("tt")))
    return totals.select(
        F.try_divide(c, s).alias("accuracy"), F.col("f1").alias("macro_f1"),
        F.coalesce(F.try_divide(c * s - F.col("tq"), spread), F.lit(0.0)).alias("mcc"),
    )
