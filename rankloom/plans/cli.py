"""M7: command-line entry for spark-submit: train, evaluate and predict with a named specification."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.operators.relational import drop_for_prediction
from rankloom.plans import evaluate as ev
from rankloom.plans import framing, registry
from rankloom.plans.spec import Setting
from rankloom.sources.readers import (
    attach_target, read_adjacency, read_metafeatures, read_results,
)
from rankloom.sources.writers import write_predictions

FACTORS = ["dataset", "model", "tuning", "scoring"]
ITEM = "encoder"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Rank items inside factor groups")
    p.add_argument("--pipeline_type", default="pairwise_classification_optuna_search", help="named specification")
    p.add_argument("--train_dataset", required=True, help="headed CSV with row_id first, or a Parquet path")
    p.add_argument("--test_dataset", default="", help="rows to predict")
    p.add_argument("--y_train_dataset", default="", help="separate target, joined on row_id")
    p.add_argument("--target", default="rank")
    p.add_argument("--as_neural_network", action="store_true", help="use the listwise scorer instead")
    p.add_argument("--epochs", type=int, default=200, help="iterations of the listwise scorer")
    p.add_argument("--list_length", type=int, default=32, help="items of a list of the listwise scorer")
    p.add_argument("--opt_iterations", type=int, default=100, help="trials of a search")
    p.add_argument("--metafeatures", default="", help="Parquet side table keyed by dataset")
    p.add_argument("--graph", default="", help="adjacency list of the items")
    p.add_argument("--output", default="", help="folder for predictions and the fitted model")
    return p


def _read(spark: SparkSession, path: str) -> DataFrame:
    return read_results(spark, path, fmt="parquet" if path.rstrip("/").endswith(".parquet") else "csv")


def run(spark: SparkSession, argv: Sequence[str] | None = None) -> DataFrame:
    """Evaluate, and with a test table and an output folder also fit on everything and predict. Returns the scores."""
    args = parser().parse_args(argv)
    train = _read(spark, args.train_dataset)
    if args.y_train_dataset:
        train = attach_target(train, _read(spark, args.y_train_dataset), "row_id", args.target)
    where = Setting(
        FACTORS, ITEM, args.target,
        read_metafeatures(spark, args.metafeatures) if args.metafeatures else None,
        read_adjacency(spark, args.graph, directed=True) if args.graph else None,
    )
    if args.as_neural_network:
        spec = registry.LISTWISE_SCORER.with_params({
            "estimator__maxIter": args.epochs, "estimator__length": args.list_length})
        scores = ev.holdout_lists(spec, train, where, args.list_length)
    else:
        spec = registry.create(args.pipeline_type)
        if spec.space is not None:
            trials, best = ev.search(spec, train, where, mode=ev.MODES[spec.strategy], trials=args.opt_iterations)
            if best is None:
                raise RuntimeError(f"every trial failed, for instance: {trials.select('error').first()[0]}")
            spec = spec.with_params(best)
        scores = ev.cross_validate(spec, train, where, folds=5)
    if args.test_dataset and args.output:
        fitted = framing.fit(spec, train, where)
        test = drop_for_prediction(_read(spark, args.test_dataset), [args.target, "cv_score", "rank"])
        write_predictions(fitted.predict(test), f"{args.output}/predictions", ["row_id"])
        fitted.save(f"{args.output}/model")
    return scores


def report(scores: DataFrame) -> DataFrame:
    """Mean and population spread over the folds."""
    return scores.groupBy("approach", "metric").agg(
        F.round(F.avg("score"), 4).alias("mean"), F.round(F.stddev_pop("score"), 4).alias("std")
    )


if __name__ == "__main__":
    session = SparkSession.builder.appName("rankloom").getOrCreate()
    report(run(session)).show(truncate=False)
