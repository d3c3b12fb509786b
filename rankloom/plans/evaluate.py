"""Cross-validation, hold-out evaluation and search over specifications."""

from __future__ import annotations

import itertools
import time
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.operators.lists import sample_lists
from rankloom.operators.metrics import classification_metrics, regression_metrics
from rankloom.operators.profile import best_by
from rankloom.operators.ranking import average_spearman, ndcg_by_group
from rankloom.operators.reshape import explode_lists
from rankloom.operators.splits import group_kfold_keys, group_split_keys, row_split
from rankloom.session import packed, pin_state
from rankloom.plans.framing import FittedSpec, fit
from rankloom.plans.samplers import SAMPLERS, Choice, Integer, RandomSampler, Real
from rankloom.plans.spec import ModelSpec, Setting

FOLD_THREADS = 3
#: How the trials of each strategy are drawn.
MODES = {"grid_search": "grid", "random_search": "random", "trial_search": "parzen", "surrogate_search": "surrogate"}
SCORES_SCHEMA = "approach string, fold int, metric string, score double, groups long, runtime double"
TRIALS_SCHEMA = "trial int, params map<string,string>, fold int, score double, status string, error string"


class SpearmanEvaluator(Evaluator):
    """The mean group Spearman of a prediction as a pyspark.ml evaluator."""

    labelCol = Param(Params._dummy(), "labelCol", "true target", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", TypeConverters.toString)
    factors = Param(Params._dummy(), "factors", "grouping columns", TypeConverters.toListString)

    def __init__(self, factors: Sequence[str], labelCol: str = "rank", predictionCol: str = "prediction",
                 inverse=None):
        """``inverse`` maps a scored frame back to the original target before ranking, if one was transformed."""
        super().__init__()
        self._set(factors=list(factors), labelCol=labelCol, predictionCol=predictionCol)
        self.inverse = inverse

    def _evaluate(self, dataset) -> float:
        if self.inverse is not None:
            dataset = self.inverse(dataset)
        row = average_spearman(dataset, self.getOrDefault("factors"), self.getOrDefault("labelCol"),
                               self.getOrDefault("predictionCol")).first()
        return float("nan") if row["mean_rho"] is None else row["mean_rho"]

    def isLargerBetter(self) -> bool:
        return True


def _score(fitted: FittedSpec, test: DataFrame, where: Setting) -> tuple[float | None, int]:
    rows = test.select(*where.factors, where.item, where.target).where(F.col(where.target).isNotNull())
    scored = fitted.predict(rows).select(*where.factors, where.target, "prediction").persist()
    try:
        row = average_spearman(scored, where.factors, where.target, "prediction").first()
    finally:
        scored.unpersist()
    return row["mean_rho"], row["groups_used"]


def cross_validate(
    spec: ModelSpec, df: DataFrame, where: Setting, folds: int = 5, frac: float = 0.75, mode: str = "resample",
    seed: int = 0, stratum: Sequence[str] | None = None, threads: int = FOLD_THREADS, table: DataFrame | None = None,
) -> DataFrame:
    """V4/V5: one score row per fold. ``resample`` draws a new stratified split per fold (seed + fold); ``kfold``
    partitions the groups (V3), by ``table`` (the factors and ``fold``) if it is given. The rows are cached once and each fold is
    a filter on a small table of groups."""
    with packed(df.select(*where.roles)) as rows, ThreadPool(min(threads, folds)) as pool:
        def one(i: int) -> tuple:
            return _fold(spec, rows, where, i, folds, frac, mode, seed, stratum, table)

        scores = pool.map(inheritable_thread_target(df.sparkSession)(one), range(folds))
    return df.sparkSession.createDataFrame(scores, SCORES_SCHEMA)


def _sides(rows, where, i, folds, frac, mode, seed, stratum, table=None) -> tuple[DataFrame, DataFrame]:
    if mode == "resample":
        keys = group_split_keys(rows, where.factors, where.factors[:1] if stratum is None else stratum, frac, seed + i)
    elif mode == "kfold":
        keys = pin_state(group_kfold_keys(rows, where.factors, folds, seed)) if table is None else table
        keys = keys.select(*where.factors, (F.col("fold") != i).alias("is_train"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    split = rows.join(keys if mode == "kfold" else pin_state(keys), where.factors)  # evaluated once for both sides
    return split.where("is_train").drop("is_train"), split.where(~F.col("is_train")).drop("is_train")


def _fold(spec, rows, where, i, folds, frac, mode, seed, stratum, table) -> tuple:
    start = time.monotonic()
    train, test = _sides(rows, where, i, folds, frac, mode, seed, stratum, table)
    train = train.persist()
    try:
        score, groups = _score(fit(spec, train, where), test, where)
    finally:
        train.unpersist()
    return spec.name, i, "spearman", score, groups, time.monotonic() - start


def holdout(spec: ModelSpec, df: DataFrame, where: Setting, frac: float = 0.75, seed: int = 42,
            row_id: str | None = None) -> DataFrame:
    """One split, the metrics of the framing as ``metric, score``. Without factors rows are split (V2), by ``row_id``."""
    if not where.factors and row_id is None:
        raise ValueError("a split of rows without factors needs row_id, a column that tells the rows apart")
    own = [] if row_id is None or row_id in where.roles else [row_id]
    scored = None
    with packed(df.select(*where.roles, *own)) as rows:
        try:
            if where.factors:
                train, test = _sides(rows, where, 0, 1, frac, "resample", seed, None)
            else:
                split = row_split(rows, row_id, 0.8, seed)
                train, test = split.where("is_train").drop("is_train"), split.where(~F.col("is_train")).drop("is_train")
            test = test.where(F.col(where.target).isNotNull())
            scored = fit(spec, train, where).predict(test).persist()
            found = {}
            if spec.framing == "regression":
                found |= regression_metrics(scored, where.target, "prediction").first().asDict()
            elif spec.framing == "classification":
                found |= classification_metrics(scored, where.target, "prediction").first().asDict()
            if where.factors:
                found["spearman"] = average_spearman(scored, where.factors, where.target, "prediction").first()["mean_rho"]
        finally:
            if scored is not None:
                scored.unpersist()
    return df.sparkSession.createDataFrame(
        [(spec.name, m, None if v is None else float(v)) for m, v in found.items()],
        "approach string, metric string, score double",
    )


def holdout_lists(spec: ModelSpec, df: DataFrame, where: Setting, n: int = 15, frac: float = 0.75, seed: int = 42) -> DataFrame:
    """Fit on sampled lists of ``n`` items of the training groups, score every item of every held-out group. The
    result has Spearman and NDCG (the best rank is the most relevant) and how many rows were held out and scored."""
    scored = None
    with packed(df.select(*where.roles)) as rows:
        try:
            train, test = _sides(rows, where, 0, 1, frac, "resample", seed, None)
            if spec.framing == "list_network":  # it draws its lists itself
                spec = spec.with_params({"estimator__length": n, "estimator__seed": seed})
            else:
                drawn = sample_lists(train, where.factors, where.item, where.target, n, seed=seed).drop("list_no")
                train = explode_lists(drawn, ["items", "ranks"]).withColumnsRenamed({"items": where.item, "ranks": where.target})
            test = test.where(F.col(where.target).isNotNull())
            scored = fit(spec, train, where).predict(test).persist()
            top = scored.agg(F.max(where.target)).first()[0]
            graded = scored.withColumns({"_gain": F.lit(top) - F.col(where.target), "_score": -F.col("prediction")})
            found = {
                "spearman": average_spearman(scored, where.factors, where.target, "prediction").first()["mean_rho"],
                "ndcg": ndcg_by_group(graded, where.factors, where.item, "_gain", "_score").agg(F.avg("ndcg")).first()[0],
                "held_out_rows": test.count(), "scored_rows": scored.where("prediction IS NOT NULL").count(),
            }
        finally:
            if scored is not None:
                scored.unpersist()
    return df.sparkSession.createDataFrame(
        [(spec.name, m, None if v is None else float(v)) for m, v in found.items()],
        "approach string, metric string, score double",
    )


# --- search ---------------------------------------------------------------------------------------------------------

def search_axis(name: str, values: Any) -> Choice | Integer | Real:
    """One axis of a search space. A typed axis stays what it is; exactly two numbers bound a range, of whole numbers if
    both are whole; any other sequence is a choice. Values of different kinds on one axis are an error."""
    if isinstance(values, (Choice, Integer, Real)):
        return values
    options = tuple(values)
    given = [v for v in options if v is not None]
    if not given:
        raise ValueError(f"{name} has no value to search")
    numeric = [isinstance(v, (int, float)) and not isinstance(v, bool) for v in given]
    if not all(numeric) and (any(numeric) or len({type(v) for v in given}) > 1):
        raise ValueError(f"{name} mixes values of different kinds: {options}")
    if not all(numeric) or len(given) != 2 or len(options) != 2:
        return Choice(options)
    low, high = given
    if low > high:
        raise ValueError(f"{name}: the lower bound {low} is above {high}")
    return Integer(low, high) if isinstance(low, int) and isinstance(high, int) else Real(float(low), float(high))


def infer_space(lists: Mapping[str, Any]) -> dict[str, Choice | Integer | Real]:
    """V9: a typed space, axis by axis."""
    return {name: search_axis(name, values) for name, values in lists.items()}


def trial_settings(space: Mapping[str, Any], mode: str, trials: int, seed: int) -> list[dict]:
    """V6/V8: every combination of the lists, or seeded draws from the typed space."""
    if mode == "grid":
        lists = {n: s.values if isinstance(s, Choice) else s for n, s in space.items()}
        return [dict(zip(lists, combo)) for combo in itertools.product(*lists.values())]
    if mode != "random":
        raise ValueError(f"unknown mode {mode!r}")
    sampler = RandomSampler(infer_space(space), seed)
    return [sampler.ask([]) for _ in range(trials)]


def search(
    spec: ModelSpec, df: DataFrame, where: Setting, space: Mapping[str, Any] | None = None, mode: str = "random",
    trials: int = 10, folds: int = 4, seed: int = 0, split: str = "kfold", parallel: int = 2, startup: int | None = None,
) -> tuple[DataFrame, dict | None]:
    """V6-V9: a row per trial and fold, and the settings with the largest mean score (the first among equals).

    ``mode``: every combination of a ``grid``, ``random`` draws, or draws that follow the scores so far: ``surrogate`` (V8)
    or ``parzen`` (V9), the first ``startup`` of which are random. ``parallel`` trials run at once, each in a pool of the
    scheduler, and a sampler is told which are running. The folds are drawn once for all trials. Every trial is built from
    its own copy of the specification. A failing trial is recorded with its error and is never counted as a score.
    """
    space = space or spec.space or {}
    if mode == "grid" or mode == "random":
        settings = trial_settings(space, mode, trials, seed)
        ask = iter(settings).__next__
    elif mode in SAMPLERS:
        options = {} if startup is None else {"startup": startup}
        sampler, settings = SAMPLERS[mode](infer_space(space), seed, **options), []
    else:
        raise ValueError(f"unknown mode {mode!r}")
    total = len(settings) if mode in ("grid", "random") else trials
    out, history = [], []

    def one(trial: tuple[int, dict]) -> list[tuple]:
        t, params = trial
        df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{t % parallel}")
        text = {k: str(v) for k, v in params.items()}
        try:
            scores = cross_validate(spec.with_params(params), rows, where, folds, mode=split, seed=seed, table=table).collect()
            return [(t, text, r["fold"], r["score"], "ok", None) for r in scores]
        except Exception as e:  # a failed trial is a result of the search
            return [(t, text, None, None, "failed", f"{type(e).__name__}: {str(e)[:300]}")]

    with packed(df.select(*where.roles)) as rows:
        table = pin_state(group_kfold_keys(rows, where.factors, folds, seed)) if split == "kfold" else None
        run = inheritable_thread_target(df.sparkSession)(one)
        with ThreadPool(parallel) as pool:
            while len(history) < total:
                asked = []
                for _ in range(min(parallel, total - len(history))):
                    asked.append(ask() if mode in ("grid", "random") else sampler.ask([*history, *((p, None) for p in asked)]))
                found = pool.map(run, [(len(history) + i, p) for i, p in enumerate(asked)])
                for params, each in zip(asked, found):
                    defined = [r[3] for r in each if r[3] is not None]
                    history.append((params, sum(defined) / len(defined) if defined else None))
                    out += each
    scored = [t for t, (_, score) in enumerate(history) if score is not None]
    best = max(scored, key=lambda t: (history[t][1], -t)) if scored else None
    return df.sparkSession.createDataFrame(out, TRIALS_SCHEMA), None if best is None else history[best][0]


def best_trial(trials: DataFrame) -> DataFrame:
    """O3: the trial with the largest mean score."""
    means = trials.where("status = 'ok'").groupBy("trial").agg(F.avg("score").alias("mean_score"))
    return best_by(means, "mean_score", tie=["trial"])


def search_and_validate(spec: ModelSpec, df: DataFrame, where: Setting, final_folds: int = 5, **options) -> DataFrame:
    """V8: the rows of the specification's own search, then those of the cross-validation (V4) of its best trial, whose status is
    ``final``. Without a score there is no best trial and no such row."""
    trials, best = search(spec, df, where, mode=MODES[spec.strategy], **options)
    if best is None:
        return trials
    number, text = best_trial(trials).first()["trial"], {k: str(v) for k, v in best.items()}
    scores = cross_validate(spec.with_params(best), df, where, final_folds).collect()
    final = [(number, text, r["fold"], r["score"], "final", None) for r in scores]
    return trials.unionAll(df.sparkSession.createDataFrame(final, TRIALS_SCHEMA))


def evaluate(spec: ModelSpec, df: DataFrame, where: Setting, strategy: str | None = None, **options) -> DataFrame:
    """M4: scores by strategy. A search is followed by cross-validation of the best settings."""
    strategy = strategy or spec.strategy
    if strategy == "basic":
        return holdout(spec, df, where, **options)
    if strategy == "cross_validation":
        return cross_validate(spec, df, where, **options)
    if strategy in MODES:
        folds = options.pop("final_folds", 5)
        _, best = search(spec, df, where, mode=MODES[strategy], **options)
        if best is None:
            raise RuntimeError(f"every trial of {spec.name} failed")
        return cross_validate(spec.with_params(best), df, where, folds)
    raise ValueError(f"unknown strategy {strategy!r}")
