import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.models.neighbours import nearest_neighbours
from rankloom.plans import evaluate as ev
from rankloom.plans import framing, registry
from rankloom.plans.framing import FittedSpec
from rankloom.plans.spec import ModelSpec, Setting, Stage

FACTORS = ["dataset", "model", "tuning", "scoring"]


@pytest.fixture(scope="module")
def where(spark):
    """A table whose ranking follows the item, so that every framing has something to learn."""
    groups = spark.range(48).selectExpr("CAST(id % 6 AS INT) AS dataset", "CONCAT('m', id DIV 6 % 2) AS model",
                                        "CONCAT('t', id % 3) AS tuning", "CONCAT('s', id DIV 12) AS scoring")
    rows = groups.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(5)))).select(
        *FACTORS, F.concat(F.lit("e"), F.col("i")).alias("encoder"),
        F.pmod(F.col("i") + F.when(F.col("model") == "m1", 3).otherwise(0), F.lit(6)).cast("int").alias("rank"),
    ).cache()
    side = spark.range(6).selectExpr("CAST(id AS INT) AS dataset", "CAST(id AS DOUBLE) AS x", "CAST(id % 2 AS DOUBLE) AS y")
    edges = spark.createDataFrame([(f"e{i}", "root") for i in range(6)], "src string, dst string")
    return rows, Setting(FACTORS, "encoder", "rank", side, edges)


LEARN = ["regre_test", "pointwise_normalized_regression_no_search", "pointwise_classification_no_search",
         "pointwise_ordinal_regression_no_search", "pairwise_classification_no_search",
         "listwise_multidimensional_regression_no_search", "listwise_dimensionwise_regression_no_search"]


@pytest.mark.parametrize("name", LEARN)
def test_every_framing_learns_the_order(where, name):
    rows, setting = where
    scores = ev.cross_validate(registry.create(name), rows, setting, folds=1).collect()
    assert scores[0]["score"] > 0.8


def test_baselines_have_no_order(where):
    rows, setting = where
    assert ev.cross_validate(registry.create("regre_baseline"), rows, setting, folds=1).first()["score"] is None


def test_names_and_unknown_name():
    assert len(registry.SPECS) == 21
    with pytest.raises(ValueError, match="unknown model type"):
        registry.create("nonsense")


def test_editing_a_specification():
    spec = ModelSpec("x", "regression", (Stage("a", "keep", {"columns": ()}), Stage("estimator", "estimator", {"kind": "mean"})))
    assert spec.with_stage(Stage("b", "keep")).stage_names() == ["a", "b", "estimator"]
    assert spec.insert(Stage("b", "keep"), 0).stage_names() == ["b", "a", "estimator"]
    assert spec.insert(Stage("b", "keep"), 9).stage_names() == ["a", "estimator", "b"]
    assert spec.remove("a").stage_names() == spec.clear().stage_names() == ["estimator"]
    assert spec.with_estimator("median").estimator().settings["kind"] == "median"
    assert spec.with_params({"estimator__kind": "median"}).estimator().settings["kind"] == "median"
    assert spec.estimator().settings["kind"] == "mean"
    with pytest.raises(ValueError, match="no such parameter"):
        spec.with_params({"nothing__x": 1})


def test_search_records_failures(where):
    rows, setting = where
    space = {"estimator__strategy": ev.Choice(("mean", "nonsense"))}
    trials, best = ev.search(registry.create("regre_baseline"), rows, setting, space, "grid", folds=2)
    status = {r["params"]["estimator__strategy"]: r["status"] for r in trials.collect()}
    assert status == {"mean": "ok", "nonsense": "failed"} and best is None


def test_search_finds_the_deeper_tree(where):
    rows, setting = where
    spec = registry.create("regre_test")  # the order of the items depends on two columns
    trials, best = ev.search(spec, rows, setting, {"estimator__depth": ev.Choice((1, 8))}, "grid", folds=2)
    assert best == {"estimator__depth": 8} and ev.best_trial(trials).first()["trial"] == 1


@pytest.mark.parametrize("mode", ["parzen", "surrogate"])
def test_search_that_follows_the_scores(where, mode):
    """Two trials at a time, the last of them chosen by the sampler; failures are recorded and do not stop it."""
    rows, setting = where
    space = {"estimator__depth": ev.Integer(1, 4), "estimator__subset": ev.Choice((None, "nonsense"))}
    spec = registry.create("listwise_multidimensional_regression_no_search")
    trials, best = ev.search(spec, rows, setting, space, mode, trials=5, folds=2, startup=1)
    found = trials.collect()
    assert {r["trial"] for r in found} == set(range(5))
    assert all((r["status"] == "ok") == (r["params"]["estimator__subset"] == "None") for r in found)
    scores = {}
    for r in found:
        if r["status"] == "ok":
            scores.setdefault(r["trial"], []).append(r["score"])
    assert best is not None and best["estimator__subset"] is None
    top = max(scores, key=lambda t: (sum(scores[t]), -t))
    assert str(best["estimator__depth"]) == next(r["params"]["estimator__depth"] for r in found if r["trial"] == top)
    with pytest.raises(ValueError):
        ev.search(spec, rows, setting, space, "nonsense")


def test_inferred_space():
    space = ev.infer_space({"i": [1, 5], "f": [0.1, 0.9], "c": [None, "x", "y"]})
    assert space == {"i": ev.Integer(1, 5), "f": ev.Real(0.1, 0.9), "c": ev.Choice((None, "x", "y"))}
    assert ev.trial_settings(space, "random", 3, 7) == ev.trial_settings(space, "random", 3, 7)
    assert ev.infer_space({"many": [1, 5, 50], "wide": (1, 2.5)}) == {"many": ev.Choice((1, 5, 50)), "wide": ev.Real(1.0, 2.5)}
    for wrong in ([None], [1, "x"], [5, 1]):
        with pytest.raises(ValueError):
            ev.infer_space({"n": wrong})


def test_holdout_of_rows_without_factors(spark):
    from rankloom.plans.spec import Setting

    rows = spark.range(200).selectExpr("id AS row_id", "CAST(id % 7 AS STRING) AS item", "CAST(id % 7 AS DOUBLE) AS y")
    scores = ev.holdout(registry.create("regre_baseline"), rows, Setting([], "item", "y"), row_id="row_id").collect()
    assert scores and all(r["score"] is not None for r in scores)
    with pytest.raises(ValueError):
        ev.holdout(registry.create("regre_baseline"), rows, Setting([], "item", "y"))


def test_list_scorer_scores_every_held_out_row(where):
    rows, setting = where
    spec = registry.LISTWISE_SCORER.with_params({"estimator__maxIter": 10})
    found = {r["metric"]: r["score"] for r in ev.holdout_lists(spec, rows, setting, n=3).collect()}
    assert found["scored_rows"] == found["held_out_rows"] > 0 and found["ndcg"] is not None


def test_evaluate_follows_the_strategy(where):
    rows, setting = where
    spec = registry.create("listwise_multidimensional_regression_no_search")
    assert ev.evaluate(spec, rows, setting, "cross_validation", folds=2).count() == 2
    space = {"estimator__depth": ev.Choice((1, 4))}
    assert ev.evaluate(spec, rows, setting, "grid_search", space=space, folds=2, final_folds=2).count() == 2
    assert ev.evaluate(spec, rows, setting, "basic").count() >= 1
    with pytest.raises(ValueError):
        ev.evaluate(spec, rows, setting, "unknown")


def test_saved_model_predicts_the_same(spark, where, tmp_path):
    rows, setting = where
    fitted = framing.fit(registry.create("regre_test"), rows, setting)
    fitted.save(str(tmp_path / "fitted"))
    again = FittedSpec.load(spark, str(tmp_path / "fitted"))
    assert sorted(map(str, fitted.predict(rows).collect())) == sorted(map(str, again.predict(rows).collect()))


def test_holdout_metrics(where):
    rows, setting = where
    got = {r["metric"] for r in ev.holdout(registry.create("regre_test"), rows, setting).collect()}
    assert got == {"rmse", "mae", "r2", "spearman"}


def test_nearest_neighbours_against_brute_force(spark, monkeypatch):
    import rankloom.models.neighbours as nb

    monkeypatch.setattr(nb, "CHUNK_ROWS", 7)
    monkeypatch.setattr(nb, "BATCH_ROWS", 11)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 3)) * 20
    x = centres[rng.integers(0, 5, 120)] + rng.normal(size=(120, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = nearest_neighbours(df, df, "id", "v", 4, exclude_self=True).toPandas().sort_values(["query", "position"])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert got["neighbour"].tolist() == np.argsort(d, axis=1, kind="stable")[:, :4].ravel().tolist()


def test_command_line(spark, where, tmp_path):
    from rankloom.plans import cli

    rows, setting = where
    numbered = rows.withColumn("row_id", F.monotonically_increasing_id())
    full = numbered.select("row_id", *FACTORS, "encoder", F.lit(None).cast("double").alias("cv_score"),
                           F.col("rank").cast("double").alias("rank"))
    full.write.parquet(str(tmp_path / "train.parquet"))
    setting.side.write.parquet(str(tmp_path / "side"))
    scores = cli.run(spark, [
        "--pipeline_type", "listwise_multidimensional_regression_no_search", "--train_dataset",
        str(tmp_path / "train.parquet"), "--test_dataset", str(tmp_path / "train.parquet"), "--metafeatures",
        str(tmp_path / "side"), "--output", str(tmp_path / "out"),
    ])
    assert cli.report(scores).first()["mean"] > 0.8
    predicted = spark.read.schema("row_id long, prediction double").csv(str(tmp_path / "out" / "predictions"))
    assert predicted.where("prediction IS NOT NULL").count() == rows.count()


class _Seen(Exception):
    pass


@pytest.mark.parametrize("name", [
    "e3_tree_classifier", "e4_forest_classifier", "e5_boosting_classifier", "e7_perceptron_classifier", "e8_linear_svc"])
def test_registered_estimators_have_their_defaults(spark, monkeypatch, name):
    from rankloom.plans import catalog, model_queries

    def seen(kind, **settings):
        raise _Seen(settings)

    monkeypatch.setattr(model_queries, "make_estimator", seen)
    with pytest.raises(_Seen) as found:
        catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert found.value.args == ({},)


@pytest.mark.parametrize("name", [
    "regre_bayes_search", "pointwise_classification_bayes_search", "pointwise_ordinal_regression_bayes_search",
    "pointwise_normalized_regression_bayes_search", "listwise_dimensionwise_regression_bayes_search",
    "pointwise_regression_grid_search"])
def test_registered_searches_have_the_whole_space(monkeypatch, name):
    from rankloom.plans import catalog, model_queries

    def seen(spec, df, where, space=None, *args, **options):
        raise _Seen(space or spec.space)

    for other in ("rows_of", "setting"):
        monkeypatch.setattr(model_queries, other, lambda *a: None)
    monkeypatch.setattr(model_queries.ev, "search", seen)
    with pytest.raises(_Seen) as found:
        catalog.QUERIES[f"v8_{name}"](None, "")
    assert found.value.args == (registry.create(name).space,)
