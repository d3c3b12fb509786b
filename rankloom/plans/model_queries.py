"""Registered queries: graph features, estimators, cross-validation, search and the named specifications."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.models.baseline import BaselineEstimator
from rankloom.models.estimators import make_estimator
from rankloom.models.neighbours import knn_predict, nearest_neighbours
from rankloom.operators import graph
from rankloom.operators.metrics import classification_metrics
from rankloom.operators.relational import lookup_vectors
from rankloom.operators.splits import row_split
from rankloom.plans import evaluate as ev
from rankloom.plans import registry
from rankloom.plans.catalog import query
from rankloom.plans.spec import Setting
from rankloom.plans.tables import (
    FACTORS, ITEM, KEYS, RESULTS_CTE, item_edges, metafeatures, purchase_edges, ranked_results, results, table,
)
from rankloom.session import packed

_SETTINGS: dict[tuple[str, str], Setting] = {}


def fresh_setting(spark: SparkSession, sf_dir: str) -> Setting:
    """Column roles, side table and item graph of the derived results."""
    return Setting(FACTORS, ITEM, "rank", metafeatures(spark, sf_dir), item_edges(spark, sf_dir))


def setting(spark: SparkSession, sf_dir: str) -> Setting:
    """The same for all queries of an application, so that the item embedding is fitted once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SETTINGS:
        _SETTINGS[key] = fresh_setting(spark, sf_dir)
    return _SETTINGS[key]


def rows_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_results(spark, sf_dir).select(*KEYS, "rank")


# --- graph ----------------------------------------------------------------------------------------------------------

@query("s5_g5_edges_both_directions", """
WITH e AS (SELECT DISTINCT p_brand AS src, p_type AS dst FROM part)
SELECT src, dst FROM e UNION SELECT dst, src FROM e""")
def s5(spark, sf_dir):
    from rankloom.sources.readers import both_directions

    return both_directions(item_edges(spark, sf_dir))


@query("g1_random_walks")
def g1(spark, sf_dir):
    walks = graph.random_walks(purchase_edges(spark, sf_dir), length=10, walks=2)
    return walks.select("start", "walk", F.array_join("path", ">").alias("path"))


@query("g1_walk_embedding")
def g1_embedding(spark, sf_dir):
    return graph.walk_embedding(item_edges(spark, sf_dir), dimensions=2, length=20, walks=1000)


@query("g1_walk_factors")
def g1_factors(spark, sf_dir):
    return graph.walk_factors(purchase_edges(spark, sf_dir), dimensions=8, length=10, walks=4)


@query("g2_node_clusters")
def g2(spark, sf_dir):
    return graph.cluster_nodes(graph.walk_embedding(item_edges(spark, sf_dir), dimensions=2, length=20, walks=1000), k=6)


@query("g3_poincare_embedding")
def g3(spark, sf_dir):
    return graph.poincare_embedding(item_edges(spark, sf_dir), size=2, epochs=50)


@query("g4_j9_attach_vectors", f"""WITH {RESULTS_CTE}, vec AS (
  SELECT p_brand AS encoder, COUNT(*) AS v0, MAX(p_size) AS v1 FROM part GROUP BY p_brand)
SELECT dataset, model, tuning, scoring, encoder, CAST(v0 AS DOUBLE) AS v0, CAST(v1 AS DOUBLE) AS v1
FROM results JOIN vec USING (encoder)""")
def g4(spark, sf_dir):
    vectors = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("node")).agg(
        F.array(F.count(F.lit(1)).cast("double"), F.max("p_size").cast("double")).alias("vec")
    )
    out = lookup_vectors(results(spark, sf_dir).select(*KEYS), vectors, ITEM)
    return out.select(*KEYS, F.col("vec")[0].alias("v0"), F.col("vec")[1].alias("v1"))


# --- estimators -----------------------------------------------------------------------------------------------------

def _baseline(strategy: str, sql: str):
    @query(f"e1_baseline_{strategy}", f"SELECT event_id, ROUND(CAST(({sql}) AS DOUBLE), 6) AS prediction FROM events")
    def plan(spark, sf_dir):
        events = table(spark, sf_dir, "events").select("event_id", "value")
        out = BaselineEstimator(labelCol="value", strategy=strategy).fit(events).transform(events)
        return out.select("event_id", F.round("prediction", 6).alias("prediction"))

    return plan


_baseline("mean", "SELECT AVG(value) FROM events")
_baseline("median", "SELECT MEDIAN(value) FROM events")
_baseline("most_frequent", "SELECT value FROM events GROUP BY value ORDER BY COUNT(*) DESC, value LIMIT 1")

NEAR_CTE = """near AS (
  SELECT a.vec_id AS query, b.vec_id AS neighbour, b.label,
    list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance,
    CAST(ROW_NUMBER() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]),
                            b.vec_id) AS INTEGER) AS position
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id QUALIFY position <= 5)"""


@query("e6_nearest_neighbours", f"WITH {NEAR_CTE} SELECT query, neighbour, ROUND(distance, 6) AS distance, position FROM near")
def e6(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    near = nearest_neighbours(vectors, vectors, "vec_id", "embedding", k=5, exclude_self=True)
    return near.withColumn("distance", F.round("distance", 6))


@query("e6_knn_classification", f"""WITH {NEAR_CTE}, votes AS (SELECT query, label, COUNT(*) AS n FROM near GROUP BY 1, 2)
SELECT query AS vec_id, label AS prediction FROM votes
QUALIFY ROW_NUMBER() OVER (PARTITION BY query ORDER BY n DESC, label) = 1""")
def e6_classification(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return knn_predict(vectors, vectors, "vec_id", "embedding", "label", k=5, exclude_self=True)


@query("e6_knn_regression", f"""WITH {NEAR_CTE}
SELECT query AS vec_id, ROUND(CAST(SUM(label) AS DOUBLE) / COUNT(*), 6) AS prediction FROM near GROUP BY query""")
def e6_regression(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    out = knn_predict(vectors, vectors, "vec_id", "embedding", "label", 5, "regression", exclude_self=True)
    return out.withColumn("prediction", F.round("prediction", 6))


def _embedding_classifier(name: str, kind: str):
    @query(name)
    def plan(spark, sf_dir):
        points = table(spark, sf_dir, "embeddings").select(
            "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
            F.col("label").cast("double").alias("label"),
        )
        with packed(row_split(points, "vec_id")) as split:
            model = make_estimator(kind).fit(split.where("is_train"))
        return classification_metrics(model.transform(split.where(~F.col("is_train"))), "label", "prediction")

    return plan


_embedding_classifier("e3_tree_classifier", "tree_classifier")
_embedding_classifier("e4_forest_classifier", "forest_classifier")
_embedding_classifier("e5_boosting_classifier", "boosting_classifier")
_embedding_classifier("e7_perceptron_classifier", "mlp_classifier")
_embedding_classifier("e8_linear_svc", "svc_classifier")
_embedding_classifier("e8_kernel_svc", "kernel_svc_classifier")
_embedding_classifier("e5_adaboost_classifier", "adaboost_classifier")


def _regressor(name: str, kind: str):
    """The regression specification with another estimator, on one hold-out split."""

    @query(name)
    def plan(spark, sf_dir):
        spec = registry.create("regre_no_search").with_estimator(kind)
        return ev.holdout(spec, rows_of(spark, sf_dir), setting(spark, sf_dir))

    return plan


_regressor("e7_perceptron_regressor", "mlp")
_regressor("e8_support_vector_regressor", "svr")
_regressor("e8_kernel_svr", "kernel_svr")


@query("e11_listwise_scorer")
def e11(spark, sf_dir):
    """Trained on sampled lists, scored on all items of the held-out groups."""
    return ev.holdout_lists(registry.LISTWISE_SCORER, rows_of(spark, sf_dir), setting(spark, sf_dir), n=15)


# --- evaluation and search ------------------------------------------------------------------------------------------

def _holdout(name: str, spec_name: str):
    @query(name)
    def plan(spark, sf_dir):
        return ev.holdout(registry.create(spec_name), rows_of(spark, sf_dir), setting(spark, sf_dir))

    return plan


_holdout("v10_holdout_regression", "regre_test")
_holdout("v10_holdout_classification", "pointwise_classification_no_search")
_holdout("v10_holdout_pairs", "pairwise_classification_no_search")


@query("v6_grid_search")
def v6(spark, sf_dir):
    space = {"estimator__depth": ev.Choice((3, 6)), "general_transformer__model": ev.Choice(("onehot", "ordinal"))}
    trials, _ = ev.search(registry.create("listwise_multidimensional_regression_no_search"), rows_of(spark, sf_dir),
                          setting(spark, sf_dir), space, "grid", folds=2)
    return trials


@query("v7_pair_grid_search")
def v7(spark, sf_dir):
    trials, _ = ev.search(registry.create("pairwise_classification_no_search"), rows_of(spark, sf_dir),
                          setting(spark, sf_dir), {"estimator__depth": ev.Choice((3, 6))}, "grid", folds=2)
    return trials


@query("v8_random_search_trials")
def v8(spark, sf_dir):
    trials, _ = ev.search(registry.create("listwise_multidimensional_regression_bayes_search"),
                          rows_of(spark, sf_dir), setting(spark, sf_dir), trials=3, folds=2)
    return trials


@query("v8_surrogate_search")
def v8_surrogate(spark, sf_dir):
    """The published space; after four draws the surrogate chooses."""
    spec = registry.create("listwise_multidimensional_regression_bayes_search")
    trials, _ = ev.search(spec, rows_of(spark, sf_dir), setting(spark, sf_dir), mode=ev.MODES[spec.strategy], trials=8, folds=2,
                          startup=4)
    return trials


@query("v9_parzen_search")
def v9_parzen(spark, sf_dir):
    """The published space; after four draws the densities choose."""
    spec = registry.create("pairwise_classification_optuna_search")
    trials, _ = ev.search(spec, rows_of(spark, sf_dir), setting(spark, sf_dir), mode=ev.MODES[spec.strategy], trials=6, folds=2,
                          startup=4)
    return trials


@query("v9_inferred_space_trials")
def v9(spark, sf_dir):
    space = ev.infer_space({
        "dataset_transformer__threshold": [0.25, 0.5], "estimator__depth": [2, 6],
        "general_transformer__model": ["onehot", "binary", "ordinal"],
    })
    trials, _ = ev.search(registry.create("pairwise_classification_optuna_search"), rows_of(spark, sf_dir),
                          setting(spark, sf_dir), space, mode="parzen", trials=2, folds=2)
    return ev.best_trial(trials)


# The registered runs keep two folds.
CROSS_VALIDATED = {
    "regre_baseline": "m6_regre_baseline", "class_baseline": "m6_class_baseline",
    "linear_regression": "e2_linear_regression", "regre_preprocessed": "e5_regre_preprocessed",
    "regre_no_search": "v4_regression", "pointwise_regression_no_search": "e4_pointwise_regression",
    "pointwise_normalized_regression_no_search": "v4_normalized_regression",
    "pointwise_classification_no_search": "v4_classification",
    "pointwise_ordinal_regression_no_search": "v4_ordinal_regression",
    "pairwise_classification_no_search": "v5_pairs",
    "listwise_multidimensional_regression_no_search": "e10_listwise_multidimensional",
    "listwise_dimensionwise_regression_no_search": "e9_listwise_dimensionwise",
}


def _cross_validated(spec_name: str, name: str):
    @query(name)
    def plan(spark, sf_dir):
        scores = ev.cross_validate(registry.create(spec_name), rows_of(spark, sf_dir), setting(spark, sf_dir), folds=2)
        return scores.drop("runtime")

    return plan


for _spec, _name in CROSS_VALIDATED.items():
    _cross_validated(_spec, _name)


def _grid_searched(spec_name: str, name: str):
    @query(name)
    def plan(spark, sf_dir):
        trials, _ = ev.search(registry.create(spec_name), rows_of(spark, sf_dir), setting(spark, sf_dir), mode="grid", folds=2)
        return trials

    return plan


def _searched(spec_name: str, name: str):
    """After four draws the surrogate chooses; the best settings are cross-validated at the end."""

    @query(name)
    def plan(spark, sf_dir):
        return ev.search_and_validate(registry.create(spec_name), rows_of(spark, sf_dir), setting(spark, sf_dir), final_folds=2,
                                      trials=8, folds=2, startup=4)

    return plan


_grid_searched("pointwise_regression_grid_search", "v8_pointwise_regression_grid_search")
for _spec in ("regre_bayes_search", "pointwise_classification_bayes_search",
              "pointwise_ordinal_regression_bayes_search", "pointwise_normalized_regression_bayes_search",
              "listwise_dimensionwise_regression_bayes_search"):
    _searched(_spec, f"v8_{_spec}")
