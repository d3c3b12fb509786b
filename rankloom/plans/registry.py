"""M6: the named model specifications."""

from __future__ import annotations

from rankloom.plans.evaluate import Choice, Integer, Real
from rankloom.plans.spec import ESTIMATOR, ModelSpec, Stage

FACTOR_COLUMNS = ("dataset", "model", "tuning", "scoring")


def _estimator(kind: str, **settings) -> Stage:
    return Stage(ESTIMATOR, ESTIMATOR, {"kind": kind, **settings})


def _embedding(encoder: str | None = None, size: int = 3, epochs: int = 50) -> Stage:
    return Stage("encoder_transformer", "item_embedding", {"size": size, "epochs": epochs, "encoder": encoder})


def _side(threshold: float = 0.25, variance: float = 0.6, encoder: str | None = None) -> Stage:
    return Stage("dataset_transformer", "side_table", {"threshold": threshold, "variance": variance,
                                                       "encoder": encoder})


def _factors(model: str, tuning: str, scoring: str) -> Stage:
    return Stage("general_transformer", "factor_encoders", {"model": model, "tuning": tuning, "scoring": scoring})


KEEP = Stage("keeper", "keep", {"columns": FACTOR_COLUMNS})
TARGET_MIX = _factors("onehot", "target", "target")
ALL_ONE_HOT = _factors("onehot", "onehot", "onehot")
PAIR_ITEMS = Stage("item_encoder", "item_encoder", {"columns": ("item_a", "item_b"), "encoder": "onehot"})

REGRESSION = (_embedding("onehot"), _side(), TARGET_MIX)
ONE_HOT = (_embedding("onehot"), _side(), ALL_ONE_HOT)

# The published search ranges.
# Depths from 50 on all mean Spark's largest here, so that they are one value, None.
DEPTHS = Choice((1, 10, None))
LEAVES = Integer(1, 5)
SUBSETS = Choice((None, "sqrt", "log2"))
SIDE_SPACE = {
    "dataset_transformer__threshold": Choice((0.25, 0.4, 0.45, 0.5)),
    "dataset_transformer__variance": Real(0.25, 1.0),
    "dataset_transformer__encoder": Choice((None, "onehot")),
}


def _factor_space(*kinds: str) -> dict:
    return {f"general_transformer__{f}": Choice(kinds) for f in ("model", "tuning", "scoring")}


TREE_SPACE = {f"{ESTIMATOR}__depth": DEPTHS, f"{ESTIMATOR}__leaf": LEAVES, f"{ESTIMATOR}__subset": SUBSETS}
MULTI_TREE_SPACE = {**TREE_SPACE, f"{ESTIMATOR}__split": Integer(2, 5)}
FOREST_SPACE = {f"{ESTIMATOR}__depth": DEPTHS, f"{ESTIMATOR}__trees": Integer(50, 200), f"{ESTIMATOR}__leaf": LEAVES,
                f"{ESTIMATOR}__subset": SUBSETS}
ITEM_SPACE = {"encoder_transformer__encoder": Choice((None, "onehot"))}
WITH_TARGET = _factor_space("onehot", "ordinal", "target")
WITHOUT_TARGET = _factor_space("onehot", "ordinal")
PAIR_SPACE = {
    "dataset_transformer__threshold": Real(0.25, 0.5),
    "dataset_transformer__variance": Real(0.25, 1.0),
    "dataset_transformer__encoder": Choice(("onehot", "binary")),
    **_factor_space("onehot", "binary", "ordinal"),
}
GRID_SPACE = {
    f"{ESTIMATOR}__depth": Choice((5, 10)), f"{ESTIMATOR}__trees": Choice((10, 20)),
}


def _with_search(base: ModelSpec, name: str, space: dict, strategy: str = "surrogate_search") -> ModelSpec:
    return ModelSpec(name, base.framing, base.stages, space, strategy)


def _build() -> dict[str, ModelSpec]:
    tree, forest, classes = _estimator("tree"), _estimator("forest"), _estimator("tree_classifier")
    pair_stages = (_side(), ALL_ONE_HOT, PAIR_ITEMS, classes)
    list_stages = (KEEP, _side(), ALL_ONE_HOT)
    plain = [
        ModelSpec("regre_baseline", "regression", (_estimator("mean"),)),
        ModelSpec("class_baseline", "classification", (_estimator("most_frequent"),)),
        ModelSpec("linear_regression", "regression", (
            Stage("poincare_embedding", "item_embedding", {"size": 2}), _estimator("linear"))),
        ModelSpec("regre_preprocessed", "regression", (
            _embedding(), _side(0.4, 1.0, "target"), _factors("ordinal", "binary", "binary"), _estimator("boosting"))),
        ModelSpec("regre_test", "regression", (
            _embedding("onehot"), _side(), _factors("ordinal", "ordinal", "ordinal"), tree)),
        ModelSpec("regre_no_search", "regression", (*REGRESSION, tree)),
        ModelSpec("pointwise_regression_no_search", "regression", (KEEP, *REGRESSION, forest)),
        ModelSpec("pointwise_normalized_regression_no_search", "normalized", (KEEP, *REGRESSION, forest)),
        ModelSpec("pointwise_classification_no_search", "classification", (KEEP, *REGRESSION, classes)),
        ModelSpec("pointwise_ordinal_regression_no_search", "ordinal", (KEEP, *ONE_HOT, classes)),
        ModelSpec("pairwise_classification_no_search", "pairwise", pair_stages),
        ModelSpec("listwise_multidimensional_regression_no_search", "multioutput", (*list_stages, _estimator("multi_tree"))),
        ModelSpec("listwise_dimensionwise_regression_no_search", "dimensionwise", (*list_stages, tree)),
    ]
    specs = {s.name: s for s in plain}
    tree_search = {**ITEM_SPACE, **SIDE_SPACE, **WITH_TARGET, **TREE_SPACE}
    searched = [
        ("regre_no_search", "regre_bayes_search", tree_search),
        ("pointwise_normalized_regression_no_search", "pointwise_normalized_regression_bayes_search",
         {**ITEM_SPACE, **SIDE_SPACE, **WITH_TARGET, **FOREST_SPACE}),
        ("pointwise_classification_no_search", "pointwise_classification_bayes_search",
         {**ITEM_SPACE, **SIDE_SPACE, **WITHOUT_TARGET, **TREE_SPACE}),
        ("pointwise_ordinal_regression_no_search", "pointwise_ordinal_regression_bayes_search",
         {**ITEM_SPACE, **SIDE_SPACE, **WITHOUT_TARGET, **TREE_SPACE}),
        ("listwise_multidimensional_regression_no_search", "listwise_multidimensional_regression_bayes_search",
         {**SIDE_SPACE, **WITHOUT_TARGET, **MULTI_TREE_SPACE}),
        ("listwise_dimensionwise_regression_no_search", "listwise_dimensionwise_regression_bayes_search",
         {**SIDE_SPACE, **WITHOUT_TARGET, **TREE_SPACE}),
    ]
    for base, name, space in searched:
        specs[name] = _with_search(specs[base], name, space)
    specs["pairwise_classification_optuna_search"] = _with_search(
        specs["pairwise_classification_no_search"], "pairwise_classification_optuna_search", PAIR_SPACE, "trial_search")
    specs["pointwise_regression_grid_search"] = _with_search(
        specs["pointwise_regression_no_search"], "pointwise_regression_grid_search", GRID_SPACE, "grid_search")
    return specs


SPECS = _build()

# Factor and item vectors under a scoring network, trained on the order of sampled lists.
LISTWISE_SCORER = ModelSpec("listwise_scorer", "list_network", (
    _estimator("list_network", length=32, lists=1, size=32, hidden=[256, 64], maxIter=100),))


def create(name: str) -> ModelSpec:
    """The specification of a name; an unknown name is an error that lists the known ones."""
    if name not in SPECS:
        raise ValueError(f"unknown model type {name!r}, expected one of {sorted(SPECS)}")
    return SPECS[name]
