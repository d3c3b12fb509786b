"""How each framing turns rows into training rows, and predictions back into one score per (group, item)."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.models.estimators import PerOutputEstimator
from rankloom.models.list_network import ListScorer
from rankloom.operators.encoders import OrdinalEncoder
from rankloom.operators.features import AssembleFeatures
from rankloom.operators.lists import sample_lists
from rankloom.operators.pairs import pairwise_target, wins_to_ranking
from rankloom.operators.relational import distinct_groups
from rankloom.operators.reshape import distinct_items, explode_lists, melt_target, pivot_target
from rankloom.operators.targets import GroupMinMax, RankBinarizer
from rankloom.plans.spec import ESTIMATOR, ModelSpec, Setting, load_fitted, save_fitted
from rankloom.session import packed

TIE, A_BETTER, B_BETTER = 0.0, 1.0, 2.0


class FittedSpec:
    """A fitted specification. ``predict`` adds ``prediction`` to rows that carry the factors and the item."""

    def __init__(self, framing: str, model: PipelineModel, factors: list[str], item: str, extra: dict):
        self.framing, self.model, self.factors, self.item, self.extra = framing, model, factors, item, extra

    def predict(self, df: DataFrame) -> DataFrame:
        keys = [*self.factors, self.item]
        if self.framing in ("regression", "normalized", "classification"):
            return self.model.transform(df).select(*df.columns, "prediction")
        if self.framing == "ordinal":
            steps = F.explode(F.sequence(F.lit(0), F.lit(self.extra["top"] - 1)))
            above = self.model.transform(df.select(*keys).withColumn("step", steps))
            scores = above.groupBy(*keys).agg(F.sum("prediction").alias("prediction"))
        elif self.framing == "pairwise":
            made = self.model.transform(item_pairs(df, self.factors, self.item))
            made = made.select(
                *self.factors, "item_a", "item_b",
                (F.col("prediction") == A_BETTER).cast("int").alias("a_better"),
                (F.col("prediction") == B_BETTER).cast("int").alias("b_better"),
            )
            scores = wins_to_ranking(made, self.factors, self.item, out="prediction")
            scores = scores.withColumn("prediction", F.col("prediction").cast("double"))
        elif self.framing in ("listwise", "list_network"):
            scores = self.model.transform(df.select(*keys)).select(*keys, "prediction")
        elif self.framing == "multioutput":
            items = F.array(*map(F.lit, self.extra["items"]))
            whole = self.model.transform(distinct_groups(df, self.factors))
            each = whole.select(*self.factors, F.explode(F.arrays_zip(items.alias("i"), F.col("prediction").alias("p"))).alias("_z"))
            scores = each.select(*self.factors, F.col("_z.i").cast(df.schema[self.item].dataType).alias(self.item),
                                 F.col("_z.p").alias("prediction"))
        else:  # dimensionwise
            items = self.extra["items"]
            wide = self.model.transform(distinct_groups(df, self.factors))
            wide = wide.select(*self.factors, *[
                F.col(f"`{PerOutputEstimator.prediction_name(f'out_{i}')}`").alias(name)
                for i, name in enumerate(items)
            ])
            scores = melt_target(wide, self.factors, items, self.item, "prediction")
        return df.join(scores, keys, "left")

    def save(self, path: str) -> None:
        save_fitted(self.model, f"{path}/model")
        about = {"framing": self.framing, "factors": self.factors, "item": self.item, "extra": self.extra}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(
            f"{path}/about"
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> FittedSpec:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        return FittedSpec(about["framing"], load_fitted(f"{path}/model"), about["factors"], about["item"],
                          about["extra"])


def item_pairs(df: DataFrame, factors: list[str], item: str) -> DataFrame:
    """The unordered item pairs of each group without looking at any target."""
    return pairwise_target(df.select(*factors, item).withColumn("_t", F.lit(0)), factors, item, "_t").select(
        *factors, "item_a", "item_b"
    )


def fit(spec: ModelSpec, train: DataFrame, where: Setting) -> FittedSpec:
    """Fit on training rows only; target statistics never see a held-out group."""
    rows = train.where(F.col(where.target).isNotNull())
    target, keys, extra = F.col(where.target).cast("double"), [*where.factors, where.item], {}
    if spec.framing in ("regression", "classification"):
        rows, item_in_rows = rows.withColumn("label", target), True
    elif spec.framing == "normalized":
        rows = GroupMinMax(where.target, where.factors).fit(rows).transform(rows, out="label")
        item_in_rows = True
    elif spec.framing == "ordinal":
        binarizer = RankBinarizer(where.target).fit(rows)
        extra, item_in_rows = {"top": binarizer.top}, True
        rows = rows.select(*keys, F.explode(binarizer.steps()).alias("_s")).select(
            *keys, F.col("_s.step").alias("step"), F.col("_s.above").cast("double").alias("label")
        )
    elif spec.framing == "pairwise":
        made = pairwise_target(rows, where.factors, where.item, where.target)
        label = F.when(F.col("a_better") == 1, A_BETTER).when(F.col("b_better") == 1, B_BETTER).otherwise(TIE)
        rows = made.select(*where.factors, "item_a", "item_b", label.alias("label"))
        item_in_rows = False
    elif spec.framing == "listwise":
        items = distinct_items(rows, where.item)
        wide = pivot_target(rows, where.factors, where.item, where.target, items)
        rows = melt_target(wide, where.factors, items, where.item, "label").withColumn(
            "label", F.col("label").cast("double"))
        item_in_rows = True
    elif spec.framing == "multioutput":
        return _fit_multioutput(spec, rows, where)
    elif spec.framing == "list_network":
        return _fit_list_network(spec, rows, where)
    else:
        return _fit_dimensionwise(spec, rows, where)
    stages = spec.build(where, "label", item_in_rows)
    if spec.framing == "ordinal":
        stages = [SQLTransformer(statement="SELECT *, CAST(step AS DOUBLE) AS f_step FROM __THIS__"), *stages]
    return FittedSpec(spec.framing, fit_stages(stages, rows), where.factors, where.item, extra)


def fit_stages(stages: list, rows: DataFrame) -> PipelineModel:
    """Fit the feature stages on the cached rows and the estimator on the cached feature vectors, so that neither the
    framing nor the features are computed again for every pass of the estimator."""
    *preparing, estimator = stages
    with packed(rows) as rows:
        prepared = Pipeline(stages=preparing).fit(rows)
        with packed(prepared.transform(rows).select("features", "label")) as vectors:
            fitted = estimator.fit(vectors)
    return PipelineModel(stages=[*prepared.stages, fitted])


def _fit_multioutput(spec: ModelSpec, rows: DataFrame, where: Setting) -> FittedSpec:
    """One model for the targets of all items, on one row per group."""
    items = distinct_items(rows, where.item)
    wide = pivot_target(rows, where.factors, where.item, where.target, items)
    wide = wide.select(*where.factors, F.array(*[F.col(f"`{i}`").cast("double") for i in items]).alias("label"))
    # The pivoted frame holds the factors only.
    stages = [p for s in spec.stages if s.kind != "keep" for p in s.build(where, None, False)]
    return FittedSpec("multioutput", fit_stages(stages, wide), where.factors, where.item, {"items": [str(i) for i in items]})


def _fit_list_network(spec: ModelSpec, rows: DataFrame, where: Setting) -> FittedSpec:
    """A scorer fitted on sampled lists of ``length`` items, ``lists`` for each group."""
    settings = dict(spec.estimator().settings)
    settings.pop("kind")
    length, lists, seed = settings.pop("length", 32), settings.pop("lists", 1), settings.get("seed", 0)
    drawn = sample_lists(rows, where.factors, where.item, where.target, length, lists, seed)
    flat = explode_lists(drawn, ["items", "ranks"]).withColumnsRenamed({"items": where.item, "ranks": where.target})
    codes = {c: f"_code_{c}" for c in [*where.factors, where.item]}
    scorer = ListScorer(factorCols=[codes[c] for c in where.factors], itemCol=codes[where.item], targetCol=where.target,
                        listCols=[*where.factors, "list_no"], **settings)
    stages = [*[OrdinalEncoder(inputCol=c, outputCol=o) for c, o in codes.items()], scorer]
    with packed(flat) as flat:
        model = Pipeline(stages=stages).fit(flat)
    return FittedSpec("list_network", model, where.factors, where.item, {})


def _fit_dimensionwise(spec: ModelSpec, rows: DataFrame, where: Setting) -> FittedSpec:
    """One model per item on one row per group."""
    items = distinct_items(rows, where.item)
    wide = pivot_target(rows, where.factors, where.item, where.target, items)
    outputs = [f"out_{i}" for i in range(len(items))]
    wide = wide.select(
        *where.factors, *[F.col(f"`{n}`").cast("double").alias(o) for n, o in zip(map(str, items), outputs)]
    )
    features = [s for s in spec.stages if s.kind != "keep"]  # the pivoted frame holds the factors only
    stages = [p for s in features if s.name != ESTIMATOR for p in s.build(where, None, False)] + [AssembleFeatures()]
    settings = dict(spec.estimator().settings)
    with packed(wide) as wide:
        prepared = Pipeline(stages=stages).fit(wide)
        per = PerOutputEstimator(settings.pop("kind"), outputs, **settings).fit(prepared.transform(wide))
    model = PipelineModel(stages=[*prepared.stages, *per.stages])
    return FittedSpec("dimensionwise", model, where.factors, where.item, {"items": [str(i) for i in items]})
