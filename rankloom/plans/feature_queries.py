"""Registered queries: encoders, feature preparation, target transforms and splits."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankloom.operators import encoders, features, splits, targets
from rankloom.plans.catalog import query
from rankloom.plans.layout_queries import BRANDS, WIDE_CTE
from rankloom.plans.tables import (
    FACTOR_LIST, FACTORS, ITEM, KEYS, METAFEATURES_CTE, META_COLUMNS, RANKED_CTE, RESULTS_CTE, metafeatures,
    ranked_results, results, table,
)


def _codes(column: str, source: str = "results") -> str:
    return f"(SELECT {column}, CAST(ROW_NUMBER() OVER (ORDER BY {column}) AS INTEGER) AS code FROM (SELECT DISTINCT {column} FROM {source}))"


@query("f1_ordinal_encoder", f"""WITH {RESULTS_CTE}
SELECT {FACTOR_LIST}, encoder, COALESCE(c.code, -1) AS f_model FROM results LEFT JOIN
  {_codes("model", "(SELECT * FROM results WHERE dataset < 5 AND model <> 'BUILDING')")} c USING (model)""")
def f1(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS)
    train = rows.where("dataset < 5 AND model <> 'BUILDING'")
    return encoders.OrdinalEncoder(inputCol="model", outputCol="f_model").fit(train).transform(rows)


EVENT_TYPES = "(SELECT event_type, ROW_NUMBER() OVER (ORDER BY event_type) AS code FROM (SELECT DISTINCT event_type FROM events))"


@query("f2_one_hot_columns", f"""
SELECT e.event_id, e.event_type, {", ".join(f"CASE WHEN c.code = {i} THEN 1 ELSE 0 END AS f_type_{i}" for i in range(1, 6))}
FROM events e JOIN {EVENT_TYPES} c USING (event_type)""")
def f2(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return encoders.OneHotColumns(inputCol="event_type", outputCol="f_type").fit(events).transform(events)


@query("f3_binary_encoder", f"""WITH {RESULTS_CTE}
SELECT {FACTOR_LIST}, encoder, {", ".join(f"(c.code >> {4 - i}) & 1 AS f_encoder_{i}" for i in range(5))}
FROM results JOIN {_codes("encoder")} c USING (encoder)""")
def f3(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS)
    return encoders.BinaryEncoder(inputCol="encoder", outputCol="f_encoder").fit(rows).transform(rows)


def _target_sql(column: str) -> str:
    return f"""SELECT {column}, w * s / n + (1 - w) * prior AS value FROM (
  SELECT {column}, CAST(SUM(rank) AS DOUBLE) AS s, COUNT(*) AS n, 1 / (1 + EXP(-(COUNT(*) - 20) / 10.0::DOUBLE)) AS w
  FROM ranked GROUP BY {column}), (SELECT CAST(SUM(rank) AS DOUBLE) / COUNT(*) AS prior FROM ranked)"""


@query("f4_smoothed_target_encoder", f"""WITH {RANKED_CTE}
SELECT {FACTOR_LIST}, encoder, ROUND(value, 6) AS f_encoder FROM ranked JOIN ({_target_sql("encoder")}) USING (encoder)""")
def f4(spark, sf_dir):
    rows = ranked_results(spark, sf_dir)
    model = encoders.SmoothedTargetEncoder(inputCol="encoder", outputCol="f_encoder", labelCol="rank").fit(rows)
    return model.transform(rows).select(*KEYS, F.round("f_encoder", 6).alias("f_encoder"))


@query("f6_mixed_model_encoder", """WITH RECURSIVE
lv AS (SELECT l_quantity, COUNT(*) AS n, AVG(l_extendedprice) AS m, VAR_POP(l_extendedprice) AS v FROM lineitem GROUP BY l_quantity),
tot AS (SELECT SUM(n) AS rows, COUNT(*) AS levels, SUM(n * v) AS within FROM lv),
em(step, mu, su, se) AS (
  SELECT 0, mu, (SELECT AVG((m - mu) * (m - mu)) FROM lv), within / rows FROM tot, (SELECT SUM(n * m) / SUM(n) AS mu FROM lv)
  UNION ALL
  SELECT step + 1, SUM(n * (m - share * (m - mu))) / rows, SUM(share * share * (m - mu) * (m - mu) + spread) / levels,
    (within + SUM(n * ((1 - share) * (1 - share) * (m - mu) * (m - mu) + spread))) / rows
  FROM (SELECT *, n * su / (n * su + se) AS share, su * se / (n * su + se) AS spread FROM em, lv, tot WHERE step < 1500)
  GROUP BY step, rows, levels, within)
SELECT l_quantity, ROUND(n * su / (n * su + se) * (m - mu), 3) AS f_quantity
FROM lv, (SELECT * FROM em ORDER BY step DESC LIMIT 1)""")
def f6_mixed(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    model = encoders.MixedModelEncoder(inputCol="l_quantity", outputCol="f_quantity", labelCol="l_extendedprice").fit(rows)
    return model.transform(rows.select("l_quantity").distinct()).select("l_quantity", F.round("f_quantity", 3).alias("f_quantity"))


@query("f5_factor_encoders", f"""WITH {RANKED_CTE}
SELECT dataset, encoder, m.code AS f_model, ROUND(t.value, 6) AS f_tuning,
  {", ".join(f"CASE WHEN s.code = {i} THEN 1 ELSE 0 END AS f_scoring_{i}" for i in (1, 2, 3))}
FROM ranked JOIN {_codes("model")} m USING (model) JOIN ({_target_sql("tuning")}) t USING (tuning)
JOIN {_codes("scoring")} s USING (scoring) JOIN {_codes("dataset")} d USING (dataset)
JOIN {_codes("encoder")} e USING (encoder)""")
def f5(spark, sf_dir):
    rows = ranked_results(spark, sf_dir)
    stages = encoders.factor_encoders({"model": "ordinal", "tuning": "target", "scoring": "onehot"}, "rank")
    out = Pipeline(stages=[*stages, features.DropColumns(inputCols=["model", "tuning", "scoring"])]).fit(rows).transform(rows)
    return out.select("dataset", "encoder", "f_model", F.round("f_tuning", 6).alias("f_tuning"),
                      "f_scoring_1", "f_scoring_2", "f_scoring_3")


KEPT_META = [c for c in META_COLUMNS if c not in ("min_price",)]
SCALED = ", ".join(
    f"""ROUND((COALESCE({c}, m_{c}) - m_{c}) / NULLIF(s_{c}, 0), 6) AS dataset_metafeature_{i}"""
    for i, c in enumerate(KEPT_META))
SCALED_CTE = f"""mean_of AS (SELECT {", ".join(f"AVG({c}) AS m_{c}" for c in KEPT_META)} FROM meta),
std_of AS (SELECT {", ".join(f"STDDEV_POP(COALESCE({c}, m_{c})) AS s_{c}" for c in KEPT_META)} FROM meta, mean_of),
scaled AS (SELECT dataset, {SCALED} FROM meta, mean_of, std_of)"""


@query("f8_side_table_features", f"""WITH {RESULTS_CTE}, {METAFEATURES_CTE}, {SCALED_CTE}
SELECT dataset, model, tuning, scoring, encoder, {", ".join(f"dataset_metafeature_{i}" for i in range(len(KEPT_META)))}
FROM results LEFT JOIN scaled USING (dataset)""")
def f8(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS)
    stage = features.SideTableFeatures(threshold=0.4, variance=1.0).on(metafeatures(spark, sf_dir))
    out = stage.fit(rows).transform(rows)
    return out.select(*KEYS, *[F.round(c, 6).alias(c) for c in out.columns if c not in KEYS])


@query("f9_mean_imputer", f"""WITH {METAFEATURES_CTE}
SELECT dataset, ROUND(COALESCE(share_o, AVG(share_o) OVER ()), 9) AS share_o,
       ROUND(COALESCE(min_price, AVG(min_price) OVER ()), 6) AS min_price FROM meta""")
def f9(spark, sf_dir):
    meta = metafeatures(spark, sf_dir).select("dataset", "share_o", "min_price")
    out = features.MeanImputer(inputCols=["share_o", "min_price"]).fit(meta).transform(meta)
    return out.withColumns({"share_o": F.round("share_o", 9), "min_price": F.round("min_price", 6)})


@query("f10_population_scaler", """
SELECT l_orderkey, l_linenumber,
  ROUND((l_quantity - (SELECT AVG(l_quantity) FROM lineitem)) / (SELECT STDDEV_POP(l_quantity) FROM lineitem), 6) AS l_quantity
FROM lineitem""")
def f10(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out = features.PopulationScaler(inputCols=["l_quantity"]).fit(line).transform(line)
    return out.withColumn("l_quantity", F.round("l_quantity", 6))


@query("f11_principal_components")
def f11(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS)
    stage = features.SideTableFeatures(threshold=0.4, variance=0.6).on(metafeatures(spark, sf_dir))
    return stage.fit(rows).transform(rows)


@query("f12_one_hot_baseline", f"""WITH {RESULTS_CTE}
SELECT dataset, encoder, {", ".join(f"CASE WHEN m.code = {i} THEN 1 ELSE 0 END AS f_model_{i}" for i in range(1, 6))},
  {", ".join(f"CASE WHEN d.code = {i} THEN 1 ELSE 0 END AS f_dataset_{i}" for i in range(1, 26))},
  {", ".join(f"CASE WHEN e.code = {i} THEN 1 ELSE 0 END AS f_encoder_{i}" for i in range(1, 26))},
  {", ".join(f"CASE WHEN t.code = {i} THEN 1 ELSE 0 END AS f_tuning_{i}" for i in (1, 2, 3))},
  {", ".join(f"CASE WHEN s.code = {i} THEN 1 ELSE 0 END AS f_scoring_{i}" for i in (1, 2, 3))}
FROM results JOIN {_codes("model")} m USING (model) JOIN {_codes("tuning")} t USING (tuning)
JOIN {_codes("scoring")} s USING (scoring) JOIN {_codes("dataset")} d USING (dataset)
JOIN {_codes("encoder")} e USING (encoder)""")
def f12(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS)
    stages = encoders.factor_encoders(dict.fromkeys(KEYS, "onehot"))
    return Pipeline(stages=stages).fit(rows).transform(rows).drop("model", "tuning", "scoring")


@query("f14_normalised_multi_hot", """
WITH norm AS (SELECT AVG(value) AS m, STDDEV_POP(value) AS s FROM events)
SELECT event_id, ROUND((value - m) / s, 6) AS v0,
  """ + ", ".join(f"CASE WHEN code = {i} THEN 1.0 ELSE 0.0 END::DOUBLE AS v{i}" for i in range(1, 6)) + """
FROM (SELECT *, DENSE_RANK() OVER (ORDER BY event_type) AS code FROM events), norm""")
def f14(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    names = ["value", *[f"f_type_{i}" for i in range(1, 6)]]
    stages = [
        features.PopulationScaler(inputCols=["value"]),
        encoders.OneHotColumns(inputCol="event_type", outputCol="f_type"),
        VectorAssembler(inputCols=names, outputCol="features"),
    ]
    cells = vector_to_array("features")
    return Pipeline(stages=stages).fit(events).transform(events).select(
        "event_id", F.round(cells[0], 6).alias("v0"), *[cells[i].alias(f"v{i}") for i in range(1, 6)]
    )


MINMAX_SQL = f"""WITH {RESULTS_CTE}, edge AS (
  SELECT {FACTOR_LIST}, MIN(cv_score) AS lo, MAX(cv_score) AS hi FROM results GROUP BY {FACTOR_LIST})
SELECT {FACTOR_LIST}, encoder, ROUND(CASE WHEN hi = lo THEN 0 ELSE (cv_score - lo) / (hi - lo) END, 9) AS cv_score
FROM results JOIN edge USING ({FACTOR_LIST})"""


@query("t2_group_min_max", MINMAX_SQL)
def t2(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS, "cv_score")
    return targets.GroupMinMax("cv_score", FACTORS).fit(rows).transform(rows).withColumn("cv_score", F.round("cv_score", 9))


@query("t2_group_min_max_inverse", f"WITH {RESULTS_CTE} SELECT {FACTOR_LIST}, encoder, ROUND(cv_score / 1e6, 9) AS cv_score FROM results")
def t2_inverse(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS, (F.col("cv_score") / 1e6).alias("cv_score"))
    model = targets.GroupMinMax("cv_score", FACTORS).fit(rows)
    return model.inverse(model.transform(rows)).withColumn("cv_score", F.round("cv_score", 9))


@query("t1_group_standard", f"""WITH {RESULTS_CTE}, edge AS (
  SELECT model, tuning, AVG(pred) AS m, STDDEV_POP(pred) AS s FROM results GROUP BY 1, 2)
SELECT {FACTOR_LIST}, encoder, ROUND((pred - m) / s, 6) AS pred FROM results JOIN edge USING (model, tuning)""")
def t1(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS, "pred")
    model = targets.GroupwiseTarget("pred", ["model", "tuning"], "standard").fit(rows)
    return model.transform(rows).withColumn("pred", F.round("pred", 6))


@query("t3_rank_binarizer", f"""WITH {RANKED_CTE}
SELECT {FACTOR_LIST}, encoder, {", ".join(f"CASE WHEN rank > {i} THEN 1 ELSE 0 END AS rank_{i}" for i in range(24))} FROM ranked""")
def t3(spark, sf_dir):
    rows = ranked_results(spark, sf_dir).select(*KEYS, "rank")
    return targets.RankBinarizer("rank", top=len(BRANDS) - 1).fit(rows).transform(rows)


@query("t3_rank_binarizer_inverse", f"WITH {RANKED_CTE} SELECT {FACTOR_LIST}, encoder, rank FROM ranked")
def t3_inverse(spark, sf_dir):
    rows = ranked_results(spark, sf_dir).select(*KEYS, "rank")
    model = targets.RankBinarizer("rank").fit(rows)
    return model.inverse(model.transform(rows))


@query("t4_target_one_hot", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_orderstatus_1,
  CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS o_orderstatus_2,
  CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS o_orderstatus_3 FROM orders""")
def t4(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return targets.TargetOneHot("o_orderstatus").fit(orders).transform(orders)


@query("t4_target_one_hot_inverse", "SELECT o_orderkey, o_orderstatus FROM orders")
def t4_inverse(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    model = targets.TargetOneHot("o_orderstatus").fit(orders)
    return model.inverse(model.transform(orders))


@query("t5_target_pivot_inverse", f"""WITH {WIDE_CTE}
SELECT {FACTOR_LIST}, encoder, rank FROM (UNPIVOT filled ON {", ".join(f'"{b}"' for b in BRANDS)} INTO NAME encoder VALUE rank)""")
def t5(spark, sf_dir):
    rows = ranked_results(spark, sf_dir).select(*KEYS, "rank")
    model = targets.TargetPivot(FACTORS, ITEM, "rank").fit(rows)
    return model.inverse(model.transform(rows))


SPLIT_CTE = f"""
placed AS (
  SELECT {FACTOR_LIST}, COUNT(*) OVER (PARTITION BY dataset) AS n,
    ROW_NUMBER() OVER (PARTITION BY dataset ORDER BY md5(concat_ws('|', '7', {FACTOR_LIST})), {FACTOR_LIST}) AS rn
  FROM (SELECT DISTINCT {FACTOR_LIST} FROM results))"""


@query("v1_group_split", f"""WITH {RESULTS_CTE}, {SPLIT_CTE}
SELECT {FACTOR_LIST}, encoder, cv_score, rn <= ROUND(n * 0.75) AS is_train FROM results JOIN placed USING ({FACTOR_LIST})""")
def v1(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS, "cv_score")
    return splits.group_split(rows, FACTORS, ["dataset"], 0.75, seed=7)


@query("v2_row_split", """
SELECT event_id, ('0x' || substr(md5(concat_ws('|', '42', event_id)), 1, 8))::BIGINT % 1000 < 800 AS is_train FROM events""")
def v2(spark, sf_dir):
    return splits.row_split(table(spark, sf_dir, "events").select("event_id"), "event_id")


@query("v3_group_kfold", f"""WITH {RESULTS_CTE}, placed AS (
  SELECT {FACTOR_LIST}, CAST((ROW_NUMBER() OVER (ORDER BY md5(concat_ws('|', '0', {FACTOR_LIST})), {FACTOR_LIST}) - 1) % 5
                             AS INTEGER) AS fold
  FROM (SELECT DISTINCT {FACTOR_LIST} FROM results))
SELECT {FACTOR_LIST}, encoder, fold FROM results JOIN placed USING ({FACTOR_LIST})""")
def v3(spark, sf_dir):
    return splits.group_kfold(results(spark, sf_dir).select(*KEYS), FACTORS, 5)


@query("v3_group_kfold_in_order", f"""WITH {RESULTS_CTE}, placed AS (
  SELECT {FACTOR_LIST}, CAST(NTILE(4) OVER (ORDER BY {FACTOR_LIST}) - 1 AS INTEGER) AS fold
  FROM (SELECT DISTINCT {FACTOR_LIST} FROM results))
SELECT {FACTOR_LIST}, encoder, fold FROM results JOIN placed USING ({FACTOR_LIST})""")
def v3_sorted(spark, sf_dir):
    return splits.group_kfold(results(spark, sf_dir).select(*KEYS), FACTORS, 4, seed=None)
