"""Registered queries: counts, coverage, missing values, histograms, reports and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators import metrics, profile, reshape
from rankloom.plans.catalog import query
from rankloom.plans.tables import (
    FACTOR_LIST, FACTORS, ITEM, METAFEATURES_CTE, META_COLUMNS, RANKED_CTE, REPORTS_CTE, RESULTS_CTE, metafeatures,
    ranked_results, results, score_reports, table,
)
from rankloom.plans.layout_queries import BRANDS


@query("a1_group_mean", """
SELECT l_returnflag, l_linestatus, ROUND(CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / COUNT(*), 6) AS mean
FROM lineitem GROUP BY 1, 2""")
def a1(spark, sf_dir):
    out = profile.group_mean(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "mean")
    return out.withColumn("mean", F.round("mean", 6))


@query("a2_s8_value_counts_by_group", f"""WITH {RANKED_CTE}
SELECT model, tuning, scoring, rank, COUNT(*) AS count FROM ranked GROUP BY 1, 2, 3, 4""")
def a2(spark, sf_dir):
    return profile.value_counts(ranked_results(spark, sf_dir), "rank", ["model", "tuning", "scoring"])


@query("a3_value_counts", "SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type")
def a3(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type", ordered=True)


@query("a4_distinct_report", """
SELECT 'user_id' AS "column", COUNT(DISTINCT user_id) AS distinct_values FROM events
UNION ALL SELECT 'event_type', COUNT(DISTINCT event_type) FROM events
UNION ALL SELECT 'value', COUNT(DISTINCT value) FROM events""")
def a4(spark, sf_dir):
    return profile.distinct_report(table(spark, sf_dir, "events"), ["user_id", "event_type", "value"])


@query("a4_distinct_values", """
SELECT DISTINCT 'event_type' AS "column", event_type AS value FROM events
UNION ALL SELECT DISTINCT 'user_id', CAST(user_id AS VARCHAR) FROM events""")
def a4_values(spark, sf_dir):
    return profile.distinct_values(table(spark, sf_dir, "events"), ["event_type", "user_id"])


@query("a4_distinct_lists", f"""WITH {RESULTS_CTE}
SELECT model, string_agg(DISTINCT encoder, ',' ORDER BY encoder) AS encoders FROM results GROUP BY model""")
def a4_lists(spark, sf_dir):
    per = results(spark, sf_dir).groupBy("model").agg(F.array_sort(F.collect_set(ITEM)).alias("encoders"))
    return per.withColumn("encoders", F.array_join("encoders", ","))


@query("a5_coverage", f"""WITH {RESULTS_CTE}
SELECT (SELECT COUNT(*) FROM (SELECT DISTINCT {FACTOR_LIST} FROM results)) AS observed,
  COUNT(DISTINCT dataset) * COUNT(DISTINCT model) * COUNT(DISTINCT tuning) * COUNT(DISTINCT scoring) AS possible,
  ROUND((SELECT COUNT(*) FROM (SELECT DISTINCT {FACTOR_LIST} FROM results)) /
    (COUNT(DISTINCT dataset) * COUNT(DISTINCT model) * COUNT(DISTINCT tuning) * COUNT(DISTINCT scoring)), 9) AS ratio
FROM results""")
def a5(spark, sf_dir):
    return profile.coverage(results(spark, sf_dir), FACTORS).withColumn("ratio", F.round("ratio", 9))


NULL_RATIO_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (COUNT(*) - COUNT({c})) / COUNT(*) AS null_ratio FROM meta""" for c in META_COLUMNS)


@query("a6_null_ratio_by_column", f"""WITH {METAFEATURES_CTE}
SELECT "column", ROUND(null_ratio, 9) AS null_ratio FROM ({NULL_RATIO_SQL}) WHERE null_ratio >= 0.25""")
def a6(spark, sf_dir):
    out = profile.null_ratio_by_column(metafeatures(spark, sf_dir), META_COLUMNS, threshold=0.25)
    return out.withColumn("null_ratio", F.round("null_ratio", 9))


@query("a7_null_ratio_by_row", f"""WITH {METAFEATURES_CTE}
SELECT dataset, {" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in META_COLUMNS)} AS nulls,
  ROUND(({" + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in META_COLUMNS)}) / 8.0::DOUBLE, 9) AS null_ratio
FROM meta""")
def a7(spark, sf_dir):
    out = profile.null_ratio_by_row(metafeatures(spark, sf_dir), ["dataset"], META_COLUMNS)
    return out.withColumn("null_ratio", F.round("null_ratio", 9)).orderBy(F.desc("null_ratio"), "dataset")


@query("a8_null_ratio_overall", f"""WITH {METAFEATURES_CTE}
SELECT 8 * COUNT(*) - ({" + ".join(f"COUNT({c})" for c in META_COLUMNS)}) AS nulls, 8 * COUNT(*) AS cells,
  ROUND((8 * COUNT(*) - ({" + ".join(f"COUNT({c})" for c in META_COLUMNS)})) / (8 * COUNT(*)), 9) AS null_ratio FROM meta""")
def a8(spark, sf_dir):
    out = profile.null_ratio_overall(metafeatures(spark, sf_dir), META_COLUMNS)
    return out.withColumn("null_ratio", F.round("null_ratio", 9))


GRID_CTE = RESULTS_CTE + f""",
grid AS (
  SELECT g.dataset, g.model, g.tuning, g.scoring, i.encoder, r.cv_score
  FROM (SELECT DISTINCT {FACTOR_LIST} FROM results) g CROSS JOIN (SELECT DISTINCT encoder FROM results) i
  LEFT JOIN results r USING ({FACTOR_LIST}, encoder))"""


def _grid(spark, sf_dir):
    return reshape.complete_grid(results(spark, sf_dir), FACTORS, ITEM, "cv_score", BRANDS)


LEVELS = ["dataset", "model", "tuning", "scoring", "encoder"]


@query("a9_null_ratio_by_level", f"WITH {GRID_CTE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS factor, CAST({c} AS VARCHAR) AS level, COUNT(*) AS cells, COUNT(*) - COUNT(cv_score) AS nulls,
        ROUND((COUNT(*) - COUNT(cv_score)) / COUNT(*), 9) AS null_ratio FROM grid GROUP BY {c}""" for c in LEVELS))
def a9(spark, sf_dir):
    out = profile.null_ratio_by_level(_grid(spark, sf_dir), LEVELS, "cv_score")
    return out.withColumn("null_ratio", F.round("null_ratio", 9))


@query("a10_null_ratio_by_item_level", f"""WITH {GRID_CTE}
SELECT encoder, scoring, COUNT(*) AS cells, COUNT(*) - COUNT(cv_score) AS nulls,
  ROUND((COUNT(*) - COUNT(cv_score)) / COUNT(*), 9) AS null_ratio FROM grid GROUP BY 1, 2
HAVING (COUNT(*) - COUNT(cv_score)) / COUNT(*) >= 0.1""")
def a10(spark, sf_dir):
    out = profile.null_ratio_by_item_level(_grid(spark, sf_dir), ITEM, "scoring", "cv_score", threshold=0.1)
    return out.withColumn("null_ratio", F.round("null_ratio", 9))


@query("a11_columns_sharing_ratio", f"""WITH {METAFEATURES_CTE}, r AS ({NULL_RATIO_SQL})
SELECT ROUND(null_ratio, 9) AS null_ratio, COUNT(*) AS columns FROM r GROUP BY 1""")
def a11(spark, sf_dir):
    ratios = profile.null_ratio_by_column(metafeatures(spark, sf_dir), META_COLUMNS)
    return profile.columns_sharing_ratio(ratios.withColumn("null_ratio", F.round("null_ratio", 9)))


@query("a13_mean_and_spread", f"""WITH {REPORTS_CTE}
SELECT approach, metric, ROUND(AVG(score), 9) AS mean, ROUND(STDDEV_POP(score), 9) AS std FROM reports GROUP BY 1, 2""")
def a13(spark, sf_dir):
    out = profile.mean_and_spread(score_reports(spark, sf_dir), ["approach", "metric"], "score")
    return out.withColumns({c: F.round(c, 9) for c in ("mean", "std")})


@query("a14_mean_skipping_nulls", f"""WITH {METAFEATURES_CTE}
SELECT ROUND(AVG(min_price), 6) AS mean, COUNT(min_price) AS used, COUNT(*) AS all_rows FROM meta""")
def a14(spark, sf_dir):
    return metafeatures(spark, sf_dir).agg(
        F.round(F.avg("min_price"), 6).alias("mean"), F.count("min_price").alias("used"),
        F.count(F.lit(1)).alias("all_rows"),
    )


@query("a15_score_report", f"""WITH {REPORTS_CTE}
SELECT approach, ROUND(AVG(score), 9) AS score, ROUND(AVG(runtime), 9) AS runtime,
  CASE approach WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END AS position FROM reports
WHERE metric = 'spearman' GROUP BY approach""")
def a15(spark, sf_dir):
    spearman = score_reports(spark, sf_dir).where("metric = 'spearman'")
    out = profile.score_report(spearman, "approach", ["score", "runtime"], ["R", "A", "N"])
    return out.withColumns({c: F.round(c, 9) for c in ("score", "runtime")})


@query("a16_summary_statistics", " UNION ALL ".join(
    f"SELECT '{name}' AS statistic, ROUND({expr}, 6) AS value FROM events" for name, expr in {
        "count": "CAST(COUNT(value) AS DOUBLE)", "mean": "AVG(value)", "std": "STDDEV_SAMP(value)",
        "min": "MIN(value)", "max": "MAX(value)", "25%": "QUANTILE_CONT(value, 0.25)",
        "50%": "QUANTILE_CONT(value, 0.5)", "75%": "QUANTILE_CONT(value, 0.75)"}.items()))
def a16(spark, sf_dir):
    out = profile.summary_statistics(table(spark, sf_dir, "events").select("value"), "value")
    return out.withColumn("value", F.round("value", 6))


@query("a17_histogram", """
WITH edge AS (SELECT MIN(value) AS lo, (MAX(value) - MIN(value)) / 50 AS width FROM events),
counted AS (SELECT LEAST(CAST(FLOOR((value - lo) / width) AS INTEGER), 49) AS bin, COUNT(*) AS count
            FROM events, edge GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, ROUND(lo + b.bin * width, 6) AS "from", COALESCE(count, 0) AS count
FROM (SELECT UNNEST(RANGE(50)) AS bin) b CROSS JOIN edge LEFT JOIN counted c ON b.bin = c.bin""")
def a17(spark, sf_dir):
    out = profile.histogram(table(spark, sf_dir, "events").select("value"), "value")
    return out.withColumn("from", F.round("from", 6))


@query("a18_compare_configurations", f"""WITH {REPORTS_CTE}
SELECT approach, tuning, ROUND(AVG(score), 9) AS mean_score, COUNT(score) AS folds FROM reports
WHERE metric = 'ndcg' GROUP BY 1, 2""")
def a18(spark, sf_dir):
    reports = score_reports(spark, sf_dir)
    out = profile.compare_configurations(reports, ["approach", "tuning"], "score", {"metric": "ndcg"})
    return out.withColumn("mean_score", F.round("mean_score", 9))


@query("o3_a18_best_configuration", f"""WITH {REPORTS_CTE}, means AS (
  SELECT metric, approach, tuning, ROUND(AVG(score), 9) AS mean_score FROM reports GROUP BY 1, 2, 3)
SELECT metric, approach, tuning, mean_score FROM means
QUALIFY ROW_NUMBER() OVER (PARTITION BY metric ORDER BY mean_score DESC, approach, tuning) = 1""")
def o3(spark, sf_dir):
    means = score_reports(spark, sf_dir).groupBy("metric", "approach", "tuning").agg(
        F.round(F.avg("score"), 9).alias("mean_score")
    )
    return profile.best_by(means, "mean_score", ["metric"], tie=["approach", "tuning"])


@query("o3_best_item_by_group", f"""WITH {RESULTS_CTE}
SELECT {FACTOR_LIST}, encoder, cv_score FROM results
QUALIFY ROW_NUMBER() OVER (PARTITION BY {FACTOR_LIST} ORDER BY cv_score DESC, encoder) = 1""")
def o3_item(spark, sf_dir):
    rows = results(spark, sf_dir).drop("pred")
    return profile.best_by(rows, "cv_score", FACTORS, tie=[ITEM])


@query("a19_regression_metrics", f"""WITH {RESULTS_CTE},
pairs AS (SELECT cv_score / 1e6 AS y, AVG(cv_score / 1e6) OVER (PARTITION BY model, tuning) AS p FROM results)
SELECT ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS rmse, ROUND(AVG(ABS(y - p)), 6) AS mae,
       ROUND(1 - AVG((y - p) * (y - p)) / VAR_POP(y), 6) AS r2 FROM pairs""")
def a19(spark, sf_dir):
    rows = results(spark, sf_dir).select("model", "tuning", (F.col("cv_score") / 1e6).alias("y"))
    means = rows.groupBy("model", "tuning").agg(F.avg("y").alias("p"))
    out = metrics.regression_metrics(rows.join(means, ["model", "tuning"]), "y", "p")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


@query("a20_classification_metrics", """
WITH pairs AS (SELECT l_linenumber AS y, CAST(l_quantity AS INTEGER) % 8 AS p FROM lineitem),
cells AS (SELECT y, p, CAST(COUNT(*) AS DOUBLE) AS n FROM pairs GROUP BY 1, 2),
classes AS (SELECT DISTINCT y AS c FROM pairs UNION SELECT DISTINCT p FROM pairs),
per AS (SELECT c, COALESCE((SELECT SUM(n) FROM cells WHERE y = c), 0) AS t,
               COALESCE((SELECT SUM(n) FROM cells WHERE p = c), 0) AS q,
               COALESCE((SELECT SUM(n) FROM cells WHERE y = c AND p = c), 0) AS hit FROM classes)
SELECT ROUND(SUM(hit) / SUM(t), 9) AS accuracy, ROUND(AVG(2 * hit / (t + q)), 9) AS macro_f1,
  ROUND((SUM(hit) * SUM(t) - SUM(t * q))
    / SQRT((SUM(t) * SUM(t) - SUM(q * q)) * (SUM(t) * SUM(t) - SUM(t * t))), 9) AS mcc FROM per""")
def a20(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("y"), (F.col("l_quantity").cast("int") % 8).alias("p")
    )
    out = metrics.classification_metrics(rows, "y", "p")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])
