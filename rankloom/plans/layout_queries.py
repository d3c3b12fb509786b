"""Registered queries: projections, filters, joins, unions and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.functions import indicator, percent_text
from rankloom.operators import lists, pairs, relational as rel, reshape
from rankloom.plans.catalog import query
from rankloom.plans.tables import (
    FACTOR_LIST, FACTORS, ITEM, KEYS, METAFEATURES_CTE, RANKED_CTE, REPORTS_CTE, RESULTS_CTE,
    metafeatures, ranked_results, results, score_reports, table,
)
from rankloom.sources.readers import attach_target, read_results, spread_features

BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))
FACTOR_JOIN = " AND ".join(f"a.{f} = b.{f}" for f in FACTORS)
ORDER_COLUMNS = {
    "o_orderkey": "row_id", "o_custkey": "dataset", "o_orderstatus": "model", "o_orderpriority": "tuning",
    "o_totalprice": "cv_score",
}


@query("s1_read_results", """
SELECT o_orderkey AS row_id, o_custkey AS dataset, o_orderstatus AS model, o_orderpriority AS tuning,
       o_totalprice AS cv_score FROM orders""")
def s1(spark, sf_dir):
    return read_results(spark, f"{sf_dir}/orders.parquet", fmt="parquet", columns=ORDER_COLUMNS)


@query("s3_attach_target", """
SELECT a.event_id, a.user_id, a.event_type, b.value FROM events a JOIN
  (SELECT event_id, value FROM events WHERE event_id % 2 = 0 OR value > 1) b ON a.event_id = b.event_id""")
def s3(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    target = events.where((F.col("event_id") % 2 == 0) | (F.col("value") > 1)).select("event_id", "value")
    return attach_target(events.select("event_id", "user_id", "event_type", "value"), target, "event_id", "value")


@query("s4_unlabeled_results", """
SELECT o_orderkey AS row_id, o_custkey AS dataset, o_orderstatus AS model, o_orderpriority AS tuning FROM orders""")
def s4(spark, sf_dir):
    columns = {old: new for old, new in ORDER_COLUMNS.items() if new != "cv_score"}
    return read_results(spark, f"{sf_dir}/orders.parquet", fmt="parquet", columns=columns)


@query("s6_metafeatures_wide", f"""WITH {METAFEATURES_CTE},
long AS (SELECT dataset, 'n_orders' AS name, n_orders AS value FROM meta
         UNION ALL SELECT dataset, 'share_f', share_f FROM meta UNION ALL SELECT dataset, 'share_o', share_o FROM meta)
SELECT dataset, MAX(value) FILTER (name = 'n_orders') AS n_orders, ROUND(MAX(value) FILTER (name = 'share_f'), 9) AS share_f,
       ROUND(MAX(value) FILTER (name = 'share_o'), 9) AS share_o FROM long GROUP BY dataset""")
def s6(spark, sf_dir):
    names = ["n_orders", "share_f", "share_o"]
    long = metafeatures(spark, sf_dir).unpivot(["dataset"], names, "name", "value")
    wide = spread_features(long, "dataset", "name", "value", names)
    return wide.withColumns({c: F.round(c, 9) for c in names[1:]})


@query("p1_keep_columns", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def p1(spark, sf_dir):
    return rel.keep_columns(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])


@query("p2_drop_columns", "SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def p2(spark, sf_dir):
    return rel.drop_columns(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal"])


@query("p3_distinct_groups", f"WITH {RESULTS_CTE} SELECT DISTINCT {FACTOR_LIST} FROM results")
def p3(spark, sf_dir):
    return rel.distinct_groups(results(spark, sf_dir), FACTORS)


@query("p4_contiguous_groups", f"WITH {RESULTS_CTE} SELECT {FACTOR_LIST}, encoder, cv_score FROM results")
def p4(spark, sf_dir):
    return rel.contiguous_groups(results(spark, sf_dir).select(*KEYS, "cv_score"), FACTORS, [ITEM])


@query("p5_split_target", f"WITH {RESULTS_CTE} SELECT {FACTOR_LIST}, encoder, pred FROM results")
def p5(spark, sf_dir):
    features, _ = rel.split_target(results(spark, sf_dir), "cv_score")
    return features


@query("p6_drop_for_prediction", f"WITH {RESULTS_CTE} SELECT {FACTOR_LIST}, pred FROM results")
def p6(spark, sf_dir):
    return rel.drop_for_prediction(results(spark, sf_dir), ["cv_score", "rank"], ITEM)


@query("p7_where_given", "SELECT * FROM events WHERE event_type = 'click' AND user_id = 8")
def p7(spark, sf_dir):
    return rel.where_given(table(spark, sf_dir, "events"), event_type="click", user_id=8, value=None)


@query("p8_isin_isnull", f"""WITH {METAFEATURES_CTE} SELECT dataset, n_orders FROM meta
WHERE share_o IS NULL OR dataset IN (1, 2, 3)""")
def p8(spark, sf_dir):
    meta = metafeatures(spark, sf_dir)
    return meta.where(F.col("share_o").isNull() | F.col("dataset").isin(1, 2, 3)).select("dataset", "n_orders")


@query("p9_groups_covering_all", f"""WITH {RESULTS_CTE}
SELECT {FACTOR_LIST}, encoder, cv_score FROM results WHERE concat_ws(' ', {FACTOR_LIST}) IN (
  SELECT concat_ws(' ', {FACTOR_LIST}) FROM results GROUP BY {FACTOR_LIST}
  HAVING COUNT(DISTINCT encoder) = (SELECT COUNT(DISTINCT encoder) FROM results))""")
def p9(spark, sf_dir):
    keyed = reshape.with_group_key(results(spark, sf_dir).select(*KEYS, "cv_score"), FACTORS, "_key")
    return rel.groups_covering_all(keyed, "_key", ITEM).drop("_key")


@query("p10_replace_values", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'press' WHEN 'error' THEN 'fault' ELSE event_type END AS event_type
FROM events""")
def p10_replace(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rel.replace_values(events, {"click": "press", "error": "fault"}, ["event_type"])


@query("p10_map_values", """
SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 END AS code FROM events""")
def p10_map(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rel.map_values(events, "event_type", {"click": 1, "error": 2}, "code").drop("event_type")


@query("p11_label_by", """
WITH tagged AS (SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, '5-LOW') AS priority FROM orders),
lookup AS (SELECT o_orderstatus, priority, o_orderstatus || '/' || COALESCE(priority, 'none') AS category
           FROM tagged GROUP BY 1, 2)
SELECT t.o_orderkey, t.o_orderstatus, t.priority, l.category FROM tagged t JOIN lookup l
  ON t.o_orderstatus = l.o_orderstatus AND t.priority IS NOT DISTINCT FROM l.priority""")
def p11(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    )
    cols = ["o_orderstatus", "priority"]
    name = F.concat("o_orderstatus", F.lit("/"), F.coalesce("priority", F.lit("none")))
    return rel.label_by(orders, cols, orders.select(*cols).distinct().withColumn("category", name))


@query("p12_mask_rows", """
SELECT CASE WHEN value > 10 THEN event_id END AS event_id, CASE WHEN value > 10 THEN event_type END AS event_type,
       CASE WHEN value > 10 THEN value END AS value FROM events""")
def p12(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rel.mask_rows(events, F.col("value") > 10)


@query("p13_rename", "SELECT s_suppkey AS sup_key, s_name AS sup_s_name, s_acctbal AS sup_s_acctbal FROM supplier")
def p13(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier").drop("s_nationkey")
    return rel.rename(supplier, {"s_suppkey": "key"}, prefix="sup_")


@query("p14_constant_column", f"WITH {RESULTS_CTE} SELECT {FACTOR_LIST}, encoder, 0 AS rank FROM results")
def p14(spark, sf_dir):
    return results(spark, sf_dir).select(*KEYS, F.lit(0).alias("rank"))


@query("p15_casts", """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_quantity AS INTEGER) AS l_quantity,
       CAST(l_linenumber AS DOUBLE) AS l_linenumber, TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag FROM lineitem""")
def p15(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber", "l_returnflag")
    line = rel.cast_columns(line, {"l_orderkey": "string", "l_quantity": "int", "l_linenumber": "double"})
    return rel.cast_columns(line, {"l_returnflag": "int"}, strict=False)


@query("j1_rows_of_groups", f"""WITH {RESULTS_CTE}, big AS (
  SELECT {FACTOR_LIST} FROM results GROUP BY {FACTOR_LIST} HAVING COUNT(*) >= 22)
SELECT {FACTOR_LIST}, encoder, cv_score FROM results SEMI JOIN big USING ({FACTOR_LIST})""")
def j1(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS, "cv_score")
    big = rows.groupBy(*FACTORS).agg(F.count(F.lit(1)).alias("n")).where("n >= 22")
    return rel.rows_of_groups(rows, big, FACTORS)


PAIR_SQL = f"""WITH {RANKED_CTE}
SELECT a.dataset, a.model, a.tuning, a.scoring, a.encoder AS item_a, b.encoder AS item_b,
       CASE WHEN a.rank < b.rank THEN 1 ELSE 0 END AS a_better, CASE WHEN b.rank < a.rank THEN 1 ELSE 0 END AS b_better
FROM ranked a JOIN ranked b ON {FACTOR_JOIN} AND a.encoder < b.encoder"""


@query("j2_r3_pairs_long", PAIR_SQL)
def j2(spark, sf_dir):
    return pairs.pairwise_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank")


def _cell(item: str) -> str:
    return f"MAX(rank) FILTER (encoder = '{item}')"


def _wide_pair_sql(fill: bool) -> str:
    cells = ", ".join(f"{_cell(b)} AS v{i}" for i, b in enumerate(BRANDS))
    columns = []
    for i, a in enumerate(BRANDS):
        for j, b in enumerate(BRANDS):
            if i != j:
                less = f"CASE WHEN v{i} IS NOT NULL AND v{j} IS NOT NULL THEN CASE WHEN v{i} < v{j} THEN 1 ELSE 0 END END"
                columns.append((f"COALESCE({less}, 0)" if fill else less) + f' AS "{pairs.pair_name(a, b)}"')
    return (f"WITH {RANKED_CTE}, wide AS (SELECT {FACTOR_LIST}, {cells} FROM ranked GROUP BY {FACTOR_LIST}) "
            f"SELECT {FACTOR_LIST}, {', '.join(columns)} FROM wide")


@query("j3_pairs_wide", _wide_pair_sql(False))
def j3(spark, sf_dir):
    return pairs.pairwise_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", wide=True, items=BRANDS)


@query("j4_pairs_wide_filled", _wide_pair_sql(True))
def j4(spark, sf_dir):
    rows = ranked_results(spark, sf_dir)
    return pairs.pairwise_target(rows, FACTORS, ITEM, "rank", wide=True, items=BRANDS, fill=0)


@query("a12_wins", f"""WITH {RANKED_CTE}
SELECT {FACTOR_LIST}, encoder,
       RANK() OVER (PARTITION BY {FACTOR_LIST} ORDER BY rank DESC) - 1 AS wins FROM ranked""")
def a12(spark, sf_dir):
    return pairs.wins_without_pairs(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", bounded=True)


WINS_CTE = RANKED_CTE + f""",
won AS (
  SELECT a.dataset, a.model, a.tuning, a.scoring, a.encoder,
         SUM(CASE WHEN a.rank < b.rank THEN 1 ELSE 0 END) AS wins
  FROM ranked a JOIN ranked b ON {FACTOR_JOIN} AND a.encoder <> b.encoder GROUP BY ALL)"""


@query("w3_wins_to_ranking", f"""WITH {WINS_CTE}
SELECT {FACTOR_LIST}, encoder,
  CAST(DENSE_RANK() OVER (PARTITION BY {FACTOR_LIST} ORDER BY wins DESC) - 1 AS INTEGER) AS rank_pred FROM won""")
def w3(spark, sf_dir):
    made = pairs.pairwise_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank")
    return pairs.wins_to_ranking(made, FACTORS, ITEM)


@query("w3_wins_to_ranking_global", f"""WITH {WINS_CTE}
SELECT {FACTOR_LIST}, encoder, CAST(DENSE_RANK() OVER (ORDER BY wins DESC) - 1 AS INTEGER) AS rank_pred FROM won""")
def w3_global(spark, sf_dir):
    made = pairs.pairwise_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank")
    return pairs.wins_to_ranking(made, FACTORS, ITEM, scope="global")


@query("j5_truth_with_prediction", f"""WITH {RANKED_CTE}, predicted AS (
  SELECT {FACTOR_LIST}, encoder,
    CAST(DENSE_RANK() OVER (PARTITION BY {FACTOR_LIST} ORDER BY pred DESC) - 1 AS INTEGER) AS rank_pred FROM results)
SELECT {FACTOR_LIST}, encoder, rank, rank_pred FROM ranked JOIN predicted USING ({FACTOR_LIST}, encoder)""")
def j5(spark, sf_dir):
    from rankloom.operators.ranking import rankings

    truth = ranked_results(spark, sf_dir).select(*KEYS, "rank")
    predicted = rankings(results(spark, sf_dir), FACTORS, ITEM, "pred", bounded=True)
    return rel.truth_with_prediction(truth, predicted.withColumnRenamed("rank", "rank_pred"), KEYS)


WIDE_CTE = RANKED_CTE + f""",
wide AS (SELECT {FACTOR_LIST}, {", ".join(f'{_cell(b)} AS "{b}"' for b in BRANDS)} FROM ranked GROUP BY {FACTOR_LIST}),
filled AS (SELECT {FACTOR_LIST}, {", ".join(f'COALESCE("{b}", (SELECT MAX(rank) FROM ranked)) AS "{b}"' for b in BRANDS)}
           FROM wide)"""
BRAND_LIST = ", ".join(f'"{b}"' for b in BRANDS)


@query("j6_truth_left_join_prediction", f"""WITH {WIDE_CTE}
SELECT {FACTOR_LIST}, t.encoder, t.rank, f.rank_pred FROM ranked t LEFT JOIN
  (SELECT * FROM (UNPIVOT filled ON {BRAND_LIST} INTO NAME encoder VALUE rank_pred)) f USING ({FACTOR_LIST}, encoder)""")
def j6(spark, sf_dir):
    rows = ranked_results(spark, sf_dir)
    truth = reshape.pivot_target(rows, FACTORS, ITEM, "rank", BRANDS, fill=None)
    predicted = reshape.pivot_target(rows, FACTORS, ITEM, "rank", BRANDS, fill="global")
    left = reshape.melt_target(truth, FACTORS, BRANDS, ITEM, "rank")
    right = reshape.melt_target(predicted, FACTORS, BRANDS, ITEM, "rank_pred")
    return rel.truth_with_prediction(left, right, KEYS, "left")


@query("j7_side_features", f"""WITH {RESULTS_CTE}, {METAFEATURES_CTE}
SELECT model, tuning, scoring, encoder, n_orders, ROUND(share_o, 9) AS share_o, min_price
FROM results LEFT JOIN (SELECT * FROM meta WHERE dataset % 4 <> 3) USING (dataset)""")
def j7(spark, sf_dir):
    side = metafeatures(spark, sf_dir).where("dataset % 4 <> 3").select("dataset", "n_orders", "share_o", "min_price")
    out = rel.side_features(results(spark, sf_dir).select(*KEYS), side, "dataset")
    return out.withColumn("share_o", F.round("share_o", 9))


SAMPLE_CTE = RANKED_CTE + f""",
drawn AS (
  SELECT {FACTOR_LIST}, list_no, encoder, rank,
    ROW_NUMBER() OVER (PARTITION BY {FACTOR_LIST}, list_no
      ORDER BY md5(concat_ws('|', '3', list_no, {FACTOR_LIST}, encoder)), encoder, rank) AS pos
  FROM ranked, (SELECT UNNEST([1, 2]) AS list_no)),
sampled AS (
  SELECT {FACTOR_LIST}, list_no, string_agg(encoder, ',' ORDER BY pos) AS items,
         string_agg(CAST(rank AS VARCHAR), ',' ORDER BY pos) AS ranks
  FROM drawn WHERE pos <= 20 GROUP BY {FACTOR_LIST}, list_no HAVING COUNT(*) = 20)"""


@query("w8_sample_lists", f"WITH {SAMPLE_CTE} SELECT {FACTOR_LIST}, CAST(list_no AS INTEGER) AS list_no, items, ranks FROM sampled")
def w8(spark, sf_dir):
    sampled = lists.sample_lists(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", n=20, lists=2, seed=3)
    return sampled.select(*FACTORS, "list_no", F.array_join("items", ",").alias("items"),
                          F.array_join(F.col("ranks").cast("array<string>"), ",").alias("ranks"))


@query("w7_ordered_items", f"""WITH {RANKED_CTE}
SELECT {FACTOR_LIST}, string_agg(encoder, ',' ORDER BY rank DESC, encoder) AS items,
       string_agg(CAST(rank AS VARCHAR), ',' ORDER BY rank DESC, encoder) AS ranks
FROM ranked GROUP BY {FACTOR_LIST}""")
def w7(spark, sf_dir):
    ordered = lists.ordered_items(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank")
    return ordered.select(*FACTORS, F.array_join("items", ",").alias("items"),
                          F.array_join(F.col("ranks").cast("array<string>"), ",").alias("ranks"))


@query("w7_ordered_rows", """
SELECT event_type, event_id, value,
  ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, md5(concat_ws('|', '0', event_id)), event_id) AS position
FROM events""")
def w7_rows(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return lists.ordered_rows(events, ["event_type"], "event_id", "value")


@query("t6_j8_restore_lists", f"""WITH {SAMPLE_CTE}
SELECT r.dataset, r.model, r.tuning, r.scoring, r.encoder, CAST(COALESCE(d.rank, 0) AS DOUBLE) AS rank_pred
FROM ranked r LEFT JOIN (
  SELECT d.* FROM drawn d JOIN sampled s USING ({FACTOR_LIST}, list_no) WHERE pos <= 20 AND list_no = 1) d
USING ({FACTOR_LIST}, encoder)""")
def t6(spark, sf_dir):
    rows = ranked_results(spark, sf_dir)
    one = lists.sample_lists(rows, FACTORS, ITEM, "rank", n=20, lists=2, seed=3).where("list_no = 1")
    return lists.restore_lists(rows.select(*KEYS), one, FACTORS, ITEM, predictions="ranks")


@query("r1_pivot_filled", f"WITH {WIDE_CTE} SELECT * FROM filled")
def r1(spark, sf_dir):
    return reshape.pivot_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", BRANDS)


@query("r1_pivot_filled_by_column", f"""WITH {WIDE_CTE}
SELECT {FACTOR_LIST}, {", ".join(f'COALESCE("{b}", MAX("{b}") OVER ()) AS "{b}"' for b in BRANDS)} FROM wide""")
def r1_column(spark, sf_dir):
    return reshape.pivot_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", BRANDS, fill="column")


@query("r1_pivot_filled_by_row", f"""WITH {WIDE_CTE}
SELECT {FACTOR_LIST}, {", ".join(f'COALESCE("{b}", GREATEST({BRAND_LIST})) AS "{b}"' for b in BRANDS)} FROM wide""")
def r1_row(spark, sf_dir):
    return reshape.pivot_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", BRANDS, fill="row")


@query("r2_melt", f"WITH {RANKED_CTE} SELECT {FACTOR_LIST}, encoder, rank FROM ranked")
def r2(spark, sf_dir):
    wide = reshape.pivot_target(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", BRANDS, fill=None)
    return reshape.melt_target(wide, FACTORS, BRANDS, ITEM, "rank")


@query("r4_split_pair_name", """
SELECT l_orderkey, l_linenumber, l_returnflag AS item_a, l_linestatus AS item_b FROM lineitem""")
def r4(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    named = line.select("l_orderkey", "l_linenumber",
                        F.concat_ws(pairs.PAIR_SEPARATOR, "l_returnflag", "l_linestatus").alias("pair"))
    return named.select("l_orderkey", "l_linenumber", *pairs.split_pair_name("pair"))


MATRIX_LEVELS = [str(i) for i in range(25)]


@query("r5_missing_matrix", f"""WITH {RESULTS_CTE}, grid AS (
  SELECT g.dataset, i.encoder, r.cv_score FROM (SELECT DISTINCT {FACTOR_LIST} FROM results) g
  CROSS JOIN (SELECT DISTINCT encoder FROM results) i LEFT JOIN results r USING ({FACTOR_LIST}, encoder)),
ratio AS (SELECT encoder, dataset, (COUNT(*) - COUNT(cv_score)) / COUNT(*) AS x FROM grid GROUP BY ALL)
SELECT encoder, {", ".join(f"COALESCE(MAX(printf('%.4f', x)) FILTER (dataset = {d} AND x >= 0.2), '') AS " + chr(34) + d + chr(34) for d in MATRIX_LEVELS)}
FROM ratio GROUP BY encoder HAVING MAX(x) >= 0.2""")
def r5(spark, sf_dir):
    from rankloom.operators.profile import null_ratio_matrix

    grid = reshape.complete_grid(results(spark, sf_dir), FACTORS, ITEM, "cv_score", BRANDS)
    grid = grid.withColumn("dataset", F.col("dataset").cast("string"))
    return null_ratio_matrix(grid, ITEM, "dataset", "cv_score", MATRIX_LEVELS, threshold=0.2)


@query("r6_group_key", f"""WITH {RESULTS_CTE}
SELECT concat_ws(' ', {FACTOR_LIST}) AS features, CAST(dataset AS VARCHAR) AS dataset, model, tuning, scoring, encoder
FROM results""")
def r6(spark, sf_dir):
    keyed = reshape.with_group_key(results(spark, sf_dir).select(*KEYS), FACTORS).drop(*FACTORS)
    return reshape.with_group_key(reshape.from_group_key(keyed, FACTORS), FACTORS)


@query("r7_explode_lists", f"WITH {RANKED_CTE} SELECT {FACTOR_LIST}, encoder AS items, rank AS ranks FROM ranked")
def r7(spark, sf_dir):
    ordered = lists.ordered_items(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank")
    return reshape.explode_lists(ordered, ["items", "ranks"])


@query("r8_item_statistics", f"""WITH {RANKED_CTE}
SELECT encoder, COUNT(*) AS groups, MIN(rank) AS best, MAX(rank) AS worst,
       ROUND(CAST(SUM(rank) AS DOUBLE) / COUNT(*), 9) AS mean FROM ranked GROUP BY encoder""")
def r8(spark, sf_dir):
    return ranked_results(spark, sf_dir).groupBy(ITEM).agg(
        F.count("rank").alias("groups"), F.min("rank").alias("best"), F.max("rank").alias("worst"),
        F.round(F.sum("rank").cast("double") / F.count("rank"), 9).alias("mean"),
    )


@query("o1_sorted_report", f"WITH {REPORTS_CTE} SELECT approach, tuning, fold, metric, score FROM reports")
def o1(spark, sf_dir):
    return score_reports(spark, sf_dir).drop("runtime").orderBy(F.desc("score"), "approach", "tuning", "fold", "metric")


@query("o2_first_rows", f"""WITH {RESULTS_CTE} SELECT {FACTOR_LIST}, encoder, cv_score FROM results
ORDER BY cv_score DESC, {FACTOR_LIST}, encoder LIMIT 20""")
def o2(spark, sf_dir):
    return rel.first_rows(results(spark, sf_dir).select(*KEYS, "cv_score"), [F.desc("cv_score"), *KEYS], 20)


@query("u1_stack", """
SELECT c_custkey AS id, c_name AS name, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier' FROM supplier""")
def u1(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "'customer' AS kind")
    supplier = table(spark, sf_dir, "supplier").selectExpr("'supplier' AS kind", "s_suppkey AS id", "s_name AS name")
    return rel.stack(customer, supplier)


@query("u2_value_combinations", """
SELECT * FROM (SELECT DISTINCT l_returnflag FROM lineitem), (SELECT DISTINCT l_linestatus FROM lineitem),
              (SELECT DISTINCT l_linenumber FROM lineitem)""")
def u2(spark, sf_dir):
    return rel.value_combinations(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query("scalar_functions", f"""WITH {METAFEATURES_CTE}
SELECT dataset, printf('%.2f%%', share_f * 100) AS share, ROUND(n_orders / NULLIF(dataset, 0), 4) AS ratio,
       CASE WHEN share_f > 0.5 THEN 1 ELSE 0 END AS flag, replace(CAST(dataset AS VARCHAR), '1', 'x') AS text,
       GREATEST(n_orders, 60) AS top FROM meta""")
def scalar_functions(spark, sf_dir):
    return metafeatures(spark, sf_dir).select(
        "dataset", percent_text(F.col("share_f")).alias("share"),
        F.round(F.try_divide("n_orders", F.col("dataset").cast("double")), 4).alias("ratio"),
        indicator(F.col("share_f") > 0.5).alias("flag"),
        F.replace(F.col("dataset").cast("string"), F.lit("1"), F.lit("x")).alias("text"),
        F.greatest("n_orders", F.lit(60.0)).alias("top"),
    )
