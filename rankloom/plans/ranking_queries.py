"""Registered queries: ranks, rank agreement, ranking metrics, item lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankloom.operators import lists, ranking
from rankloom.plans.catalog import query
from rankloom.plans.tables import FACTOR_LIST, FACTORS, ITEM, KEYS, RANKED_CTE, RESULTS_CTE, ranked_results, results, table


@query("w1_score_to_rank", f"WITH {RANKED_CTE} SELECT {FACTOR_LIST}, encoder, cv_score, rank FROM ranked")
def w1(spark, sf_dir):
    return ranked_results(spark, sf_dir).select(*KEYS, "cv_score", "rank")


@query("w1_score_to_rank_ascending", """
SELECT event_id, event_type, value,
       CAST(DENSE_RANK() OVER (PARTITION BY event_type ORDER BY value) - 1 AS INTEGER) AS rank FROM events""")
def w1_ascending(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return ranking.score_to_rank(events, ["event_type"], "value", ascending=True)


@query("w2_rankings", f"""WITH {RESULTS_CTE}
SELECT {FACTOR_LIST}, encoder,
       CAST(DENSE_RANK() OVER (PARTITION BY {FACTOR_LIST} ORDER BY pred DESC) - 1 AS INTEGER) AS rank FROM results""")
def w2(spark, sf_dir):
    return ranking.rankings(results(spark, sf_dir), FACTORS, ITEM, "pred", bounded=True)


SPEARMAN_CTE = RESULTS_CTE + f""",
avg_ranks AS (
  SELECT {FACTOR_LIST},
    RANK() OVER (PARTITION BY {FACTOR_LIST} ORDER BY cv_score)
      + (COUNT(*) OVER (PARTITION BY {FACTOR_LIST}, cv_score) - 1) / 2.0::DOUBLE AS x,
    RANK() OVER (PARTITION BY {FACTOR_LIST} ORDER BY pred)
      + (COUNT(*) OVER (PARTITION BY {FACTOR_LIST}, pred) - 1) / 2.0::DOUBLE AS y
  FROM results),
rho AS (
  SELECT {FACTOR_LIST}, COUNT(*) AS n,
    (COUNT(*) * SUM(x * y) - SUM(x) * SUM(y))
      / NULLIF(SQRT((COUNT(*) * SUM(x * x) - SUM(x) * SUM(x)) * (COUNT(*) * SUM(y * y) - SUM(y) * SUM(y))), 0) AS rho
  FROM avg_ranks GROUP BY {FACTOR_LIST})"""


@query("w4_spearman_by_group", f"WITH {SPEARMAN_CTE} SELECT {FACTOR_LIST}, n, ROUND(rho, 9) AS rho FROM rho")
def w4(spark, sf_dir):
    out = ranking.spearman_by_group(results(spark, sf_dir), FACTORS, "cv_score", "pred", bounded=True)
    return out.withColumn("rho", F.round("rho", 9))


@query("w5_average_spearman", f"""WITH {SPEARMAN_CTE}
SELECT ROUND(AVG(rho), 9) AS mean_rho, COUNT(rho) AS groups_used, COUNT(*) AS groups FROM rho""")
def w5(spark, sf_dir):
    out = ranking.average_spearman(results(spark, sf_dir), FACTORS, "cv_score", "pred", bounded=True)
    return out.withColumn("mean_rho", F.round("mean_rho", 9))


@query("w5_average_spearman_wide_groups", """
WITH avg_ranks AS (
  SELECT l_returnflag, l_linestatus,
    RANK() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_quantity)
      + (COUNT(*) OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity) - 1) / 2.0::DOUBLE AS x,
    RANK() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice)
      + (COUNT(*) OVER (PARTITION BY l_returnflag, l_linestatus, l_extendedprice) - 1) / 2.0::DOUBLE AS y
  FROM lineitem),
rho AS (
  SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
    (COUNT(*) * SUM(x * y) - SUM(x) * SUM(y))
      / NULLIF(SQRT((COUNT(*) * SUM(x * x) - SUM(x) * SUM(x)) * (COUNT(*) * SUM(y * y) - SUM(y) * SUM(y))), 0) AS rho
  FROM avg_ranks GROUP BY 1, 2)
SELECT ROUND(AVG(rho), 9) AS mean_rho, COUNT(rho) AS groups_used, COUNT(*) AS groups FROM rho""")
def w5_wide_groups(spark, sf_dir):
    """A few groups hold every line, so this is the plan for very large groups: sizes are checked, then cut."""
    line = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    out = ranking.average_spearman(line, ["l_returnflag", "l_linestatus"], "l_quantity", "l_extendedprice")
    return out.withColumn("mean_rho", F.round("mean_rho", 9))


@query("w9_ndcg_by_group", f"""WITH {RANKED_CTE},
placed AS (
  SELECT {FACTOR_LIST}, POW(2.0, rank) - 1 AS gain,
    ROW_NUMBER() OVER (PARTITION BY {FACTOR_LIST} ORDER BY pred DESC, md5('0|' || encoder), encoder) AS pos,
    ROW_NUMBER() OVER (PARTITION BY {FACTOR_LIST} ORDER BY rank DESC, md5('0|' || encoder), encoder) AS ideal
  FROM ranked)
SELECT {FACTOR_LIST},
  ROUND(COALESCE(SUM(gain / LOG2(pos + 1)) / NULLIF(SUM(gain / LOG2(ideal + 1)), 0), 0), 9) AS ndcg
FROM placed GROUP BY {FACTOR_LIST}""")
def w9(spark, sf_dir):
    out = ranking.ndcg_by_group(ranked_results(spark, sf_dir), FACTORS, ITEM, "rank", "pred", bounded=True)
    return out.withColumn("ndcg", F.round("ndcg", 9))


# Groups and values with gaps, through the plan for groups that no task may sort (every group counts as large).
CUT = 0
GAPS_CTE = """
gaps AS (
  SELECT l_orderkey * 10 + l_linenumber AS item, NULLIF(l_returnflag, 'A') AS grp, l_linestatus AS part,
         NULLIF(l_quantity, 7) AS a, l_extendedprice AS b, CAST(l_quantity AS BIGINT) % 5 AS rel
  FROM lineitem)"""


def _gaps(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item"),
        F.nullif("l_returnflag", F.lit("A")).alias("grp"), F.col("l_linestatus").alias("part"),
        F.nullif("l_quantity", F.lit(7.0)).alias("a"), F.col("l_extendedprice").alias("b"),
        (F.col("l_quantity").cast("bigint") % 5).alias("rel"))


@query("w1_score_to_rank_with_gaps", f"""WITH {GAPS_CTE}
SELECT item, grp, part, a, CASE WHEN grp IS NOT NULL AND a IS NOT NULL THEN
  CAST(DENSE_RANK() OVER (PARTITION BY grp, part ORDER BY a DESC NULLS LAST) - 1 AS INTEGER) END AS rank FROM gaps""")
def w1_gaps(spark, sf_dir):
    rows = _gaps(spark, sf_dir).select("item", "grp", "part", "a")
    return ranking.score_to_rank(rows, ["grp", "part"], "a", limit=CUT).select("item", "grp", "part", "a", "rank")


@query("w4_spearman_with_gaps", f"""WITH {GAPS_CTE},
r AS (
  SELECT grp, part,
    RANK() OVER (PARTITION BY grp, part ORDER BY a) + (COUNT(*) OVER (PARTITION BY grp, part, a) - 1) / 2.0::DOUBLE AS x,
    RANK() OVER (PARTITION BY grp, part ORDER BY b) + (COUNT(*) OVER (PARTITION BY grp, part, b) - 1) / 2.0::DOUBLE AS y
  FROM gaps WHERE a IS NOT NULL AND grp IS NOT NULL)
SELECT grp, part, COUNT(*) AS n, ROUND(CORR(x, y), 9) AS rho FROM r GROUP BY grp, part""")
def w4_gaps(spark, sf_dir):
    out = ranking.spearman_by_group(_gaps(spark, sf_dir), ["grp", "part"], "a", "b", limit=CUT)
    return out.withColumn("rho", F.round("rho", 9))


@query("w7_ordered_rows_with_gaps", f"""WITH {GAPS_CTE}
SELECT item, grp, part, a,
  ROW_NUMBER() OVER (PARTITION BY grp, part ORDER BY a DESC, md5('0|' || item), item) AS position
FROM gaps WHERE a IS NOT NULL AND grp IS NOT NULL""")
def w7_gaps(spark, sf_dir):
    rows = _gaps(spark, sf_dir).select("item", "grp", "part", "a")
    return lists.ordered_rows(rows, ["grp", "part"], "item", "a", limit=CUT)


@query("w9_ndcg_with_gaps", f"""WITH {GAPS_CTE},
placed AS (
  SELECT grp, part, POW(2.0, rel) - 1 AS gain,
    ROW_NUMBER() OVER (PARTITION BY grp, part ORDER BY a DESC, md5('0|' || item), item) AS pos,
    ROW_NUMBER() OVER (PARTITION BY grp, part ORDER BY rel DESC, md5('0|' || item), item) AS ideal
  FROM gaps WHERE a IS NOT NULL AND grp IS NOT NULL)
SELECT grp, part, ROUND(SUM(gain / LOG2(pos + 1)) / SUM(gain / LOG2(ideal + 1)), 9) AS ndcg FROM placed GROUP BY grp, part""")
def w9_gaps(spark, sf_dir):
    out = ranking.ndcg_by_group(_gaps(spark, sf_dir), ["grp", "part"], "item", "rel", "a", limit=CUT)
    return out.withColumn("ndcg", F.round("ndcg", 9))


@query("o4_top_items", f"""WITH {RESULTS_CTE}, placed AS (
  SELECT {FACTOR_LIST}, encoder, cv_score,
    CAST(ROW_NUMBER() OVER (PARTITION BY {FACTOR_LIST} ORDER BY cv_score DESC, encoder) AS INTEGER) AS position
  FROM results)
SELECT * FROM placed WHERE position <= 3""")
def o4(spark, sf_dir):
    rows = results(spark, sf_dir).select(*KEYS, "cv_score")
    return ranking.top_k_items(rows, FACTORS, ITEM, "cv_score", 3)
