"""Ranking tables derived from the star schema, and the same tables as SQL for checking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACTORS = ["dataset", "model", "tuning", "scoring"]
ITEM = "encoder"
KEYS = [*FACTORS, ITEM]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (factors, item): ``cv_score`` and a second column ``pred`` standing in for a prediction.

    Each sum is over exact integers and divided once at the end, so that every engine gets the same double.
    """
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_returnflag", "l_quantity",
        (
            F.round(F.col("l_extendedprice") * 100).cast("bigint")
            * (100 - F.round(F.col("l_discount") * 100).cast("bigint"))
        ).cast("decimal(20,0)").alias("_net"),
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # Orders meet their customers first: the largest table is dealt once for its parts and once for its orders.
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(
        F.col("c_nationkey").alias("dataset"),
        F.col("c_mktsegment").alias("model"),
        F.col("l_returnflag").alias("tuning"),
        F.col("o_orderstatus").alias("scoring"),
        F.col("p_brand").alias("encoder"),
    ).agg(
        (F.sum("_net").cast("double") / F.count(F.lit(1))).alias("cv_score"),
        (F.sum(F.col("l_quantity").cast("bigint")).cast("double") / F.count(F.lit(1))).alias("pred"),
    )


def ranked_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results with ``rank`` (0 = best ``cv_score``). The aggregate above leaves one row per item in a group, so
    groups are no larger than the item vocabulary and the plain window is safe."""
    from rankloom.operators.ranking import score_to_rank

    return score_to_rank(results(spark, sf_dir), FACTORS, "cv_score", bounded=True)


RESULTS_CTE = """
results AS (
  SELECT c_nationkey AS dataset, c_mktsegment AS model, l_returnflag AS tuning, o_orderstatus AS scoring,
         p_brand AS encoder,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)
                  * (100 - CAST(ROUND(l_discount * 100) AS BIGINT))) AS DOUBLE) / COUNT(*) AS cv_score,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / COUNT(*) AS pred
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3, 4, 5)"""

RANKED_CTE = RESULTS_CTE + """,
ranked AS (
  SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY dataset, model, tuning, scoring ORDER BY cv_score DESC) - 1
                 AS INTEGER) AS rank
  FROM results)"""

FACTOR_LIST = "dataset, model, tuning, scoring"


def metafeatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A side table keyed by ``dataset``: per-nation order statistics, some of them missing."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").cast("decimal(20,0)")
    balance = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("decimal(20,0)")
    n = F.count(F.lit(1))

    def share(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("double") / n

    nation = F.col("c_nationkey")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(nation.alias("dataset"))
        .agg(
            n.cast("double").alias("n_orders"),
            (F.sum(cents).cast("double") / n).alias("mean_price"),
            F.max("o_totalprice").alias("max_price"),
            (F.sum(balance).cast("double") / n).alias("mean_balance"),
            share(F.col("o_orderstatus") == "F").alias("share_f"),
            F.when(nation % 5 != 0, share(F.col("o_orderstatus") == "O")).alias("share_o"),
            F.when(nation % 3 != 0, share(F.col("o_orderpriority") == "1-URGENT")).alias("share_urgent"),
            F.when(nation % 2 != 0, F.min("o_totalprice")).alias("min_price"),
        )
    )


METAFEATURES_CTE = """
meta AS (
  SELECT c_nationkey AS dataset, CAST(COUNT(*) AS DOUBLE) AS n_orders,
         CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS mean_price,
         MAX(o_totalprice) AS max_price,
         CAST(SUM(CAST(ROUND(c_acctbal * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS mean_balance,
         CAST(COUNT(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / COUNT(*) AS share_f,
         CASE WHEN c_nationkey % 5 <> 0
              THEN CAST(COUNT(*) FILTER (o_orderstatus = 'O') AS DOUBLE) / COUNT(*) END AS share_o,
         CASE WHEN c_nationkey % 3 <> 0
              THEN CAST(COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) / COUNT(*) END AS share_urgent,
         CASE WHEN c_nationkey % 2 <> 0 THEN MIN(o_totalprice) END AS min_price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey)"""

META_COLUMNS = ["n_orders", "mean_price", "max_price", "mean_balance", "share_f", "share_o", "share_urgent",
                "min_price"]


def score_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long score report: approach, tuning, metric, fold, score, runtime, from the order lines of each segment."""
    line = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity",
                                                   "l_discount", "l_tax")
    hundredths = F.round(F.col("l_discount") * 100).cast("bigint")
    tax = F.round(F.col("l_tax") * 100).cast("bigint")
    per = line.groupBy(
        F.col("l_returnflag").alias("approach"),
        F.col("l_linestatus").alias("tuning"),
        F.col("l_linenumber").alias("fold"),
    ).agg(
        F.sum(hundredths).alias("_d"), F.sum(tax).alias("_t"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("_q"), F.count(F.lit(1)).alias("_n"),
    )
    long = per.select(
        "approach", "tuning", "fold",
        F.explode(
            F.array(
                F.struct(F.lit("spearman").alias("metric"), (F.col("_d").cast("double") / F.col("_n")).alias("score")),
                F.struct(F.lit("ndcg").alias("metric"), (F.col("_t").cast("double") / F.col("_n")).alias("score")),
            )
        ).alias("_m"),
        (F.col("_q").cast("double") / F.col("_n")).alias("runtime"),
    )
    return long.select("approach", "tuning", "fold", "_m.metric", "_m.score", "runtime")


REPORTS_CTE = """
per AS (
  SELECT l_returnflag AS approach, l_linestatus AS tuning, l_linenumber AS fold,
         CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS d,
         CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS DOUBLE) / COUNT(*) AS t,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE) / COUNT(*) AS runtime
  FROM lineitem GROUP BY 1, 2, 3),
reports AS (
  SELECT approach, tuning, fold, 'spearman' AS metric, d AS score, runtime FROM per
  UNION ALL SELECT approach, tuning, fold, 'ndcg', t, runtime FROM per)"""


def item_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item graph: an undirected edge between a brand and every part type sold under it."""
    part = table(spark, sf_dir, "part")
    return part.select(F.col("p_brand").alias("src"), F.col("p_type").alias("dst")).distinct()


def purchase_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large bipartite graph: customer - part, from the order lines."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pairs = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_partkey").distinct()
    return pairs.select(
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("src"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("dst"),
    )
