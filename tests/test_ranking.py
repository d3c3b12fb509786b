import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rankloom.operators import lists, pairs, profile, ranking, skew, splits
from rankloom.plans.evaluate import SpearmanEvaluator


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("kind", ["dense", "min", "average"])
@pytest.mark.parametrize("ascending", [True, False])
def test_cut_ranks_equal_window_ranks(scores, hot, kind, ascending):
    cut = ranking.group_ranks(scores, ["g"], "a", "r", kind, ascending)
    plain = ranking.group_ranks(scores, ["g"], "a", "r", kind, ascending, bounded=True)
    assert rows(cut.select("g", "item", "r")) == rows(plain.select("g", "item", "r"))


def test_cut_ranks_against_pandas(scores, hot):
    got = ranking.group_ranks(scores, ["g"], "a", "r", "dense", False).toPandas().sort_values(["g", "item"])
    want = got.groupby("g")["a"].rank(method="dense", ascending=False) - 1
    pd.testing.assert_series_equal(got["r"].astype(float), want, check_names=False)


def test_cut_positions_of_a_whole_table(scores, hot):
    got = skew.value_positions(scores, [], "a").toPandas().sort_values("a")
    counts = scores.toPandas()["a"].value_counts().sort_index()
    assert got["n"].tolist() == counts.tolist()
    assert got["before"].tolist() == (counts.cumsum() - counts).tolist()
    assert got["distinct_before"].tolist() == list(range(len(counts)))


def test_spearman_of_large_groups_equals_window_plan(scores, hot):
    cut = ranking.spearman_by_group(scores, ["g"], "a", "b").withColumn("rho", F.round("rho", 12))
    plain = ranking.spearman_by_group(scores, ["g"], "a", "b", bounded=True).withColumn("rho", F.round("rho", 12))
    assert rows(cut) == rows(plain)


def test_spearman_against_pandas(scores):
    got = {r["g"]: r["rho"] for r in ranking.spearman_by_group(scores, ["g"], "a", "b").collect()}
    for g, part in scores.toPandas().groupby("g"):
        part = part.dropna()
        want = part["a"].rank().corr(part["b"].rank()) if len(part) > 1 else math.nan
        assert (got[g] is None and math.isnan(want)) or got[g] == pytest.approx(want)


def test_spearman_invariants(scores):
    same = ranking.spearman_by_group(scores, ["g"], "b", "b").where("g <> 'one'").collect()
    assert all(r["rho"] == pytest.approx(1.0) for r in same)
    shifted = scores.withColumn("c", F.exp("b"))
    a = ranking.average_spearman(scores, ["g"], "a", "b").first()["mean_rho"]
    b = ranking.average_spearman(shifted, ["g"], "a", "c").first()["mean_rho"]
    assert a == pytest.approx(b) and -1 <= a <= 1
    assert ranking.spearman_by_group(scores, ["g"], "a", "flat").where("rho IS NOT NULL").isEmpty()
    assert SpearmanEvaluator(["g"], "a", "b").evaluate(scores) == pytest.approx(a)


def test_ndcg_of_large_groups_equals_window_plan(scores, hot):
    cut = ranking.ndcg_by_group(scores, ["g"], "item", "a", "b").withColumn("ndcg", F.round("ndcg", 12))
    plain = ranking.ndcg_by_group(scores, ["g"], "item", "a", "b", bounded=True).withColumn("ndcg", F.round("ndcg", 12))
    assert rows(cut) == rows(plain)
    perfect = ranking.ndcg_by_group(scores, ["g"], "item", "a", "a", bounded=True).where("g = 'big'").first()
    assert perfect["ndcg"] == pytest.approx(1.0)


def test_salted_pairs_equal_plain_pairs(spark, scores):
    plain = rows(pairs.pairwise_target(scores, ["g"], "item", "b"))
    spark.conf.set(skew.HOT_ROWS_CONF, "7")
    try:
        salted = rows(pairs.pairwise_target(scores, ["g"], "item", "b"))
    finally:
        spark.conf.unset(skew.HOT_ROWS_CONF)
    assert salted == plain and len(plain) == 60 * 59 // 2 + 9 * 8 // 2


def test_pairs_wide_equals_long(scores):
    few = scores.where("g = 'mid'")
    wide = pairs.pairwise_target(few, ["g"], "item", "b", wide=True).first().asDict()
    for r in pairs.pairwise_target(few, ["g"], "item", "b").collect():
        assert wide[pairs.pair_name(r["item_a"], r["item_b"])] == r["a_better"]
        assert wide[pairs.pair_name(r["item_b"], r["item_a"])] == r["b_better"]
        assert r["a_better"] + r["b_better"] <= 1


def test_wins_with_and_without_pairs(scores):
    known = scores.where("a IS NOT NULL AND g <> 'one'")
    won = pairs.wins(pairs.pairwise_target(known, ["g"], "item", "a"), ["g"], "item")
    assert rows(won.select("g", "item", "wins")) == rows(pairs.wins_without_pairs(known, ["g"], "item", "a"))


def test_two_targets_for_one_item_are_an_error(spark):
    df = spark.createDataFrame([("g", "x", 1), ("g", "x", 2)], "g string, item string, t int")
    with pytest.raises(Exception, match="several targets"):
        pairs.pairwise_target(df, ["g"], "item", "t").collect()


def test_hash_positions_are_a_permutation(scores):
    placed = skew.hash_positions(scores, ["g"], ["item"], 3, "p").toPandas()
    for _, part in placed.groupby("g"):
        assert sorted(part["p"]) == list(range(1, len(part) + 1))


def test_ordered_rows_of_large_groups(scores, hot):
    long = lists.ordered_rows(scores, ["g"], "item", "b").toPandas().sort_values(["g", "position"])
    for _, part in long.groupby("g"):
        assert part["b"].is_monotonic_decreasing and part["position"].tolist() == list(range(1, len(part) + 1))


def test_sampled_lists(scores):
    got = lists.sample_lists(scores, ["g"], "item", "b", n=9, lists=3, seed=1).collect()
    assert {(r["g"], r["list_no"]) for r in got} == {(g, i) for g in ("big", "mid") for i in (1, 2, 3)}
    assert all(len(set(r["items"])) == 9 for r in got)


def test_exact_quantiles(scores, hot):
    got = {r["statistic"]: r["value"] for r in profile.exact_quantiles(scores, "a", [0.1, 0.5, 0.9]).collect()}
    want = scores.toPandas()["a"].quantile([0.1, 0.5, 0.9]).tolist()
    assert [got["10%"], got["50%"], got["90%"]] == pytest.approx(want)


def test_groups_stay_together(spark):
    df = spark.range(400).selectExpr("id % 3 AS s", "id % 40 AS g", "id")
    split = splits.group_split(df, ["s", "g"], ["s"], 0.75, 1)
    assert split.groupBy("s", "g").agg(F.count_distinct("is_train").alias("n")).where("n > 1").isEmpty()
    for seed in (0, None):
        folds = splits.group_kfold(df, ["s", "g"], 5, seed)
        assert folds.count() == 400
        assert folds.groupBy("s", "g").agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()
        sizes = [r[1] for r in folds.select("s", "g", "fold").distinct().groupBy("fold").count().collect()]
        assert max(sizes) - min(sizes) <= 1


@pytest.fixture(scope="module")
def gaps(spark):
    rows = [(None if i % 5 == 0 else "ab"[i % 2], None if i % 7 == 0 else f"i{i % 13}", None if i % 3 == 0 else float(i % 11),
             float(i % 4)) for i in range(80)]
    return spark.createDataFrame(rows, "g string, item string, a double, b double")


@pytest.mark.parametrize("of", [
    lambda df, limit: ranking.score_to_rank(df, ["g"], "a", limit=limit),
    lambda df, limit: ranking.group_ranks(df, ["g"], "a", "r", "average", True, limit=limit),
    lambda df, limit: ranking.spearman_by_group(df, ["g"], "a", "b", limit=limit),
    lambda df, limit: ranking.ndcg_by_group(df, ["g"], "item", "b", "a", limit=limit),
    lambda df, limit: lists.ordered_rows(df, ["g"], "item", "a", limit=limit),
])
def test_missing_keys_are_the_same_at_any_size(gaps, of):
    plain, cut = (sorted(map(str, of(gaps, limit).collect())) for limit in (10**9, 0))
    assert plain == cut and plain


def test_rows_with_a_missing_group_keep_no_rank(gaps):
    ranked = ranking.score_to_rank(gaps, ["g"], "a", limit=0).collect()
    assert len(ranked) == 80 and all(r["rank"] is None for r in ranked if r["g"] is None)
    assert {r["g"] for r in ranking.spearman_by_group(gaps, ["g"], "a", "b").collect()} == {"a", "b"}


def test_top_k_of_many(spark):
    df = spark.range(3000).selectExpr("id % 2 AS g", "id AS item", "CAST(id % 37 AS DOUBLE) AS s")
    got = {(r["g"], r["position"]): (r["item"], r["s"]) for r in ranking.top_k_items(df, ["g"], "item", "s", 1200).collect()}
    for g in (0, 1):
        want = sorted(((i, float(i % 37)) for i in range(g, 3000, 2)), key=lambda x: (-x[1], x[0]))[:1200]
        assert [got[g, p + 1] for p in range(1200)] == want


def test_pair_names_come_back(spark):
    for a, b in [("a__b", "c"), ("_a", "b_"), ("a%5F", "_"), ("x_y", "z")]:
        row = spark.createDataFrame([(pairs.pair_name(a, b),)], "p string").select(*pairs.split_pair_name("p")).first()
        assert tuple(row) == (a, b)
