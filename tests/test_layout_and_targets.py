import pytest
from pyspark.sql import functions as F

from rankloom.operators import encoders, features, graph, relational, reshape, targets
from rankloom.sources import readers, writers

FACTORS = ["dataset", "model", "tuning", "scoring"]
ENCODERS = ["binary", "onehot", "ordinal", "target"]


def frame(spark, values, kind):
    """Eight rows, two groups that alternate, four items in pairs."""
    data = [(i, i % 2 + 1, "m", "t", "s", ENCODERS[i // 2], v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, f"row_id int, dataset int, model string, tuning string, scoring string, "
                                       f"encoder string, ranking {kind}")


def column(df, name):
    return [r[name] for r in df.orderBy("row_id").collect()]


def test_group_min_max(spark):
    values = [100.0, 0.0, 150.0, 0.5, 250.0, 1.5, 300.0, 2.0]
    df = frame(spark, values, "double")
    model = targets.GroupMinMax("ranking", FACTORS).fit(df)
    scaled = model.transform(df)
    assert column(scaled, "ranking") == [0, 0, 0.25, 0.25, 0.75, 0.75, 1, 1]
    assert column(model.inverse(scaled), "ranking") == values


def test_constant_group_and_global_state(spark):
    df = frame(spark, [5.0] * 8, "double")
    model = targets.GroupwiseTarget("ranking", [], "minmax").fit(df)
    assert set(column(model.transform(df), "ranking")) == {0.0}
    assert set(column(model.inverse(model.transform(df)), "ranking")) == {5.0}


def test_target_one_hot_in_order_of_appearance(spark):
    values = [0, 3, 1, 2, 2, 1, 3, 0]
    df = frame(spark, values, "int")
    model = targets.TargetOneHot("ranking", order_col="row_id").fit(df)
    hot = model.transform(df)
    names = [f"ranking_{i}" for i in (1, 2, 3, 4)]
    got = [tuple(r[n] for n in names) for r in hot.orderBy("row_id").collect()]
    assert got == [tuple(int(v == level) for level in (0, 3, 1, 2)) for v in values]
    assert column(model.inverse(hot), "ranking") == values


def test_rank_binarizer(spark):
    values = [0, 1, 2, 3, 3, 2, 1, 0]
    df = frame(spark, values, "int")
    model = targets.RankBinarizer("ranking").fit(df)
    steps = model.transform(df)
    for i in range(3):
        assert column(steps, f"ranking_{i}") == [int(v > i) for v in values]
    assert column(model.inverse(steps), "ranking") == values
    with pytest.raises(ValueError, match="non-negative"):
        targets.RankBinarizer("ranking").fit(df.withColumn("ranking", F.col("ranking") - 1))


def test_target_pivot(spark):
    df = frame(spark, [1, 0, 0, 1, 3, 2, 2, 3], "int")
    model = targets.TargetPivot(FACTORS, "encoder", "ranking").fit(df)
    wide = model.transform(df)
    got = {r["dataset"]: [r[e] for e in ENCODERS] for r in wide.collect()}
    assert got == {1: [1, 0, 3, 2], 2: [0, 1, 2, 3]}
    back = {tuple(r) for r in model.inverse(wide).select("dataset", "encoder", "ranking").collect()}
    assert back == {tuple(r) for r in df.select("dataset", "encoder", "ranking").collect()}


def test_pivot_refuses_two_rows_for_one_cell(spark):
    df = frame(spark, [1] * 8, "int")
    with pytest.raises(Exception, match="two rows"):
        reshape.pivot_target(df.unionByName(df), FACTORS, "encoder", "ranking", ENCODERS).collect()


def test_results_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "results.csv")
    with open(path, "w") as f:
        f.write(",dataset,model,tuning,scoring,encoder,cv_score,rank\n0,3,SVC,no,ACC,target,0.5,1\n1,3,SVC,no,ACC,onehot,NaN,\n")
    df = readers.read_results(spark, path)
    got = [tuple(r) for r in df.orderBy("row_id").collect()]
    assert got == [(0, 3, "SVC", "no", "ACC", "target", 0.5, 1.0), (1, 3, "SVC", "no", "ACC", "onehot", None, None)]
    writers.write_predictions(df.withColumn("prediction", F.col("rank")), str(tmp_path / "out"), ["row_id"])
    back = spark.read.schema("row_id long, prediction double").csv(str(tmp_path / "out"))
    assert {tuple(r) for r in back.collect()} == {(0, 1.0), (1, None)}
    writers.write_value_counts(df, ["model"], "encoder", str(tmp_path / "counts"))
    counts = spark.read.option("header", True).csv(str(tmp_path / "counts"))
    assert {tuple(r) for r in counts.collect()} == {("SVC", "target", "1"), ("SVC", "onehot", "1")}


def test_wide_rankings(spark, tmp_path):
    path = str(tmp_path / "rankings.csv")
    with open(path, "w") as f:
        f.write("dataset,3,3\nmodel,SVC,LR\ntuning,no,full\nscoring,ACC,F1\nonehot,0.0,1.0\ntarget,,0.0\n")
    got = {tuple(r) for r in readers.read_wide_rankings(spark, path).collect()}
    assert got == {("3", "SVC", "no", "ACC", "onehot", 0.0), ("3", "LR", "full", "F1", "onehot", 1.0),
                   ("3", "SVC", "no", "ACC", "target", None), ("3", "LR", "full", "F1", "target", 0.0)}


def test_adjacency(spark, tmp_path):
    path = str(tmp_path / "graph.adjlist")
    with open(path, "w") as f:
        f.write("# comment\na b c\nb c\nc\n")
    directed = {tuple(r) for r in readers.read_adjacency(spark, path, directed=True).collect()}
    assert directed == {("a", "b"), ("a", "c"), ("b", "c")}
    assert {tuple(r) for r in readers.read_adjacency(spark, path).collect()} == directed | {(b, a) for a, b in directed}


def test_score_reports_and_positional_target(spark, tmp_path):
    path = str(tmp_path / "best.csv")
    with open(path, "w") as f:
        f.write("approach,tuning,metric,score,fold,runtime\nlistwise,no,ndcg,0.5,1,2.5\n")
    assert tuple(readers.read_score_reports(spark, path).first()) == ("listwise", "no", "ndcg", 0.5, 1, 2.5)


def test_label_by_missing_tuple_is_an_error(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "p string, q string")
    known = spark.createDataFrame([("a", None, "first")], "p string, q string, category string")
    assert relational.label_by(df.where("p = 'a'"), ["p", "q"], known).first()["category"] == "first"
    with pytest.raises(Exception, match="no category"):
        relational.label_by(df, ["p", "q"], known).collect()


def test_parameter_grid(spark):
    assert relational.parameter_grid(spark, {"a": [1, 2], "b": ["x", "y", "z"]}).count() == 6


def test_unseen_levels(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "c string, label double")
    test = spark.createDataFrame([("z",)], "c string")
    assert encoders.OrdinalEncoder(inputCol="c", outputCol="o").fit(train).transform(test).first()["o"] == -1
    target = encoders.SmoothedTargetEncoder(inputCol="c", outputCol="o").fit(train)
    assert target.transform(test).first()["o"] == 2.0
    hot = encoders.OneHotColumns(inputCol="c", outputCol="o", handleInvalid="error").fit(train)
    with pytest.raises(Exception, match="unseen level"):
        hot.transform(test).collect()
    with pytest.raises(ValueError, match="target"):
        encoders.make_encoder("target", "c", "o", None)


def test_side_table(spark):
    side = spark.createDataFrame([(1, 1.0, None), (2, 3.0, None), (3, None, 5.0)], "dataset int, x double, y double")
    rows = spark.createDataFrame([(1,), (2,), (3,), (9,)], "dataset int")
    model = features.SideTableFeatures(threshold=0.5).on(side).fit(rows.where("dataset < 9"))
    assert model.feature_names() == ["dataset_metafeature_0"]
    got = {r["dataset"]: r["dataset_metafeature_0"] for r in model.transform(rows).collect()}
    assert got[1] == pytest.approx(-(1.5 ** 0.5)) and got[2] == pytest.approx(1.5 ** 0.5)
    assert got[3] == 0.0 and got[9] is None
    nothing = features.SideTableFeatures(threshold=0.0).on(side).fit(rows)
    assert nothing.feature_names() == []


def test_walks_and_embeddings(spark):
    tree = spark.createDataFrame([(f"n{i}", f"n{(i - 1) // 2}") for i in range(1, 8)], "src string, dst string")
    edges = {tuple(r) for r in readers.both_directions(tree).collect()}
    walks = graph.random_walks(tree, 6, 2, seed=3).collect()
    assert len(walks) == 16 and all(len(r["path"]) == 6 for r in walks)
    assert all(pair in edges for r in walks for pair in zip(r["path"], r["path"][1:]))
    again = graph.random_walks(tree, 6, 2, seed=3).collect()
    assert sorted(map(str, walks)) == sorted(map(str, again))
    biased = graph.random_walks(tree, 4, 1, seed=3, p=4.0, q=0.5).collect()
    assert len(biased) == 8 and all(pair in edges for r in biased for pair in zip(r["path"], r["path"][1:]))
    early = graph.poincare_embedding(tree, 2, epochs=1)
    late = graph.poincare_embedding(tree, 2, epochs=25, alpha=0.5, burn_in=0.08)
    assert all(sum(x * x for x in r["vec"]) < 1 for r in late.collect())
    assert graph.poincare_loss(late, tree).first()["loss"] < graph.poincare_loss(early, tree).first()["loss"]


def test_null_ratio_counts_each_factor_for_itself(spark):
    from rankloom.operators.profile import null_ratio_by_level

    df = spark.createDataFrame([("a", "x", 1.0), ("a", None, None), (None, "x", None)], "f string, h string, v double")
    got = {(r["factor"], r["level"]): (r["cells"], r["nulls"]) for r in null_ratio_by_level(df, ["f", "h"], "v").collect()}
    assert got == {("f", "a"): (2, 1), ("h", "x"): (2, 1)}


def test_pivot_refuses_unlisted_items(spark):
    from rankloom.operators.reshape import pivot_target

    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 2)], "g string, item string, r int")
    with pytest.raises(Exception, match="not among the listed items"):
        pivot_target(df, ["g"], "item", "r", items=["a"]).collect()


def test_restored_lists_repeat_no_row(spark):
    from rankloom.operators.lists import restore_lists

    rows = spark.createDataFrame([("g", "a"), ("g", "b"), ("g", "c")], "g string, item string")
    drawn = spark.createDataFrame([("g", ["a", "b"], [1.0, 2.0]), ("g", ["a"], [3.0])],
                                  "g string, items array<string>, predictions array<double>")
    got = sorted((r["item"], r["rank_pred"]) for r in restore_lists(rows, drawn, ["g"], "item").collect())
    assert got == [("a", 2.0), ("b", 2.0), ("c", 0.0)]


def test_binarizer_of_a_single_rank(spark):
    from rankloom.operators.targets import RankBinarizer

    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, r int")
    model = RankBinarizer("r").fit(df)
    assert sorted(map(tuple, model.inverse(model.transform(df)).collect())) == [("a", 0), ("b", 0)]
    assert df.select(F.size(model.steps())).first()[0] == 0


def test_wide_rankings_keep_items_named_like_a_header(spark, tmp_path):
    from rankloom.sources.readers import read_wide_rankings

    text = 'dataset,1,"2"\nmodel,"m, n",m\ntuning,t,t\nscoring,s,s\nencoder,,\nmodel,1,2\nplain,,4.5\n'
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text(text)
    got = sorted((r["model"], r["encoder"], r["rank"]) for r in read_wide_rankings(spark, str(tmp_path)).collect() if r["rank"])
    assert got == [("m", "model", 2.0)] * 2 + [("m", "plain", 4.5)] * 2 + [("m, n", "model", 1.0)] * 2
