"""Iterative fits on small tables, neighbours by a matrix product, walks that look edges up, common texts of large hosts."""

import numpy as np
import pytest
from pyspark.ml import classification
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rankloom import session
from rankloom.models import gradient, multi_tree, neighbours
from rankloom.models.estimators import make_estimator
from rankloom.operators import graph
from rankloom.session import LEAST_PACKED, packed


def test_packed_keeps_rows_in_few_partitions(spark):
    with packed(spark.range(1000).repartition(60)) as few, packed(spark.range(30).repartition(3)) as same:
        assert few.rdd.getNumPartitions() == LEAST_PACKED and same.rdd.getNumPartitions() == 3
        assert sorted(r["id"] for r in few.collect()) == list(range(1000))


def test_a_fit_starts_few_tasks(spark, monkeypatch):
    seen, summed = [], gradient.summed
    monkeypatch.setattr(gradient, "summed", lambda rows, of, w, parts: seen.append(rows.rdd.getNumPartitions()) or summed(rows, of, w, parts))
    rows = spark.range(200).select(F.array(F.col("id").cast("double")).alias("x"), (F.col("id") * 2.0).alias("y")).repartition(50)

    def of(batch, w):
        x, y = gradient.matrix(batch.column("x"))[:, 0], batch.column("y").to_numpy()
        off = x * w[0] - y
        return 0.5 * float(off @ off), np.array([x @ off])

    assert gradient.fitted(rows, of, np.zeros(1), 20)[0] == pytest.approx(2.0)
    assert set(seen) == {LEAST_PACKED}


@pytest.mark.parametrize("n, m, k", [(300, 500, 6), (100, 3000, 5), (50, 3, 5), (20, 1, 2)])
def test_closest_rows_as_brute_force(n, m, k):
    rng = np.random.default_rng(0)
    # Many ties and copies, far from the origin.
    targets = rng.integers(-3, 4, (m, 8)) / 4.0 + 1000
    queries = np.concatenate([targets[: min(m, n) // 2], rng.integers(-3, 4, (n - min(m, n) // 2, 8)) / 4.0 + 1000])
    apart = np.sqrt(((queries[:, None] - targets[None]) ** 2).sum(-1))
    best = np.argsort(apart, axis=1, kind="stable")[:, :k]
    q, t, d = neighbours.closest_rows(queries, targets, k)
    assert (q == np.repeat(np.arange(n), min(k, m))).all() and (t == best.ravel()).all()
    assert (d == np.take_along_axis(apart, best, 1).ravel()).all()


def test_neighbours_of_repeated_keys(spark):
    """Rows with a query's own key don't take the places of its neighbours, however many there are."""
    df = spark.createDataFrame([(0, [0.0])] * 9 + [(i, [float(i)]) for i in range(1, 6)], "id int, v array<double>")
    near = neighbours.nearest_neighbours(df, df.where("id = 5"), "id", "v", 3, exclude_self=True)
    assert [(r["neighbour"], r["distance"]) for r in near.orderBy("position").collect()] == [(4, 1.0), (3, 2.0), (2, 3.0)]
    near = neighbours.nearest_neighbours(df, df.where("id = 0").limit(1), "id", "v", 3, exclude_self=True)
    assert [r["neighbour"] for r in near.orderBy("position").collect()] == [1, 2, 3]


def test_walks_do_not_deal_the_edges_again(spark, monkeypatch):
    plans, durable = [], graph.durable
    monkeypatch.setattr(graph, "durable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or durable(df))
    edges = spark.createDataFrame([(f"a{i}", f"b{(i * 7 + j) % 20}") for i in range(20) for j in range(3)], "src string, dst string")
    walks = graph.random_walks(edges, 4, 2, seed=3)
    assert walks.count() == 80 and all(len(r["path"]) == 4 for r in walks.collect())
    assert "InMemoryTableScan" in plans[-1]


def test_common_texts_of_a_large_host(spark, monkeypatch, tmp_path):
    """A text that pages ** 0.7 pages show at its place is template, also where that is less than one page in ten."""
    from rankloom.llm import style_tree as st

    seen = spark.createDataFrame(
        [(1, st._hash(""), 7, 0, 5, 1, 100_000), (1, 11, st._hash(""), 0, 0, 0, 100_000), (1, 11, st._hash(""), 1, 21, 9, 4000),
         (1, 11, st._hash(""), 1, 22, 9, 3000), (1, 11, st._hash(""), 1, 23, 9, 2)], st._COUNTS)
    monkeypatch.setattr(st, "observed", lambda pages: seen)
    monkeypatch.setattr(st, "compact", lambda df, n: df)
    monkeypatch.setattr(st, "written", lambda df, name: df)
    found = st.importance(spark.range(1)).first()["important"]
    assert found[11 ^ 21] < 1 - st.USUAL and (11 ^ 23) not in found
    assert found.get(11 ^ 22, 1.0) >= 1 - st.USUAL


def test_packed_deals_rows_of_one_partition(spark, monkeypatch):
    monkeypatch.setattr(session, "PACKED_ROWS", 100)
    lopsided = spark.range(2000).coalesce(1).union(spark.range(2000, 2003).coalesce(1))
    with packed(lopsided) as rows:
        each = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert len(each) >= 2 and max(each) <= 2 * 2003 / len(each)
        assert sorted(r["id"] for r in rows.collect()) == list(range(2003))


def test_one_vs_rest_shares_the_cores(spark, monkeypatch):
    seen, fit = [], classification.OneVsRest._fit
    monkeypatch.setattr(classification.OneVsRest, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    rows = [(Vectors.dense([float(i % 3 == 0), float(i % 3 == 1)]), float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label"]).repartition(40)
    model = make_estimator("svc_classifier").fit(df)
    assert seen == [max(1, -(-spark.sparkContext.defaultParallelism // 4))]
    assert model.transform(df).where("prediction = label").count() == 60


def test_adaboost_asks_each_tree_once(spark):
    rows = [(Vectors.dense([float(i), float(i * 7 % 30)]), float((i > 11) + (i * 7 % 30 > 17))) for i in range(30)]
    df = spark.createDataFrame(rows, ["features", "label"])
    model = make_estimator("adaboost_classifier", rounds=4).fit(df)
    votes = [[0.0] * 3 for _ in rows]
    for tree, alpha in zip(model.trees, model.getOrDefault("alphas")):
        for i, r in enumerate(tree.transform(df).orderBy(vector_to_array("features")).collect()):
            votes[i][int(r[tree.getPredictionCol()])] += alpha
    scored = model.transform(df)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(features") == len(model.trees) > 1 and "lambdafunction" not in plan
    assert sorted(scored.columns) == ["features", "label", "prediction"]
    assert [r["prediction"] for r in scored.orderBy(vector_to_array("features")).collect()] == [float(v.index(max(v))) for v in votes]
    assert model.transform(df.limit(0)).collect() == []


def _boosted(spark, rows, **settings):
    df = spark.createDataFrame(rows, ["features", "label"]).repartition(3)
    tables = make_estimator("boosting_classifier", depth=3, **settings).fit(df).tables["trees"]
    return sorted((r["tree"], r["node"], r["feature"], r["threshold"], r["step"]) for r in tables.where("tree >= 0").fillna(-9.0).collect())


def test_boosting_counts_features_by_chunks(spark, monkeypatch):
    """The same trees, of equal columns by the first, however features are dealt to chunks and whatever a bin number's size is."""
    draw = np.random.default_rng(5).uniform(-1, 1, size=(150, 2)).round(6)
    rows = [(Vectors.dense([a, a, b, b]), float((a > 0.2) + (b > -0.1) * (a > -0.5))) for a, b in draw.tolist()]
    whole = _boosted(spark, rows, rounds=2, bins=256)
    assert len(whole) > 8 and {t[2] for t in whole} <= {-1, 0, 2}
    for cells, bins in ((1, 256), (1 << 13, 256), (1, 400)):
        monkeypatch.setattr(multi_tree, "CHUNK_CELLS", cells)
        assert _boosted(spark, rows, rounds=2, bins=bins, localRows=20) == whole


def test_a_round_of_boosting_reads_its_rows_few_times(spark):
    rows = [(Vectors.dense([float(i), float(i * 7 % 30)]), float((i > 11) + (i * 7 % 30 > 17))) for i in range(30)]
    jobs = {}
    for rounds in (2, 5):
        spark.sparkContext.setJobGroup(f"boost{rounds}", "")
        _boosted(spark, rows, rounds=rounds)
        jobs[rounds] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boost{rounds}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # A round grows a tree and sums its leaves, each in two steps; new scores are made once, when next read.
    assert jobs[5] - jobs[2] <= 3 * 5
