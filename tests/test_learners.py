"""Models beyond Spark's own against plain versions, finite differences and golden data; samplers against random draws."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from rankloom.models import gradient, list_network, multi_tree, networks
from rankloom.models.boosting import AdaBoostClassifier, AdaBoostModel, SoftmaxBooster, SoftmaxBoosterModel
from rankloom.models.estimators import make_estimator
from rankloom.models.list_network import ListScorer, order_loss
from rankloom.models.multi_tree import MultiOutputTree, MultiOutputTreeModel
from rankloom.operators.encoders import MixedModelEncoder, MixedModelEncoderModel, make_encoder, random_intercepts
from rankloom.plans import samplers


def frame(spark, x, y, parts=3):
    kind = "array<double>" if isinstance(y[0], list) else "double"
    return spark.createDataFrame([(list(map(float, a)), b) for a, b in zip(x, y)], f"x array<double>, label {kind}").select(
        array_to_vector("x").alias("features"), "label").repartition(parts)


def numeric_gradient(loss, w, step=1e-6):
    out = np.zeros(len(w))
    for i in range(len(w)):
        up, down = w.copy(), w.copy()
        up[i] += step
        down[i] -= step
        out[i] = (loss(up) - loss(down)) / (2 * step)
    return out


# --- one tree for many outputs --------------------------------------------------------------------------------------

def plain_tree(x, y, depth=None, leaf=1, split=2):
    """Every split of every feature, at values half way between neighbours; the first of the best."""
    def best(rows):
        found, whole = None, y[rows].sum(axis=0)
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for v in (values[:-1] + values[1:]) / 2:
                left = rows[x[rows, f] <= v]
                right = rows[x[rows, f] > v]
                if min(len(left), len(right)) < leaf:
                    continue
                gain = (y[left].sum(axis=0) ** 2).sum() / len(left) + (y[right].sum(axis=0) ** 2).sum() / len(right) - (
                    whole @ whole) / len(rows)
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = (gain, left, right)
        return found

    out = np.zeros_like(y)
    open_ = [(np.arange(len(x)), 0)]
    while open_:
        rows, level = open_.pop()
        found = best(rows) if len(rows) >= max(2, split, 2 * leaf) and (depth is None or level < depth) else None
        if found is None:
            out[rows] = y[rows].mean(axis=0)
        else:
            open_ += [(found[1], level + 1), (found[2], level + 1)]
    return out


def grid(n=120, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, size=(n, 4)).astype(float)
    y = np.stack([x[:, 0] * 3 + x[:, 1], 20 - x[:, 2], (x[:, 0] > 5) * x[:, 3]], axis=1) + rng.integers(0, 3, size=(n, 3))
    return x, y


def by_row(model, spark, x):
    rows = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "i int, x array<double>")
    out = model.transform(rows.select("i", array_to_vector("x").alias("features"))).orderBy("i").collect()
    return np.array([r["prediction"] for r in out])


@pytest.mark.parametrize("local, settings", [
    (1 << 15, {}), (1 << 15, {"depth": 3}), (1 << 15, {"leaf": 4}), (1 << 15, {"split": 30}), (25, {}),
    (25, {"depth": 5, "leaf": 2, "split": 9}), (1, {"depth": 4, "leaf": 3})])
def test_multi_output_tree_is_the_plain_tree(spark, local, settings):
    x, y = grid()
    model = MultiOutputTree(localRows=local, **settings).fit(frame(spark, x, y.tolist()))
    assert np.allclose(by_row(model, spark, x), plain_tree(x, y, **settings))


def test_multi_output_tree_is_the_same_however_it_grew(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(500, 5)), rng.normal(size=(500, 2))
    made = []
    settings = [(1 << 15, 1, 1 << 23), (1 << 15, 5, 1 << 23), (60, 5, 1 << 23), (1, 3, 50)]
    for (local, parts, held), subset in itertools.product(settings, ("all", "sqrt")):
        monkeypatch.setattr(multi_tree, "HELD_CELLS", held)
        model = MultiOutputTree(depth=3, bins=16, localRows=local, subset=subset, seed=5).fit(frame(spark, x, y.tolist(), parts))
        made.append((subset, sorted(map(str, model.tables["nodes"].collect()))))
    for subset in ("all", "sqrt"):
        mine = [m for s, m in made if s == subset]
        assert len(mine) > 3 and all(m == mine[0] for m in mine)
    assert made[0][1] != made[1][1]


def test_multi_output_tree_deeper_than_thirty(spark):
    x = np.eye(40)  # every split takes one row away
    model = MultiOutputTree().fit(frame(spark, x, [[float(i * i)] for i in range(40)], 1))
    assert model.depth_reached() == 39


def test_multi_output_tree_odd_input(spark, tmp_path):
    same = frame(spark, [[1.0, 2.0]] * 9, [[3.0, 4.0]] * 9)
    assert len(MultiOutputTree().fit(same).tables["nodes"].collect()) == 1
    one = MultiOutputTree().fit(same.limit(1).unionByName(same.limit(1).withColumn("label", F.lit(None).cast("array<double>"))))
    assert one.transform(same.limit(1)).first()["prediction"] == [3.0, 4.0]
    with pytest.raises(ValueError):
        MultiOutputTree().fit(same.limit(0))
    with pytest.raises(ValueError):
        MultiOutputTree(subset="some").fit(same)
    x, y = grid(60)
    model = MultiOutputTree(depth=3).fit(frame(spark, x, y.tolist()))
    model.write().save(str(tmp_path / "tree"))
    assert (by_row(MultiOutputTreeModel.load(str(tmp_path / "tree")), spark, x) == by_row(model, spark, x)).all()


# --- sums over rows, perceptron, support vectors, kernels -----------------------------------------------------------

def test_sums_do_not_depend_on_blocks_or_tasks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(90, 7)), rng.normal(size=90)
    of, w = networks.tube_error(0.1, np.zeros(7), np.ones(7)), rng.normal(size=8)
    rows = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "x array<double>, y double")
    want = [gradient.summed(rows.repartition(1), of, w, 1)]
    monkeypatch.setattr(gradient, "DIRECT_DOUBLES", 0)
    monkeypatch.setattr(gradient, "BLOCK_DOUBLES", 3)
    want += [gradient.summed(rows.repartition(p), of, w, p) for p in (3, 100)]
    for loss, g in want[1:]:
        assert math.isclose(loss, want[0][0]) and np.allclose(g, want[0][1])
    monkeypatch.setattr(gradient, "MAX_WEIGHTS", 7)
    with pytest.raises(ValueError):
        gradient.summed(rows, of, w, 1)


def test_minimiser():
    def valley(w):
        a, b = w
        return (1 - a) ** 2 + 100 * (b - a * a) ** 2, np.array([-2 * (1 - a) - 400 * a * (b - a * a), 200 * (b - a * a)])

    assert np.allclose(gradient.minimised(valley, np.array([-1.2, 1.0]), 200, 1e-14), [1, 1], atol=1e-4)


def test_gradients_by_finite_differences():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(11, 3)), rng.normal(size=11)
    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist()), pa.array(y)], names=["x", "y"])
    sizes = [3, 5, 4, 1]
    for of, w in ((networks.squared_error(sizes), networks.start_weights(sizes, rng)),
                  (networks.tube_error(0.2, x.mean(axis=0), x.std(axis=0)), rng.normal(size=4))):
        assert np.allclose(of(batch, w)[1], numeric_gradient(lambda v: of(batch, v)[0], w), atol=1e-5)


def wave(n=300):
    rng = np.random.default_rng(4)
    x = rng.uniform(-2, 2, size=(n, 2))
    return x, np.sin(2 * x[:, 0]) * x[:, 1]


@pytest.mark.parametrize("kind, settings, share", [
    ("mlp", {"hidden": [20], "maxIter": 60}, 0.15), ("kernel_svr", {"components": 100, "maxIter": 25}, 0.15)])
def test_non_linear_regressors(spark, tmp_path, kind, settings, share):
    x, y = wave()
    model = make_estimator(kind, **settings).fit(frame(spark, x, y.tolist()))
    assert np.mean((by_row(model, spark, x) - y) ** 2) < share * y.var()
    PipelineModel(stages=[model]).write().save(str(tmp_path / kind))
    assert (by_row(PipelineModel.load(str(tmp_path / kind)), spark, x) == by_row(model, spark, x)).all()


def test_support_vectors_ignore_small_errors(spark):
    x = [[float(i), 5.0] for i in range(40)]
    y = [2.0 * i + 1 + (0.3 if i % 2 else -0.3) for i in range(40)]
    model = make_estimator("svr", epsilon=0.5, cost=1e4, maxIter=25).fit(frame(spark, x, y))
    off = np.abs(by_row(model, spark, x) - (2 * np.arange(40) + 1))
    assert off.max() < 0.25


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(30, 4))
    df = frame(spark, x, [0.0] * 30)
    model = networks.RandomFourierFeatures(components=4000, gamma=0.3).fit(df)
    z = np.array([r["fourier"].toArray() for r in model.transform(
        spark.createDataFrame([(v.tolist(),) for v in x], "x array<double>").coalesce(1).select(array_to_vector("x").alias("features"))).collect()])
    true = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - true).max() < 5 / math.sqrt(4000)
    own = networks.RandomFourierFeatures().fit(df)
    assert math.isclose(own.getOrDefault("gamma"), 1 / (4 * x.var()), rel_tol=1e-9)


def test_kernel_machine_separates_what_no_line_does(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(-1, 1, size=(300, 2))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    model = make_estimator("kernel_svc_classifier", components=100, iterations=20).fit(frame(spark, x, y.tolist()))
    assert (by_row(model, spark, x) == y).mean() > 0.9
    line = make_estimator("svc_classifier", iterations=20).fit(frame(spark, x, y.tolist()))
    assert (by_row(line, spark, x) == y).mean() < 0.75


# --- boosting -------------------------------------------------------------------------------------------------------

def rings(n=240):
    rng = np.random.default_rng(7)
    x = rng.uniform(-1, 1, size=(n, 2))
    return x, np.minimum(2, (np.abs(x).max(axis=1) * 3).astype(int)).astype(float)


def test_softmax_rounds_lower_the_loss(spark, tmp_path):
    x, y = rings()
    df = frame(spark, x, y.tolist())
    losses, made = [], {}
    for rounds in (1, 2, 5):
        model = made[rounds] = SoftmaxBooster(rounds=rounds, depth=3, rate=0.5).fit(df)
        p = model.transform(df).select("label", "probabilities").collect()
        losses.append(-np.mean([math.log(r["probabilities"][int(r["label"])]) for r in p]))
        assert all(abs(sum(r["probabilities"]) - 1) < 1e-9 for r in p)
    assert losses == sorted(losses, reverse=True) and losses[-1] < 0.5 < losses[0] < math.log(3)
    assert (by_row(model, spark, x) == y).mean() > 0.95
    cut = SoftmaxBooster(rounds=2, depth=3, rate=0.5, localRows=60).fit(df)
    assert np.allclose(by_row(cut, spark, x), by_row(made[2], spark, x))
    model.write().save(str(tmp_path / "boost"))
    assert (by_row(SoftmaxBoosterModel.load(str(tmp_path / "boost")), spark, x) == by_row(model, spark, x)).all()


def stump_errors(x, y, rounds):
    """SAMME with the best stump by weighted impurity, all of it by hand."""
    w, errors, classes = np.ones(len(x)), [], int(y.max()) + 1

    def impurity(rows):
        share = np.bincount(y[rows].astype(int), w[rows], minlength=classes)
        return share.sum() - (share ** 2).sum() / max(share.sum(), 1e-300)

    for _ in range(rounds):
        found = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for v in (values[:-1] + values[1:]) / 2:
                left = x[:, f] <= v
                cost = impurity(left) + impurity(~left)
                if found is None or cost < found[0] - 1e-12:
                    found = (cost, left)
        left = found[1]
        guess = np.where(left, *(np.bincount(y[s].astype(int), w[s], minlength=classes).argmax() for s in (left, ~left)))
        miss = guess != y
        errors.append(w[miss].sum() / w.sum())
        alpha = math.log((1 - errors[-1]) / errors[-1]) + math.log(classes - 1)
        w = w * np.where(miss, math.exp(alpha), 1.0)
        w /= w.mean()
    return errors


def test_adaboost_errors_are_the_plain_ones(spark, tmp_path):
    rng = np.random.default_rng(8)
    x = rng.permuted(np.tile(np.arange(30.0), (2, 4)), axis=1).T
    y = ((x[:, 0] > 11) + (x[:, 1] > 17)).astype(float)
    model = AdaBoostClassifier(rounds=5).fit(frame(spark, x, y.tolist()))
    assert np.allclose(model.getOrDefault("errors"), stump_errors(x, y, 5), atol=1e-9)
    assert (by_row(model, spark, x) == y).mean() > 0.8
    model.save(str(tmp_path / "ada"))
    assert (by_row(AdaBoostModel.load(str(tmp_path / "ada")), spark, x) == by_row(model, spark, x)).all()


def test_adaboost_stops(spark):
    x, y = [[float(i)] for i in range(20)], [float(i > 9) for i in range(20)]
    model = AdaBoostClassifier(rounds=12).fit(frame(spark, x, y))
    assert model.getOrDefault("errors") == [0.0] and (by_row(model, spark, x) == np.array(y)).all()
    with pytest.raises(ValueError):
        AdaBoostClassifier().fit(frame(spark, x, y).limit(0))


# --- lists ----------------------------------------------------------------------------------------------------------

def test_order_loss_is_the_likelihood_of_the_order():
    s = np.random.default_rng(9).normal(size=(4, 6)) * 3
    by_hand = -sum(row[i] - math.log(sum(math.exp(v) for v in row[i:])) for row in s for i in range(6))
    loss, g = order_loss(s)
    assert math.isclose(loss, by_hand)
    assert np.allclose(g.ravel(), numeric_gradient(lambda v: order_loss(v.reshape(4, 6))[0], s.ravel()), atol=1e-5)
    assert np.isfinite(order_loss(np.array([[800.0, -800.0, 0.0]]))[0])


def test_list_network_gradient():
    import pyarrow as pa

    shape = list_network._Shape([3, 2, 5], 4, [6])
    batch = pa.RecordBatch.from_arrays([
        pa.array([[1, 2], [3, 1], [-1, 2]], pa.list_(pa.int32())), pa.array([[5, 1, 2], [1, 9, 3], [4, 2, 5]], pa.list_(pa.int32()))],
        names=["g", "i"])
    w = shape.start(1)
    assert np.allclose(shape.loss(batch, w)[1], numeric_gradient(lambda v: shape.loss(batch, v)[0], w), atol=1e-5)


def test_list_scorer_learns_an_order_that_depends_on_the_group(spark):
    rows = [(g, k, i, float((i if g % 2 else 5 - i)) if i != 4 or g else None) for g in range(8) for k in range(3) for i in range(1, 6)]
    df = spark.createDataFrame(rows, "g int, k int, item int, rank double").withColumn("code", F.col("g") % 2 + 1)
    model = ListScorer(factorCols=["code"], itemCol="item", targetCol="rank", listCols=["g", "k"], hidden=[8], size=4, maxIter=30).fit(df)
    out = model.transform(df.where("k = 0")).orderBy("g", "prediction").collect()
    for g in range(8):
        order = [r["item"] for r in out if r["g"] == g]
        assert order == (sorted(order) if g % 2 else sorted(order, reverse=True))
    unseen = model.transform(spark.createDataFrame([(9, None)], "code int, item int")).first()
    assert unseen["prediction"] is not None


# --- mixed model ----------------------------------------------------------------------------------------------------

def plain_intercepts(levels, steps=4000):
    y = np.concatenate(levels)
    mean, between, error = y.mean(), np.var([v.mean() for v in levels]), np.concatenate([v - v.mean() for v in levels]).var()
    for _ in range(steps):
        b = [len(v) * between / (len(v) * between + error) * (v.mean() - mean) for v in levels]
        spread = [between * error / (len(v) * between + error) for v in levels]
        new_mean = np.concatenate([v - u for v, u in zip(levels, b)]).mean()
        new_error = sum(((v - mean - u) ** 2).sum() + len(v) * s for v, u, s in zip(levels, b, spread)) / len(y)
        between = np.mean([u * u + s for u, s in zip(b, spread)])
        mean, error = new_mean, new_error
    return mean, between, error


def test_mixed_model_encoder(spark, tmp_path):
    rng = np.random.default_rng(10)
    levels = [rng.normal(loc, 1.0, size=n) + 100 for loc, n in zip(rng.normal(0, 2, 14), [1, 1, 2, 3, 3, 5, 8, 8, 13, 20, 20, 31, 40, 60])]
    rows = [(f"l{k}", float(v)) for k, level in enumerate(levels) for v in level] + [(None, 5.0), ("l0", None)]
    df = spark.createDataFrame(rows, "c string, label double").repartition(4)
    model = MixedModelEncoder(inputCol="c", outputCol="f_c").fit(df)
    mean, between, error = plain_intercepts(levels)
    got = [model.getOrDefault(p) for p in ("mean", "between", "error")]
    assert np.allclose(got, [mean, between, error], rtol=1e-6)
    values = {r["c"]: r["f_c"] for r in model.transform(df.select("c").distinct().union(spark.createDataFrame([("new",)], "c string"))).collect()}
    for k, v in enumerate(levels):
        assert math.isclose(values[f"l{k}"], len(v) * between / (len(v) * between + error) * (v.mean() - mean), rel_tol=1e-5)
    assert values[None] == values["new"] == 0.0
    model.write().save(str(tmp_path / "glmm"))
    again = MixedModelEncoderModel.load(str(tmp_path / "glmm")).transform(df.select("c").distinct())
    assert {r["c"]: r["f_c"] for r in again.collect()} == {k: v for k, v in values.items() if k != "new"}
    assert isinstance(make_encoder("glmm", "c", "f_c", "label")[0], MixedModelEncoder)
    with pytest.raises(ValueError):
        make_encoder("glmm", "c", "f_c")


def test_mixed_model_without_spread():
    n = np.array([4.0])
    mean, between, error = random_intercepts(n, np.array([1.0]), np.array([3.0]), np.array([9.0]), 0.0)
    assert math.isclose(mean, 3.0) and between < 1e-6 and error < 1e-6


# --- samplers -------------------------------------------------------------------------------------------------------

SPACE = {"a": samplers.Real(-5.0, 5.0), "b": samplers.Integer(1, 40), "c": samplers.Choice((None, "x", "y", "z"))}


def score_of(s):
    return -((s["a"] - 2.0) ** 2) / 4 - (s["b"] - 30) ** 2 / 100 - {None: 3, "x": 0, "y": 2, "z": 4}[s["c"]]


def best_after(sampler, trials, parallel=2):
    history = []
    while len(history) < trials:
        asked = []
        for _ in range(parallel):
            asked.append(sampler.ask([*history, *((p, None) for p in asked)]))
        history += [(p, score_of(p)) for p in asked]
    return max(v for _, v in history)


@pytest.mark.parametrize("kind", ["parzen", "surrogate"])
def test_samplers_beat_random_draws(kind):
    import os
    import subprocess
    import sys

    # In a process of its own: beside a running JVM the threads of many small matrix products take minutes.
    code = (f"from tests.test_learners import *; print(sum(best_after(samplers.SAMPLERS['{kind}'](SPACE, s), 40) > "
            "best_after(samplers.RandomSampler(SPACE, s), 40) for s in range(20)))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert int(out.stdout) >= 14, out.stderr


@pytest.mark.parametrize("kind", ["random", "parzen", "surrogate"])
def test_samplers_repeat_stay_inside_and_take_failures(kind):
    def run():
        rng, sampler, history = random.Random(1), samplers.SAMPLERS[kind](SPACE, 3), []
        for t in range(30):
            s = sampler.ask(history)
            assert -5 <= s["a"] <= 5 and 1 <= s["b"] <= 40 and type(s["b"]) is int and s["c"] in SPACE["c"].values
            history.append((s, None if t % 7 == 3 else round(rng.random(), 3)))
        return history

    assert run() == run()


def test_running_trials_are_not_asked_for_again():
    history = [({"a": float(a), "b": 30, "c": "x"}, score_of({"a": float(a), "b": 30, "c": "x"})) for a in range(-5, 6)]
    sampler = samplers.SurrogateSampler({"a": SPACE["a"]}, 0)
    first = sampler.ask([({"a": s["a"]}, v) for s, v in history])
    second = sampler.ask([*(({"a": s["a"]}, v) for s, v in history), (first, None)])
    assert abs(first["a"] - second["a"]) > 1e-3
