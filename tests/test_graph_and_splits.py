"""Walk factors and folds of sorted groups against plain code."""

import itertools
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rankloom.operators import graph, splits


def test_cooccurrences_are_the_plain_ones(spark):
    paths = [list("abcab"), list("ba"), ["c"], [], list("aaad")]
    want = Counter()
    for p in paths:
        for i, j in itertools.combinations(range(len(p)), 2):
            if j - i <= 2 and p[i] != p[j]:
                want[p[i], p[j]] += 1
                want[p[j], p[i]] += 1
    walks = spark.createDataFrame([(p,) for p in paths], "path array<string>")
    got = {(r["a"], r["b"]): r["n"] for r in graph.cooccurrences(walks, 2).collect()}
    assert got == dict(want)
    total, per = sum(want.values()), Counter()
    for (a, _), n in want.items():
        per[a] += n
    for r in graph.positive_information(graph.cooccurrences(walks, 2)).collect():
        assert abs(r["weight"] - np.log(r["n"] * total / per[r["a"]] / per[r["b"]])) < 1e-12 and r["weight"] > 0


def test_walk_factors_bring_neighbours_together(spark):
    """Two cliques and one edge between them: members of a clique point the same way."""
    edges = [(f"{c}{i}", f"{c}{j}") for c in "xy" for i, j in itertools.combinations(range(6), 2)] + [("x0", "y0")]
    df = spark.createDataFrame(edges, "src string, dst string")
    found = {r["node"]: np.array(r["vec"]) for r in graph.walk_factors(df, dimensions=4, length=10, walks=8).collect()}
    assert sorted(found) == sorted({n for e in edges for n in e}) and all(len(v) == 4 for v in found.values())

    def cosine(a, b):
        return found[a] @ found[b] / np.linalg.norm(found[a]) / np.linalg.norm(found[b])

    near = [cosine(f"{c}{i}", f"{c}{j}") for c in "xy" for i, j in itertools.combinations(range(1, 6), 2)]
    far = [cosine(f"x{i}", f"y{j}") for i in range(1, 6) for j in range(1, 6)]
    assert min(near) > max(far)


def test_folds_of_sorted_groups(spark):
    """One value of the first factor holds most groups, another factor has many values."""
    keys = [("a", i) for i in range(70)] + [("b", 3), ("c", 1), ("c", 2)] + [(f"d{i}", 0) for i in range(20)]
    df = spark.createDataFrame(keys * 2, "f string, g int").repartition(5)
    got = {(r["f"], r["g"]): r["fold"] for r in splits.group_kfold_keys(df, ["f", "g"], 4, seed=None).collect()}
    cut = np.array_split(np.arange(len(keys)), 4)
    assert got == {k: n for n, part in enumerate(cut) for k in [sorted(keys)[i] for i in part]}
    one = splits.group_kfold_keys(df, ["g"], 3, seed=None)
    assert Counter(r["fold"] for r in one.collect()) == Counter(n for n, part in enumerate(np.array_split(np.arange(70), 3)) for _ in part)
    assert splits.group_kfold_keys(df.where("false"), ["f"], 3, seed=None).collect() == []
    assert one.select(F.max("fold")).first()[0] == 2
