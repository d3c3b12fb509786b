"""Searches that are guided, operators that do their whole work, walks that shuffle little."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankloom.plans import evaluate as ev
from rankloom.plans import load_catalog, model_queries, samplers
from rankloom.plans.spec import Setting


@pytest.mark.parametrize("spec", ["listwise_dimensionwise_regression", "pointwise_normalized_regression"])
def test_bayes_search_follows_its_scores(spark, monkeypatch, spec):
    """The surrogate chooses the later trials, and the best settings are cross-validated at the end."""
    rows = spark.createDataFrame([(f"d{i}", "m", "t", "s", f"e{j}", float(j)) for i in range(6) for j in range(3)],
                                 "dataset string, model string, tuning string, scoring string, encoder string, rank double")
    guided, scored = [], []
    kernel = samplers.SurrogateSampler._kernel
    monkeypatch.setattr(samplers.SurrogateSampler, "_kernel", lambda self, x, y: guided.append(len(x)) or kernel(self, x, y))

    def scores(spec, df, where, folds, mode="resample", **_):
        leaf = spec.estimator().settings["leaf"]
        scored.append((mode, leaf))
        return spark.createDataFrame([(spec.name, i, "spearman", leaf / 10, 6, 0.0) for i in range(folds)], ev.SCORES_SCHEMA)

    monkeypatch.setattr(ev, "cross_validate", scores)
    monkeypatch.setattr(model_queries, "rows_of", lambda spark, sf_dir: rows)
    monkeypatch.setattr(model_queries, "setting", lambda spark, sf_dir: Setting(["dataset", "model", "tuning", "scoring"], "encoder", "rank"))
    found = load_catalog().QUERIES[f"v8_{spec}_bayes_search"](spark, "").collect()
    trials, final = [r for r in found if r["status"] == "ok"], [r for r in found if r["status"] == "final"]
    assert len({r["trial"] for r in trials}) == 8 and len(guided) == 4 and len(found) == len(trials) + len(final)
    best = max(trials, key=lambda r: (r["score"], -r["trial"]))
    assert len(final) == 2 and all((r["trial"], r["params"], r["score"]) == (best["trial"], best["params"], best["score"]) for r in final)
    assert [m for m, _ in scored].count("resample") == 1 and scored[-1] == ("resample", int(best["params"]["estimator__leaf"]))


def test_resharding_moves_the_texts(spark):
    """Each text arrives with its row, also where ids are missing or come twice."""
    from rankloom.llm.resharding import reshard

    rows = [(i % 40 if i % 11 else None, f"text {i % 60}" * (i % 9) if i % 5 else None, "abc"[i % 3]) for i in range(150)]
    got = reshard(spark.createDataFrame(rows, "doc_id bigint, text string, part string").repartition(4), F.col("part"), 5)
    assert Counter((r["doc_id"], r["text"], "abc"[r["old_shard"]]) for r in got.collect()) == Counter(rows)
    text = F.coalesce("text", F.lit(""))
    assert got.where((F.crc32(text) != F.col("text_crc32")) | (F.octet_length(text) + 16 != F.col("size"))).isEmpty()
    assert {(r["shard"], r["slot"]) for r in got.collect()} == {
        (r["shard"], i) for r in got.groupBy("shard").count().collect() for i in range(r["count"])}


def test_a_rare_node_has_its_importance(spark, monkeypatch):
    """A text that all pages with its node share is template there, also where these are fewer than one page in a hundred."""
    from rankloom.llm import style_tree as st

    top, rows = st._hash(""), []
    rows += [(1, top, top, 0, 5, 2, 1000), (1, 11, top, 0, 0, 0, 5), (1, 11, top, 1, 21, 9, 5), (1, 12, top, 0, 0, 0, 900)]
    rows += [(1, 12, top, 1, 100 + i, 50, 1) for i in range(900)]
    rows += [(1, 13, top, 0, 0, 2, 6), (1, 13, top, 1, 22, 4, 6), (1, 14, 13, 0, 0, 0, 1), (1, 14, 13, 1, 23, 4, 1)]
    seen = spark.createDataFrame(rows, st._COUNTS)
    monkeypatch.setattr(st, "observed", lambda pages: seen)
    monkeypatch.setattr(st, "compact", lambda df, n: df)
    monkeypatch.setattr(st, "written", lambda df, name: df)
    found = st.importance(spark.range(1)).first()["important"]
    assert found[11] == pytest.approx(1 - np.log(5) / np.log(1000) + st.DOUBT / 25) and found[11] < found[st._BAR]
    assert not {12, 13, 14, top} & set(found)  # 13 has a child on one page, which is no template
    page = "<body><div class=rare>notice</div></body>"
    path = st._hash(st.blocks_of(page)[0][0].node.path)
    assert st.main_text(page, {path: found[11], st._BAR: found[st._BAR]}) == ""


def test_walks_shuffle_each_edge_few_times(spark, monkeypatch):
    """Lists of bounded length, also of hubs, give the walks that picks by place give; edges are dealt by node and by list only."""
    from rankloom.operators import graph

    edges = spark.createDataFrame(
        [("hub", f"n{i}") for i in range(40)] + [(f"n{i}", f"n{i * 7 % 40}") for i in range(40)] + [("n1", "hub"), ("n3", None)],
        "src string, dst string")
    plain = {r["src"]: [] for r in graph.neighbour_lists(edges, 3).collect()}
    for r in graph.hash_positions(graph.both_directions(edges), ["src"], ["dst"], 3, "at").orderBy("at").collect():
        plain[r["src"]].append(r["dst"])
    plans, durable = [], graph.durable
    monkeypatch.setattr(graph, "durable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or durable(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    walks = sorted(map(str, graph.random_walks(edges, 6, 3, seed=3).collect()))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("node" in x.split("hashpartitioning(")[1] for x in plans[0].split("InMemoryRelation")[0].splitlines() if "Exchange hash" in x)
    numbers = graph.nodes_of(edges).withColumn("id", F.hash("node"))
    names = {r["id"]: r["node"] for r in numbers.collect()}
    assert sorted(str([names[i] for i in r["path"]]) for r in graph.numbered_walks(edges, numbers, 6, 3, seed=3).collect()) == sorted(
        str(r["path"]) for r in graph.random_walks(edges, 6, 3, seed=3).collect())
    monkeypatch.setattr(graph, "LIST_EDGES", 4)
    for hub in (False, True):
        monkeypatch.setattr(graph, "_has_hub", lambda edges: hub)
        lists = graph.neighbour_lists(edges, 3)
        whole = {}
        for r in lists.orderBy("chunk").collect():
            whole.setdefault(r["src"], []).extend(r["dsts"])
            assert len(r["dsts"]) <= 4 and r["degree"] == len(plain[r["src"]]) and r["known"] == sum(d is not None for d in plain[r["src"]])
        assert whole == plain
        if not hub:
            assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
        assert sorted(map(str, graph.random_walks(edges, 6, 3, seed=3).collect())) == walks


def test_hubs_are_found(spark, hot):
    from rankloom.operators import graph

    assert not graph._has_hub(spark.createDataFrame([(f"a{i}", f"b{i}") for i in range(40)], "src string, dst string"))
    assert graph._has_hub(spark.createDataFrame([("a", f"b{i}") for i in range(6)], "src string, dst string"))
    assert not graph._has_hub(spark.createDataFrame([("a", "b")] * 9, "src string, dst string"))


def test_totals_of_meetings(spark):
    from rankloom.operators import graph

    walks = spark.createDataFrame([(list("abcab"),), (list("ba"),), (["c"],), ([],), (list("aaad"),)], "path array<string>")
    met = graph.meetings(walks, 2)
    want = graph.positive_information(met, once=True).orderBy("a", "b").collect()
    assert graph.positive_information(met, once=True, totals=graph.meeting_totals(walks, 2)).orderBy("a", "b").collect() == want


def test_every_row_teaches_quality(spark, monkeypatch):
    """Each row is fitted in one task, where it is unlabelled, and positives in as many as need them; two limits hold for a task."""
    from rankloom.llm import quality

    monkeypatch.setattr(quality, "MAX_POSITIVES", 20)
    monkeypatch.setattr(quality, "MAX_UNLABELLED", 40)
    monkeypatch.setattr(quality, "minimise", lambda positive, unlabelled, prior: (
        np.eye(1, quality.DIMENSIONS + quality.STATISTICS)[0] * 0 + positive.size, float(unlabelled.size)))
    docs = spark.createDataFrame([(i, f"word{i % 7}. " * (5 + i % 9) + str(i)) for i in range(400)], "doc_id bigint, text string")
    for positives in (200, 30):  # their own groups, or shared ones
        labels = spark.createDataFrame([(i, int(i < positives)) for i in range(400)], "doc_id bigint, quality int")
        fitted = quality.fit(docs, labels, F.lit(True)).weights[0] * 10  # the mean of the ten tasks
        assert fitted == pytest.approx(200 if positives == 200 else 5 * 30)
    packed = docs.select(quality._packed("text").alias("p"), "text").collect()
    one, two = quality._Table.of([r["p"] for r in packed]), quality._Table(pa.array([r["text"] for r in packed]))
    assert all((getattr(one, k) == getattr(two, k)).all() for k in ("at", "row", "value", "statistics")) and one.size == two.size == 400
