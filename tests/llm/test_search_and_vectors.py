"""Ranked search, lattice near-duplicates and exact clustering against brute force on small tables with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.llm import centroids, lattice, treap

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- ranked search --------------------------------------------------------------------------------------------------

def terms_of(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, k):
    """Every item against every document."""
    split = [terms_of(t) for _, t in docs]
    n_docs, total = sum(1 for t in split if t), sum(map(len, split))
    df = Counter(x for t in split for x in set(t))
    out = []
    for item, text in items:
        scores = []
        for (doc, _), words in zip(docs, split):
            tf, score = Counter(words), 0
            for term in set(terms_of(text)):
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 90 + 90 * len(words) * n_docs // total
                    score += w * (1_000_000_000 * tf[term] // (1000 * tf[term] + 8 * m))
            if score:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return Counter(out)


def texts():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)] + ["Ärger", "ÄRGER", "é1", "日本", "x", "The"]
    made = [" ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.choice([1, 3, 20, 80]))) for _ in range(150)]
    made += [None, "", " \n.,- ", "x " * 5000, made[3], made[3], made[3].upper(), "a\x00b\x7fc"]
    docs = [(None if i % 31 == 7 else 500 - i, t) for i, t in enumerate(made)] + [(500, made[0])] * 3
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 4, 30])))) for i in range(12)]
    items += [(3, "w1 w1 W1"), (None, "w2 日本"), (99, None), (98, "..."), (97, "absent"), (96, "C b")]
    return docs, items


@pytest.mark.parametrize("block, slice_", [(4096, 200_000), (16, 30)])
def test_search(spark, monkeypatch, block, slice_):
    monkeypatch.setattr(treap, "BLOCK_DOCUMENTS", block)
    monkeypatch.setattr(treap, "TERMS_PER_SLICE", slice_)
    docs, items = texts()
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    got = Counter(tuple(r) for r in treap.search(df, asked, 5).collect())
    assert got == ranked(docs, items, 5)


def test_search_in_small_blocks_of_one_task(monkeypatch):
    """Blocks, batches that halve few ranges, and a full arena give the same as one pass over all."""
    monkeypatch.setattr(treap, "ARENA", 64)
    rng = np.random.default_rng(1)
    best, plain = treap.Best(9, 4), treap.Best(9, 4)
    rows = [np.flatnonzero(rng.random(40) < p) for p in (0, 0.05, 0.3, 0.9, 1, 0.1, 0.2, 0.5, 0.02)]
    for _ in range(6):
        cells = np.unique(rng.integers(0, 40 * 70, 900))
        row, column, impact = cells // 70, cells % 70, rng.integers(1, 9, len(cells)) ** 3
        ids, null = rng.integers(0, 90, 70), rng.random(70) < 0.1
        ids[null] = treap._LAST
        treap.descend(treap.K2Treap(row, column, impact, 70), rows, ids, null, best)
        for item, mine in enumerate(rows):
            score = np.bincount(column[np.isin(row, mine)], impact[np.isin(row, mine)], minlength=70).astype(np.int64)
            hit = np.flatnonzero(score)
            plain.add(np.full(len(hit), item), score[hit], ids[hit], null[hit])
    assert (best.score == plain.score).all() and (best.id == plain.id).all()


def test_search_prunes():
    rng = np.random.default_rng(2)
    column = np.arange(4096)
    impact = rng.integers(1, 1000, 4096)
    best = treap.Best(1, 10)
    halved = treap.descend(treap.K2Treap(np.zeros(4096, dtype=np.int64), column, impact, 4096), [np.array([0])], column,
                           np.zeros(4096, dtype=bool), best)
    assert halved < 600 and best.score[0, 0] == impact.max()


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert treap.search(none, items).collect() == []
    assert treap.search(none.withColumn("text", F.lit("a")), items.limit(0)).collect() == []


# --- lattice near-duplicates ----------------------------------------------------------------------------------------

def test_nearest_lattice_point():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    near = lattice.nearest_e8(x)
    own = ((x - near) ** 2).sum(axis=1)
    assert ((2 * near).sum(axis=1) % 4 == 0).all() and (np.ptp(np.mod(near, 1), axis=1) == 0).all()
    for v in lattice._shells():
        assert (((x - near - v) ** 2).sum(axis=1) >= own - 1e-9).all()
    assert len(lattice._shells()) == 240 + 2160


def linked(rows, threshold=0.98):
    """n_links and component of each row, by comparing all."""
    good = [label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
            for _, label, v in rows]
    n = len(rows)
    near = [[] for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and good[i] and good[j] and rows[i][1] == rows[j][1] and len(rows[i][2]) == len(rows[j][2]):
                a, b = (np.array(rows[k][2]) / np.abs(rows[k][2]).max() for k in (i, j))
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= threshold:
                    near[i].append(j)
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in near[i]:
                if label[j] < label[i]:
                    label[i], changed = label[j], True
    least = {c: min((rows[i][0] for i in range(n) if label[i] == c and rows[i][0] is not None), default=None) for c in label}
    return Counter((rows[i][0], len(near[i]), least[label[i]], rows[i][0] == least[label[i]]) for i in range(n))


def vectors(size=64):
    """Random ones, pairs close to the threshold on both sides, a chain, a large group of near copies, and odd rows."""
    rng = np.random.default_rng(7)
    made = [rng.normal(size=size) for _ in range(60)]

    def beside(v, cosine):
        v = v / np.linalg.norm(v)
        off = rng.normal(size=size)
        off -= off @ v * v
        return cosine * v + math.sqrt(1 - cosine ** 2) * off / np.linalg.norm(off)

    made += [beside(made[i], c) * 10 ** (i - 20) for i in range(40) for c in (0.9801, 0.9799, 0.99, 0.9)]
    chain = [made[0]]
    for _ in range(12):
        chain.append(beside(chain[-1], 0.985))
    made += chain[1:]
    made += [beside(made[1], 0.99 + 0.00999 * rng.random()) for _ in range(60)] + [made[1]] * 8
    made += [-made[1], made[1] * 1e-200, np.zeros(size)]
    rows = [(None if i % 41 == 3 else 900 - i, i // 3 % 2 if i < 60 else (i - 60) // 4 // 3 % 2 if i < 220 else 0, v.tolist())
            for i, v in enumerate(made)]
    rows += [(5, None, made[1].tolist()), (6, 0, None), (7, 0, []), (8, 0, [None, *made[1][1:].tolist()]),
             (9, 0, [math.nan, *made[1][1:].tolist()]), (10, 0, [math.inf, *made[1][1:].tolist()]),
             (11, 0, made[1][:32].tolist()), (12, 0, made[1][:32].tolist()), (13, 0, [1.0]), (14, 0, [2.0]), (15, 0, [-1.0]),
             rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("block", [4096, 32])
def test_lattice_links(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    monkeypatch.setattr(lattice, "COUNTED", 1)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>").withColumns(
        {"cell": F.lit("x"), "key": F.lit(1), "node": F.lit(2)})
    got = Counter(tuple(r) for r in lattice.near_duplicates(df).collect())
    want = linked(rows)
    assert got == Counter((a, n, c, bool(k) if a is not None or c is not None else True) for a, n, c, k in want.elements())


def test_lattice_other_settings(spark):
    rows = [(i, "a", v[:48]) for i, _, v in vectors() if v and len(v) == 64]
    df = spark.createDataFrame(rows, "vec_id bigint, label string, embedding array<double>")
    got = Counter((r[0], r[1], r[2]) for r in lattice.near_duplicates(df, 0.9, tables=4, cell=3.0).collect())
    assert got == Counter(x[:3] for x in linked(rows, 0.9).elements())
    with pytest.raises(ValueError):
        lattice.Lattice(64, 0.98, cell=2.0)


def test_lattice_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    assert lattice.near_duplicates(none).collect() == []


# --- clustering -----------------------------------------------------------------------------------------------------

def clustered(rows, k, rounds, size, scale):
    kept = [(i, [math.floor(Fraction(scale) * Fraction(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        members = {}
        for _, v in kept:
            members.setdefault(nearest(v)[1], []).append(v)
        for n, vs in members.items():
            centres[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *nearest(v)) for i, v in kept]
    inertia = Counter()
    for _, d, n in found:
        inertia[n] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]

    def fits(x):
        return x if x < 1 << 63 else None  # as the docstring says

    return Counter((i, n, fits(d), fits(inertia[n]), fits(sum(inertia.values())), sha[n]) for i, d, n in found)


def points(spread):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(7, 6)) * spread
    rows = [(None if i % 50 == 9 else i, (middle[i % 7] + rng.normal(size=6) * spread / 3).tolist()) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)] + [rows[1], rows[1]]
    rows += [(2000, None), (2001, [1.0] * 5), (2002, [1.0] * 5 + [None]), (2003, [1.0] * 5 + [math.nan]),
             (2004, [-math.inf] + [1.0] * 5), (2005, [0.0] * 6), (2006, [-0.0] * 6), (2007, [1e-300] * 6), (2008, [-1e-300] * 6)]
    return rows


@pytest.mark.parametrize("spread, k", [(1.0, 5), (1.0, 40), (1e6, 9), (1e-3, 4), (2e7, 6)])
def test_clusters(spark, spread, k):
    rows = points(spread)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns(
        {"cluster": F.lit("x"), "v": F.lit(1)}).repartition(3)
    got = Counter(tuple(r) for r in centroids.cluster(df, k=k, rounds=3, size=6, scale=64).collect())
    assert got == clustered(rows, k, 3, 6, 64)


def test_few_or_no_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = Counter(tuple(r) for r in centroids.cluster(df, k=16, size=2).collect())
    assert got == clustered(rows, 16, 3, 2, 64)
    none = centroids.cluster(df.limit(0), size=2)
    assert none.collect() == [] and none.columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_search_of_centroids_rejects():
    """Most distances are never computed, and the result is that of all of them."""
    rng = np.random.default_rng(8)
    middle = rng.integers(-2000, 2000, size=(256, 1)) + rng.integers(-30, 30, size=(256, 64))
    x = middle[rng.integers(0, 256, 3000)] + rng.integers(-5, 5, size=(3000, 64))
    number, distance, computed = centroids.Sorted(middle.tolist()).nearest(x)
    d = np.array([((v - middle) ** 2).sum(axis=1) for v in x])
    assert (number == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    assert computed < 0.1 * d.size
    wide = centroids.Sorted((middle * 10 ** 12).tolist()).nearest(x.astype(object) * 10 ** 12)
    assert (wide[0] == number).all() and all(a == b * 10 ** 24 for a, b in zip(wide[1], distance.tolist()))
