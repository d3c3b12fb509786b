"""One regression tree for many outputs.

A split lowers the squared error summed over all outputs. The tree is grown level by level over binned features: tasks add
up counts and sums for each (node, feature, bin), Spark adds those of all tasks, and each node's best split is found by a
task of its own. A node of few rows is finished in one task, which takes the same steps on its rows. Labels are rounded to
multiples of a power of two (20 bits of their range), so that sums are exact and a tree does not depend on the order of
rows, the number of tasks, or which nodes were finished in one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.models.gradient import matrix
from rankloom.operators.state import TableModel

#: A node of up to so many rows is finished in one task.
LOCAL_ROWS = 1 << 15
#: Histogram cells that a task holds before it hands on what it has.
HELD_CELLS = 1 << 23
#: Histogram cells that travel together: a task adds so many of every task's.
CHUNK_CELLS = 1 << 13
#: A fitted tree is broadcast to score rows; more nodes than this are refused.
MAX_NODES = 1 << 20
#: From so many rows on, a histogram is made feature by feature.
MANY_ROWS = 1 << 9
_BITS = 20

_SPLIT = ("node bigint, feature int, bin int, gain double, n bigint, n_left bigint, total array<double>, total_left array<double>")
_NODE = "node bigint, parent bigint, feature int, bin int, left bigint, right bigint, n bigint, total array<double>"


@dataclass(frozen=True)
class Limits:
    """When a node is split: ``depth`` None has no limit. ``subset`` None takes all features, 'sqrt' and 'log2' a drawn subset
    for each node."""

    depth: int | None = None
    leaf: int = 1
    split: int = 2
    subset: str | None = None
    seed: int = 0

    def drawn(self, node: int, features: int) -> np.ndarray:
        """The features that may split a node."""
        if self.subset is None:
            return np.arange(features)
        k = {"sqrt": int(math.sqrt(features)), "log2": int(math.log2(max(1, features)))}[self.subset]
        # A node's number is its path from the root, modulo 2**63, whoever grows it.
        return np.sort(np.random.default_rng([self.seed, node]).permutation(features)[: max(1, k)])

    def splittable(self, level: int, n: int) -> bool:
        return n >= max(2, self.split, 2 * self.leaf) and (self.depth is None or level < self.depth)


def _child(node: int, side: int) -> int:
    return (node * 2_862_933_555_777_941_757 + 3_037_000_493 + side) % (1 << 63)


def best_split(count: np.ndarray, total: np.ndarray, features: np.ndarray, limits: Limits):
    """(feature, bin, gain, rows left, sums left) of the largest gain, of equal ones that of the smallest feature and bin; None
    where no split lowers the error. ``count`` (features, bins), ``total`` (features, bins, outputs)."""
    n_left, left = np.cumsum(count, axis=1)[:, :-1], np.cumsum(total, axis=1)[:, :-1]
    if not n_left.size:
        return None
    n, whole = count[0].sum(), total[0].sum(axis=0)
    n_right = n - n_left
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left ** 2).sum(axis=2) / n_left + (right ** 2).sum(axis=2) / n_right - (whole @ whole) / n
    allowed = (n_left >= limits.leaf) & (n_right >= limits.leaf)
    gain = np.where(allowed, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    # Sums are exact, what is made of them rounds.
    if not gain[f, b] > 1e-9 * max(1.0, float(whole @ whole) / n):
        return None
    return int(features[f]), int(b), float(gain[f, b]), int(n_left[f, b]), left[f, b]


def histogram(bins: np.ndarray, labels: np.ndarray, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts (features, bins) and sums (features, bins, outputs) of rows of bin numbers."""
    features = bins.shape[1]
    at = (bins + np.arange(features, dtype=np.int64) * n_bins).ravel()
    count = np.bincount(at, minlength=features * n_bins).reshape(features, n_bins)
    if len(bins) > MANY_ROWS:  # a feature's cells and a label's values stay in the processor's cache
        each, values = np.ascontiguousarray(bins.T.astype(np.int64)), np.ascontiguousarray(labels.T)
        return count, np.stack([[np.bincount(b, v, minlength=n_bins) for v in values] for b in each]).transpose(0, 2, 1)
    total = np.stack([
        np.bincount(at, np.repeat(labels[:, k], features), minlength=features * n_bins) for k in range(labels.shape[1])], axis=-1)
    return count, total.reshape(features, n_bins, labels.shape[1])


def grow(node: int, parent: int, level: int, bins: np.ndarray, labels: np.ndarray, n_bins: int, limits: Limits) -> list[tuple]:
    """The nodes of the subtree of a few rows, as rows of ``_NODE``."""
    out, open_ = [], [(node, parent, level, np.arange(len(bins)))]
    while open_:
        node, parent, level, rows = open_.pop()
        found = None
        if limits.splittable(level, len(rows)):
            features = limits.drawn(node, bins.shape[1])
            mine = bins[np.ix_(rows, features)]
            found = best_split(*histogram(mine, labels[rows], n_bins), features, limits)
        total = labels[rows].sum(axis=0).tolist()
        if found is None:
            out.append((node, parent, -1, -1, -1, -1, len(rows), total))
            continue
        feature, at, _, _, _ = found
        left, right = _child(node, 0), _child(node, 1)
        out.append((node, parent, feature, at, left, right, len(rows), total))
        below = bins[rows, feature] <= at
        open_ += [(right, node, level + 1, rows[~below]), (left, node, level + 1, rows[below])]
    return out


class Tree:
    """Nodes in arrays. A row goes left where the bin, or the value, of the node's feature is at most the node's."""

    def __init__(self, nodes: list[tuple]):
        number = {r[0]: i for i, r in enumerate(nodes)}
        self.feature = np.array([r[2] for r in nodes])
        self.bin = np.array([r[3] for r in nodes])
        self.left = np.array([number.get(r[4], -1) for r in nodes])
        self.right = np.array([number.get(r[5], -1) for r in nodes])
        self.root = number[0]

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        at = np.full(len(bins), self.root)
        going = np.flatnonzero(self.feature[at] >= 0)
        while len(going):
            node = at[going]
            left = bins[going, self.feature[node]] <= self.bin[node]
            at[going] = np.where(left, self.left[node], self.right[node])
            going = going[self.feature[at[going]] >= 0]
        return at


def thresholds_of(df: DataFrame, column: str, n_bins: int) -> list[np.ndarray]:
    """Where each component of an array column is cut into bins: half way between values where there are few, at approximate
    quantiles otherwise."""
    each = df.select(F.posexplode(column).alias("f", "v")).where(F.col("v").isNotNull())
    shares = [i / n_bins for i in range(1, n_bins)]
    found = each.groupBy("f").agg(
        F.percentile_approx("v", shares, 10_000).alias("q"), F.max("v").alias("high"),
        F.approx_count_distinct("v").alias("d")).collect()
    few = [r["f"] for r in found if r["d"] < n_bins]
    values: dict[int, list[float]] = {}
    if few:
        distinct = each.where(F.col("f").isin(few)).distinct().groupBy("f").agg(F.slice(F.sort_array(F.collect_set("v")), 1, n_bins + 1).alias("v"))
        values = {r["f"]: r["v"] for r in distinct.collect() if len(r["v"]) <= n_bins}
    out: list[np.ndarray] = [np.zeros(0)] * (1 + max((r["f"] for r in found), default=-1))
    for r in found:
        v = np.unique(values.get(r["f"], [*r["q"], r["high"]]))
        out[r["f"]] = (v[:-1] + v[1:]) / 2 if r["f"] in values else v[:-1]
    return out


def binned(x: np.ndarray, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bin numbers: how many thresholds are below the value."""
    return np.stack([np.searchsorted(t, x[:, i], side="left") for i, t in enumerate(thresholds)], axis=1).astype(np.int64)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values.ravel(), kind), values.shape[1]).cast(pa.list_(kind))


def _raw(values: np.ndarray) -> pa.Array:
    """A row of numbers as bytes, which pass between Spark and Python without a look at each number."""
    values = np.ascontiguousarray(values)
    kind = pa.binary(values.shape[1] * values.itemsize)
    return pa.FixedSizeBinaryArray.from_buffers(kind, len(values), [None, pa.py_buffer(values)]).cast(pa.binary())


def _unraw(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """(rows, length) of a column made by ``_raw``, of one row at least."""
    first, last = np.frombuffer(column.buffers()[1], np.int32)[[column.offset, column.offset + len(column)]]
    return np.frombuffer(column.buffers()[2], np.uint8)[first:last].view(kind).reshape(len(column), -1)


def _bin_kind(n_bins: int) -> np.dtype:
    return np.dtype(np.uint8 if n_bins <= 256 else np.uint16)


def _labels(column: pa.Array) -> np.ndarray:
    return _unraw(column, np.dtype(np.float64)) if pa.types.is_binary(column.type) else matrix(column)


def _binned_rows(df: DataFrame, features: str, thresholds: list[np.ndarray], n_bins: int) -> DataFrame:
    """``b``, the bin numbers of the features as bytes, in place of the features."""
    kept, kind = [c for c in df.columns if c != features], _bin_kind(n_bins)
    shared = df.sparkSession.sparkContext.broadcast(thresholds)

    @F.arrow_udf("binary")
    def cut(x: pa.Array) -> pa.Array:
        return _raw(binned(matrix(x).reshape(len(x), -1), shared.value).astype(kind)) if len(x) else pa.array([], pa.binary())

    return df.select(*kept, cut(features).alias("b"))


def _splits(rows: DataFrame, tree: list[tuple], frontier: dict[int, int], n_bins: int, width: int, outputs: int,
            limits: Limits) -> dict[int, tuple]:
    """The best split of each node of a level: tasks count their rows by (node, feature, bin) and hand on some features of a node
    at a time, whose sums over all tasks and best split are found together; the driver takes the best of a node's."""
    drawn = {node: limits.drawn(node, width) for node in frontier}
    chunk, kind = max(1, CHUNK_CELLS // (n_bins * (outputs + 1))), _bin_kind(n_bins)
    shared = rows.sparkSession.sparkContext.broadcast((Tree(tree), np.array([r[0] for r in tree]), drawn))
    cell = pa.schema([("node", pa.int64()), ("chunk", pa.int32()), ("n", pa.binary()), ("s", pa.binary())])

    def count(batches):
        walk, names, wanted = shared.value
        held: dict[int, list[np.ndarray]] = {}

        def handed():
            for node, (n, s) in held.items():
                cuts = range(0, len(n), chunk)
                yield pa.RecordBatch.from_arrays([
                    pa.array([node] * len(cuts), pa.int64()), pa.array(range(len(cuts)), pa.int32()),
                    pa.array([n[a:a + chunk].tobytes() for a in cuts], pa.binary()),
                    pa.array([s[a:a + chunk].tobytes() for a in cuts], pa.binary())], schema=cell)
            held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            bins, labels = _unraw(batch.column("b"), kind), _labels(batch.column("y"))
            at = names[walk.leaves(bins)]
            for node in np.unique(at):
                if node in wanted:
                    mine = at == node
                    n, s = histogram(bins[mine][:, wanted[node]], labels[mine], n_bins)
                    if node in held:
                        held[node][0] += n
                        held[node][1] += s
                    else:
                        held[node] = [n, s]
                    if sum(v[1].size for v in held.values()) > HELD_CELLS:
                        yield from handed()
        yield from handed()

    def choose(key, table):
        node, at = key[0].as_py(), key[1].as_py() * chunk
        features = drawn[node][at:at + chunk]
        n = np.zeros((len(features), n_bins), dtype=np.int64)
        s = np.zeros((len(features), n_bins, outputs))
        for column, total in (("n", n), ("s", s)):
            for piece in table.column(column):
                total += np.frombuffer(piece.as_buffer(), total.dtype).reshape(total.shape)
        found = best_split(n, s, features, limits)
        feature, at, gain, n_left, left = found or (-1, -1, 0.0, 0, np.zeros(outputs))
        return pa.table({
            "node": pa.array([node]), "feature": pa.array([feature], pa.int32()), "bin": pa.array([at], pa.int32()),
            "gain": pa.array([gain]), "n": pa.array([int(n[0].sum())]), "n_left": pa.array([n_left]),
            "total": pa.array([s[0].sum(axis=0).tolist()]), "total_left": pa.array([left.tolist()])})

    cells = rows.select("b", "y").mapInArrow(count, "node bigint, chunk int, n binary, s binary")
    best: dict[int, tuple] = {}
    for r in sorted(cells.groupBy("node", "chunk").applyInArrow(choose, _SPLIT).collect(), key=lambda r: r["feature"]):
        mine = best.get(r["node"])
        # Of equal gains the smallest feature's; features come in order, -1 for none first.
        if mine is None or r["feature"] >= 0 and (mine["feature"] < 0 or r["gain"] > mine["gain"]):
            best[r["node"]] = r
    shared.destroy()
    return best


def _joined(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole


def _finished(rows: DataFrame, tree: list[tuple], small: dict[int, tuple[int, int]], n_bins: int, limits: Limits) -> list[tuple]:
    """The subtrees of nodes with few rows, each grown in one task. ``small``: node to (parent, level)."""
    shared = rows.sparkSession.sparkContext.broadcast((Tree(tree), np.array([r[0] for r in tree])))

    wanted, kind = np.array(list(small)), _bin_kind(n_bins)

    @F.arrow_udf("bigint")
    def leaf(b: pa.Array) -> pa.Array:
        if not len(b):
            return pa.array([], pa.int64())
        walk, names = shared.value
        at = names[walk.leaves(_unraw(b, kind))]
        return pa.array(at, mask=~np.isin(at, wanted))

    def finish(key, table):
        node = key[0].as_py()
        table = table.combine_chunks()
        bins, labels = _unraw(_joined(table.column("b")), kind), _labels(_joined(table.column("y")))
        nodes = grow(node, *small[node], bins, labels, n_bins, limits)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64())]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*nodes), kinds)], names=[c.split()[0] for c in _NODE.split(", ")])

    found = rows.withColumn("node", leaf("b")).where("node IS NOT NULL").groupBy("node").applyInArrow(finish, _NODE)
    out = [tuple(r) for r in found.collect()]
    shared.destroy()
    return out


def grown(rows: DataFrame, n: int, total: np.ndarray, width: int, n_bins: int, limits: Limits, local: int) -> list[tuple]:
    """All nodes of a tree on ``rows`` (``b`` bins, ``y`` rounded labels as an array or as bytes), as rows of ``_NODE``."""
    tree = [(0, -1, -1, -1, -1, -1, n, total.tolist())]
    frontier, level, small, parents = {0: n}, 0, {}, {0: -1}
    while frontier:
        small |= {node: (parents[node], level) for node, m in frontier.items() if m <= local and limits.splittable(level, m)}
        large = {node: m for node, m in frontier.items() if m > local and limits.splittable(level, m)}
        if not large:
            break
        found = _splits(rows, tree, large, n_bins, width, len(total), limits)
        frontier = {}
        by_number = {r[0]: i for i, r in enumerate(tree)}
        for node, r in found.items():
            if r["feature"] < 0:
                continue
            left, right = _child(node, 0), _child(node, 1)
            at = by_number[node]
            tree[at] = (node, tree[at][1], r["feature"], r["bin"], left, right, r["n"], r["total"])
            rest = (np.array(r["total"]) - np.array(r["total_left"])).tolist()
            tree += [(left, node, -1, -1, -1, -1, r["n_left"], r["total_left"]),
                     (right, node, -1, -1, -1, -1, r["n"] - r["n_left"], rest)]
            frontier |= {left: r["n_left"], right: r["n"] - r["n_left"]}
            parents |= {left: node, right: node}
        level += 1
        if len(tree) > MAX_NODES:
            raise ValueError(f"the tree has more than {MAX_NODES} nodes: limit its depth or raise the rows of a leaf")
    if small:
        below = _finished(rows, tree, small, n_bins, limits)
        tree = [r for r in tree if r[0] not in small] + below
        if len(tree) > MAX_NODES:
            raise ValueError(f"the tree has more than {MAX_NODES} nodes: limit its depth or raise the rows of a leaf")
    return tree


def sums_of(rows: DataFrame, outputs: int) -> np.ndarray:
    return np.array(rows.agg(*[F.sum(F.col("y")[k]) for k in range(outputs)]).first(), dtype=np.float64)


def rounding(largest: float) -> float:
    """The power of two that labels are multiplied by before they are rounded."""
    return 2.0 ** (_BITS - math.ceil(math.log2(largest))) if largest > 0 else 1.0


# --- stages ---------------------------------------------------------------------------------------------------------

class _TreeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    depth = Param(Params._dummy(), "depth", "levels below the root; 0 for no limit", TypeConverters.toInt)
    leaf = Param(Params._dummy(), "leaf", "least rows of a leaf", TypeConverters.toInt)
    split = Param(Params._dummy(), "split", "least rows of a node that is split", TypeConverters.toInt)
    subset = Param(Params._dummy(), "subset", "features for each node: 'all', 'sqrt' or 'log2'", TypeConverters.toString)
    bins = Param(Params._dummy(), "bins", "bins of a feature", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the drawn features", TypeConverters.toInt)
    localRows = Param(Params._dummy(), "localRows", "rows of a node that one task finishes", TypeConverters.toInt)

    def _tree_defaults(self, **other):
        self._setDefault(depth=0, leaf=1, split=2, subset="all", bins=64, seed=0, localRows=LOCAL_ROWS, **other)

    def limits(self) -> Limits:
        subset = self.getOrDefault("subset")
        if subset not in ("all", "sqrt", "log2"):
            raise ValueError(f"unknown subset {subset!r}")
        if not 2 <= self.getOrDefault("bins") <= 1 << 14:
            raise ValueError("a feature has 2 to 16384 bins")
        return Limits(self.getOrDefault("depth") or None, self.getOrDefault("leaf"), self.getOrDefault("split"),
                      None if subset == "all" else subset, self.getOrDefault("seed"))


class MultiOutputTree(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """One regression tree whose leaves hold the mean of every output. ``labelCol`` is an array without nulls; the prediction is
    an array of the same size. Rows without features or labels are left out."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", depth=0, leaf=1, split=2,
                 subset="all", bins=64, seed=0, localRows=LOCAL_ROWS):
        super().__init__()
        self._tree_defaults()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        limits, n_bins = self.limits(), self.getOrDefault("bins")
        plain = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("array<double>").alias("y"))
        plain = plain.where("x IS NOT NULL AND y IS NOT NULL").persist()
        try:
            n, largest, outputs, width = plain.agg(
                F.count(F.lit(1)), F.max(F.array_max(F.transform("y", lambda v: F.abs(v)))), F.max(F.size("y")), F.max(F.size("x"))).first()
            if not n:
                raise ValueError("no rows to fit on")
            scale = rounding(largest)
            thresholds = thresholds_of(plain, "x", n_bins)
            rows = _binned_rows(plain.select("x", F.transform("y", lambda v: F.rint(v * scale)).alias("y")), "x", thresholds, n_bins).persist()
            try:
                local = self.getOrDefault("localRows")
                total = np.zeros(outputs) if n <= local and limits.splittable(0, n) else sums_of(rows, outputs)
                tree = grown(rows, n, total, width, n_bins, limits, local)
            finally:
                rows.unpersist()
        finally:
            plain.unpersist()
        return self._copyValues(MultiOutputTreeModel()).with_tree(dataset, tree, thresholds, scale)


class MultiOutputTreeModel(TableModel, _TreeParams):
    """The tree as a table: ``node, feature, threshold, left, right, n, value``."""

    def __init__(self):
        super().__init__()
        self._tree_defaults()

    def with_tree(self, df: DataFrame, tree: list[tuple], thresholds: list[np.ndarray], scale: float):
        rows = [(r[0], r[2], float(thresholds[r[2]][r[3]]) if r[2] >= 0 else None, r[4], r[5], r[6],
                 [t / r[6] / scale for t in r[7]]) for r in sorted(tree)]
        schema = "node bigint, feature int, threshold double, left bigint, right bigint, n bigint, value array<double>"
        return self.with_tables(nodes=df.sparkSession.createDataFrame(rows, schema))

    def depth_reached(self) -> int:
        """Levels below the root."""
        nodes = {r["node"]: r for r in self.tables["nodes"].collect()}
        level, deepest = [0], 0
        while True:
            level = [c for k in level for c in (nodes[k]["left"], nodes[k]["right"]) if c >= 0]
            if not level:
                return deepest
            deepest += 1

    def _transform(self, dataset):
        nodes = self.tables["nodes"].collect()  # bounded by MAX_NODES when it was fitted
        walk = Tree([(r["node"], 0, r["feature"], r["threshold"], r["left"], r["right"]) for r in nodes])
        shared = dataset.sparkSession.sparkContext.broadcast((walk, np.array([r["value"] for r in nodes])))

        @F.arrow_udf("array<double>")
        def predict(x: pa.Array) -> pa.Array:
            walk, values = shared.value
            return _lists(values[walk.leaves(matrix(x))], pa.float64()) if len(x) else pa.array([], pa.list_(pa.float64()))

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))
