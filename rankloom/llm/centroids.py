"""Centroid clustering by equal-average equal-variance search.

Centroids are sorted by the sum of their components. A vector starts at its own sum and looks at centroids outwards, the
nearer side first. With ``n`` components, ``n`` times a squared distance is at least the squared difference of the sums, so
a side is left for good once that exceeds the best distance; and it is at least that plus the squared difference of the
deviations, which rejects single centroids without a look at their components. What is left is decided by whole numbers.

A round is one pass: tasks return sums for each centroid and component, which Spark adds as decimals.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import written

#: Components up to this size have squared distances, times their number, that a 64-bit integer holds. Others are Python's.
_PLAIN = 1 << 25
_TOTAL = T.DecimalType(38, 0)


class Sorted:
    """Centroids in the order of their sums."""

    def __init__(self, centroids: list[list[int]]):
        whole = np.array(centroids, dtype=object)
        self.plain = bool(len(whole)) and max(abs(x) for row in centroids for x in row) <= _PLAIN
        sums = [sum(row) for row in centroids]
        self.number = np.array(sorted(range(len(centroids)), key=lambda k: (sums[k], k)), dtype=np.int64)
        self.whole = whole[self.number]
        self.points = self.whole.astype(np.int64) if self.plain else self.whole
        self.sums = np.array([float(sums[k]) for k in self.number])
        n = len(centroids[0])
        self.deviation = np.array([
            math.sqrt(n * sum(x * x for x in centroids[k]) - sums[k] ** 2) for k in self.number])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance) of the nearest centroid of each row, the smaller number where several are, and how
        many distances were computed. Exact: the bounds are doubles with room for rounding, the distances whole numbers."""
        n, size = vectors.shape
        k = len(self.number)
        plain = self.plain and vectors.dtype != object
        points = self.points if plain else self.whole
        sums = vectors.sum(axis=1)
        spread = size * (vectors * vectors).sum(axis=1) - sums * sums
        sums, spread = sums.astype(np.float64), np.sqrt(np.maximum(spread.astype(np.float64), 0))
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best = np.full(n, -1, dtype=np.int64 if plain else object)
        number = np.full(n, k, dtype=np.int64)
        bound = np.full(n, np.inf)  # of size * distance, with room
        room = 1e-3 + 1e-12 * (spread ** 2 + sums ** 2 + (self.deviation ** 2).max() + (self.sums ** 2).max())
        computed = 0
        going = np.arange(n)
        while len(going):
            l, r, s = left[going], right[going], sums[going]
            to_left = np.where(l >= 0, s - self.sums[np.maximum(l, 0)], np.inf)
            to_right = np.where(r < k, self.sums[np.minimum(r, k - 1)] - s, np.inf)
            take_left = to_left <= to_right
            away = np.where(take_left, to_left, to_right)
            open_ = away * away <= bound[going]
            going, take_left, away = going[open_], take_left[open_], away[open_]
            at = np.where(take_left, left[going], right[going])
            left[going] -= take_left
            right[going] += ~take_left
            near = away * away + (spread[going] - self.deviation[at]) ** 2 <= bound[going]
            rows, at = going[near], at[near]
            off = vectors[rows] - points[at]
            distance = (off * off).sum(axis=1)
            computed += len(rows)
            mine = self.number[at]
            better = (best[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (mine < number[rows]))
            rows = rows[better]
            best[rows], number[rows] = distance[better], mine[better]
            # Ties must stay open, and doubles round: room for that, of what the sums and deviations are large.
            bound[rows] = size * best[rows].astype(np.float64) * (1 + 1e-12) + room[rows]
        return number, best, computed


def whole_vectors(vectors: DataFrame, size: int = 64, scale: int = 64) -> DataFrame:
    """``vec_id`` and ``v``, the components times ``scale`` rounded down to whole numbers, of the vectors that have ``size``
    components and neither null nor non-finite ones. What a 64-bit integer does not hold becomes its end."""
    x = F.col("embedding").cast("array<double>")
    good = (F.size("embedding") == size) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    return vectors.where(F.coalesce(good, F.lit(False))).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))


def first_centroids(rows: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` vectors with the smallest SHA-256 of ``1:<vec_id>`` (``1:`` for a null id), of equal ones the smallest."""
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["v"] for r in rows.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    values = column.flatten().to_numpy().reshape(-1, size)
    return values if not len(values) or np.abs(values).max() <= _PLAIN else values.astype(object)


def _sums(rows: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """For each centroid that has vectors: how many, and their sums."""
    size = len(centroids[0])
    schema = pa.schema([("cluster", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])

    def add(batches):
        table = Sorted(centroids)
        n, totals = [0] * len(centroids), [[0] * size for _ in centroids]
        for batch in batches:
            vectors = _matrix(batch.column(0), size)
            if not len(vectors):
                continue
            number, _, _ = table.nearest(vectors)
            order = np.argsort(number, kind="stable")
            each, begin = np.unique(number[order], return_index=True)
            for c, part, m in zip(each.tolist(), np.add.reduceat(vectors[order], begin, axis=0).tolist(),
                                  np.diff([*begin, len(order)]).tolist()):
                n[c] += m
                totals[c] = [a + b for a, b in zip(totals[c], part)]
        found = [(c, i, n[c], total) for c in range(len(centroids)) if n[c] for i, total in enumerate(totals[c])]
        c, i, m, total = zip(*found) if found else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([
            pa.array(c, pa.int32()), pa.array(i, pa.int32()), pa.array(m, pa.int64()),
            pa.array([Decimal(x) for x in total], pa.decimal128(38, 0))], schema=schema)

    parts = rows.select("v").mapInArrow(add, "cluster int, i int, n bigint, total decimal(38,0)")
    added = parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in added:
        out.setdefault(r["cluster"], (r["n"], [0] * size))[1][r["i"]] = int(r["total"])
    return out


def fit(rows: DataFrame, k: int, rounds: int) -> list[list[int]]:
    """Centroids after ``rounds`` of assigning all ``rows`` and taking the means, rounded down. Empty ones stay."""
    centroids = first_centroids(rows, k)
    for _ in range(rounds if centroids else 0):
        for c, (n, total) in _sums(rows, centroids).items():
            centroids[c] = [x // n for x in total]
    return centroids


def assigned(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """``vec_id``, ``cluster`` and ``distance``, the squared one, of every row. A distance beyond a long is null."""
    size = len(centroids[0])
    schema = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def assign(batches):
        table = Sorted(centroids)
        for batch in batches:
            vectors = _matrix(batch.column("v"), size)
            if not len(vectors):
                continue
            number, distance, _ = table.nearest(vectors)
            if distance.dtype == object:
                distance = [x if x < 1 << 63 else None for x in distance]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance, pa.int64())], schema=schema)

    return rows.select("vec_id", "v").mapInArrow(assign, "vec_id bigint, cluster int, distance bigint")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64) -> DataFrame:
    """One row for each vector kept (see ``whole_vectors``): ``vec_id``, ``cluster`` (from 0, the nearest centroid, of
    several the smaller number), ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (its sum over the cluster and
    over all) and ``centroid_sha256``, of the components joined by commas.

    Fewer vectors than ``k`` make fewer centroids. Null and repeated ids and rows are vectors of their own; equal vectors
    may be several equal centroids, of which the first gets all. Sums beyond a long are null. Other columns aren't read; an
    empty table gives an empty result.
    """
    rows = written(whole_vectors(vectors, size, scale), "whole")
    centroids = fit(rows, k, rounds)
    spark = vectors.sparkSession
    if not centroids:
        return rows.selectExpr(
            "vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    found = written(assigned(rows, centroids), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast(_TOTAL)).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"] or 0) for r in sums}

    def fits(x: int) -> int | None:
        return x if x < 1 << 63 else None

    table = [(c, fits(inertia.get(c, 0)), fits(sum(inertia.values())),
              hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids)]
    known = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    # One row for each centroid: its size is that of the centroids, which every task has anyway.
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
