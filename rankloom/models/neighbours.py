"""Exact k nearest neighbours as an equi-join on blocks of cells.

Training rows are assigned to the nearest of a few pivots. From the distances to the pivots alone a query knows an
upper bound of its k-th distance and, by the triangle inequality, the only cells that can hold a neighbour. Small cells are
packed into blocks, and a query visits the blocks of its cells and no others, once each. Large cells are dealt into
chunks and the queries of a block into batches, so a cell of any size spreads over many tasks, a vector is sent as often as
there are blocks, and each task returns at most k candidates per query. Where nothing can be left out, as between vectors that
are all about as far apart, the work is quadratic: then a matrix product finds the few pairs whose distance is measured.
"""

from __future__ import annotations

from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.models.gradient import matrix
from rankloom.session import pin_state

CHUNK_ROWS = 1 << 15
BATCH_ROWS = 1 << 13
#: Numbers in the vectors of a chunk at most.
CHUNK_CELLS = 1 << 22
#: Distances that are held at once.
HELD_DISTANCES = 1 << 19
#: Parts of a row of distances whose least ones bound the k-th.
PARTS = 64
MAX_PIVOTS = 256
SLACK = 1e-9  # keeps a cell whose bound only ties by rounding


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by plain differences (no expansion, so that ties stay ties), in small blocks of ``a``."""
    step = max(1, 2_000_000 // max(1, b.size))
    return np.concatenate([np.sqrt(((a[i:i + step, None, :] - b[None]) ** 2).sum(-1)) for i in range(0, len(a), step)])


def closest_rows(queries: np.ndarray, targets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query its ``k`` nearest targets, ties by their number: numbers of queries and of targets, and distances.

    Squared distances from a matrix product, which are off by rounding, choose the pairs that may be among the nearest; of those
    the distance is measured by plain differences, so that ties stay ties.
    """
    n, width = targets.shape
    k = min(k, n)
    parts = max(PARTS, 4 * k)
    lengths, own = (targets ** 2).sum(1), (queries ** 2).sum(1)
    # More than twice the rounding of the product and of a measured distance.
    room = 16 * (width + 8) * np.finfo(float).eps * (own + lengths.max())
    found = []
    step = max(1, HELD_DISTANCES // n)
    for i in range(0, len(queries), step):
        near = queries[i:i + step] @ (-2.0 * targets.T)
        near += lengths
        if n > 4 * parts:  # k parts have a target as near as the k-th of their least ones
            least = np.minimum.reduceat(near, np.linspace(0, n, parts, endpoint=False).astype(int), axis=1)
        else:
            least = near
        bound = np.partition(least, k - 1, axis=1)[:, k - 1] + room[i:i + step]
        # A distance that is no number is kept, to be measured.
        q, t = np.nonzero(~(near > bound[:, None]))
        d = np.sqrt(((queries[i + q] - targets[t]) ** 2).sum(-1))
        order = np.lexsort((t, d, q))
        q, t, d = q[order], t[order], d[order]
        first = np.searchsorted(q, np.arange(q[-1] + 1) if len(q) else [])
        kept = np.arange(len(q)) - first[q] < k if len(q) else np.zeros(0, dtype=bool)
        found.append((i + q[kept], t[kept], d[kept]))
    return tuple(np.concatenate(f) for f in zip(*found))


def nearest_neighbours(
    train: DataFrame, queries: DataFrame, key: str, vector: str, k: int, exclude_self: bool = False, seed: int = 0,
) -> DataFrame:
    """``query, neighbour, distance, position`` (1..k), nearest first, ties by neighbour key.

    ``exclude_self`` leaves out the training row with the query's own key.
    """
    spark = train.sparkSession
    need = k + 1 if exclude_self else k
    n = train.count()
    n_pivots = max(1, min(MAX_PIVOTS, isqrt(n) // 2))
    # Narrow numbers stay narrow until they are compared.
    points, asked = (df.select(F.col(key).alias(name), (
        F.col(vector) if df.schema[vector].dataType.simpleString() == "array<float>" else F.col(vector).cast("array<double>")
    ).alias("v")) for df, name in ((train, "t"), (queries, "q")))
    chosen = points.orderBy(F.xxhash64(F.lit(seed), F.col("t")), "t").limit(n_pivots)
    pivots = _matrix(chosen.toPandas()["v"])  # at most MAX_PIVOTS vectors

    @F.pandas_udf("cell int, r double")
    def place(vs: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(vs), pivots)
        cell = d.argmin(1)
        return pd.DataFrame({"cell": cell.astype("int32"), "r": d[np.arange(len(d)), cell]})

    cells = points.withColumn("_p", place("v")).select("t", "v", "_p.cell", "_p.r")
    # One row per pivot: how far the cell reaches and how many rows it holds.
    shape = cells.groupBy("cell").agg(F.max("r").alias("reach"), F.count(F.lit(1)).alias("n")).toPandas()
    ids, reach, held = shape["cell"].to_numpy(), shape["reach"].to_numpy(), shape["n"].to_numpy()
    centres = pivots[ids]

    @F.pandas_udf("array<int>")
    def visits(vs: pd.Series) -> pd.Series:
        d = _distances(_matrix(vs), centres)
        far = d + reach
        order = np.argsort(far, axis=1)
        filled = np.cumsum(held[order], axis=1) >= need
        stop = np.where(filled.any(1), filled.argmax(1), len(ids) - 1)
        bound = np.where(filled.any(1), np.take_along_axis(far, order, 1)[np.arange(len(d)), stop], np.inf)
        may = (d - reach) <= bound[:, None] * (1 + SLACK) + SLACK
        return pd.Series([blocks[m].astype("int32").tolist() for m in may])

    # Cells in their own order, small ones together; a block is named by its first cell.
    chunk_rows, batch_rows = (min(r, max(1, CHUNK_CELLS // max(1, pivots.shape[1]))) for r in (CHUNK_ROWS, BATCH_ROWS))
    block_of, first, filled = {}, None, 0
    for cell, rows in sorted(zip(ids.tolist(), held.tolist())):
        if first is None or filled + rows > chunk_rows:
            first, filled = cell, 0
        block_of[cell], filled = first, filled + rows
    blocks = np.array([block_of[c] for c in ids.tolist()])
    sizes = shape.assign(cell=blocks).groupby("cell", as_index=False)["n"].sum()

    wanted = asked.withColumn("cell", F.explode(F.array_distinct(visits("v"))))
    load = wanted.groupBy("cell").agg(F.count(F.lit(1)).alias("asked"))
    plan = pin_state(
        spark.createDataFrame(sizes).join(load, "cell").select(
            F.col("cell").cast("int").alias("cell"),
            F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks"),
            F.ceil(F.col("asked") / batch_rows).cast("int").alias("batches"),
        )
    )

    # A query goes to one batch of its block and meets every chunk; a training row sits in one chunk and meets every batch.
    def pick(by: str, ways: str):
        return F.pmod(F.xxhash64(by), F.col(ways)).cast("int")

    def each(ways: str):
        return F.explode(F.sequence(F.lit(0), F.col(ways) - 1))

    names = F.create_map(*[F.lit(int(x)) for pair in block_of.items() for x in pair])
    left = wanted.join(plan, "cell").withColumn("batch", pick("q", "batches")).withColumn("chunk", each("chunks"))
    right = cells.select("t", "v", names[F.col("cell")].alias("cell")).join(plan, "cell").withColumn(
        "chunk", pick("t", "chunks")).withColumn("batch", each("batches"))
    left, right = left.drop("chunks", "batches"), right.drop("chunks", "batches")
    place_keys = ["cell", "chunk", "batch"]

    def closest(_, qs: pa.Table, ts: pa.Table) -> pa.Table:
        kind = qs.column("q").type
        if not (qs.num_rows and ts.num_rows):
            return pa.table([pa.array([], kind), pa.array([], kind), pa.array([], pa.float64())], names=["q", "t", "d"])
        ts = ts.take(pc.sort_indices(ts, [("t", "ascending")]))
        keys = ts.column("t").combine_chunks()
        # Rows with the query's own key are left out afterwards.
        more = max(pc.value_counts(keys).field("counts").to_pylist()) if exclude_self else 0
        vectors, targets = (matrix(x.column("v").combine_chunks()) for x in (qs, ts))
        q, t, d = closest_rows(vectors, targets, k + more)
        return pa.table([qs.column("q").combine_chunks().take(pa.array(q)), keys.take(pa.array(t)), pa.array(d)], names=["q", "t", "d"])

    kind = train.schema[key].dataType.simpleString()
    near = left.groupBy(*place_keys).cogroup(right.groupBy(*place_keys)).applyInArrow(
        closest, f"q {kind}, t {kind}, d double"
    )
    if exclude_self:
        near = near.where("q <> t")
    w = Window.partitionBy("q").orderBy("d", "t")
    return near.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k).select(
        F.col("q").alias("query"), F.col("t").alias("neighbour"), F.col("d").alias("distance"), "position"
    )


def knn_predict(
    train: DataFrame, queries: DataFrame, key: str, vector: str, label: str, k: int = 5, task: str = "classification",
    exclude_self: bool = False,
) -> DataFrame:
    """The mean (regression) or most frequent (classification, smallest among equals) label of the k neighbours."""
    near = nearest_neighbours(train, queries, key, vector, k, exclude_self)
    labelled = near.join(train.select(F.col(key).alias("neighbour"), F.col(label).alias("_y")), "neighbour")
    if task == "regression":
        return labelled.groupBy(F.col("query").alias(key)).agg(F.avg("_y").alias("prediction"))
    votes = labelled.groupBy("query", "_y").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(F.col("query").alias(key)).agg(
        F.min_by("_y", F.struct((-F.col("n")).alias("n"), F.col("_y"))).alias("prediction")
    )
