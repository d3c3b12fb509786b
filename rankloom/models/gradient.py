"""Losses that are sums over rows, minimised by L-BFGS: tasks return a loss and a gradient, the driver holds the weights.

Every evaluation is one job over cached rows. A task adds up its rows and returns its gradient in blocks; blocks of equal
number are added by tasks of their own, in two steps where there are many, so that no task and not the driver ever holds
more gradients than about the square root of the number of tasks.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankloom.session import packed

BLOCK_DOUBLES = 1 << 15
#: The gradients of all tasks together go straight to the driver up to so many numbers (32 MB).
DIRECT_DOUBLES = 1 << 22
#: Weights beyond this many are refused: they are broadcast in every iteration.
MAX_WEIGHTS = 1 << 24

#: From a batch of rows and the weights: the loss of these rows and its gradient.
BatchLoss = Callable[[pa.RecordBatch, np.ndarray], tuple[float, np.ndarray]]

_BLOCKS = "part int, block int, total binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("total", pa.binary())])


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose rows have equal lengths, as (rows, length)."""
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def summed(rows: DataFrame, of: BatchLoss, weights: np.ndarray, parts: int) -> tuple[float, np.ndarray]:
    """The sum of ``of`` over all rows. ``parts`` is the number of partitions of ``rows``."""
    if len(weights) > MAX_WEIGHTS:
        raise ValueError(f"{len(weights)} weights: at most {MAX_WEIGHTS} are broadcast")
    shared = rows.sparkSession.sparkContext.broadcast(weights)
    groups = max(1, math.isqrt(parts))

    def local(batches):
        w, total, part = shared.value, None, 0
        for batch in batches:
            if batch.num_rows:
                loss, gradient = of(batch, w)
                row = np.concatenate([[loss], gradient])
                total = row if total is None else total + row
                part = (part * 31 + batch.num_rows) % groups
        if total is not None:
            cut = [total[a:a + BLOCK_DOUBLES].tobytes() for a in range(0, len(total), BLOCK_DOUBLES)]
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(cut), pa.int32()), pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())],
                schema=_SCHEMA)

    def add(key, table):
        # In the order of the bytes, as rows come in any order: the same sum each time.
        each = sorted(table.column("total").to_pylist())
        total = np.sum([np.frombuffer(b) for b in each], axis=0)
        return pa.table([pa.array([0], pa.int32()), pa.array([key[-1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                        schema=_SCHEMA)

    found = rows.mapInArrow(local, _BLOCKS)
    if parts * len(weights) > DIRECT_DOUBLES:
        if groups > 8:
            found = found.groupBy("part", "block").applyInArrow(add, _BLOCKS)
        found = found.groupBy("block").applyInArrow(add, _BLOCKS)
    blocks = sorted((r["block"], bytes(r["total"])) for r in found.collect())
    shared.destroy()
    total = np.zeros(len(weights) + 1)
    for block, raw in blocks:
        piece = np.frombuffer(raw)
        total[block * BLOCK_DOUBLES: block * BLOCK_DOUBLES + len(piece)] += piece
    return float(total[0]), total[1:]


def minimised(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], weights: np.ndarray, iterations: int, tolerance: float = 1e-6,
    memory: int = 10,
) -> np.ndarray:
    """L-BFGS with a backtracking step. Stops when an iteration lowers the loss by less than ``tolerance`` of it."""
    value, gradient = loss(weights)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        if not np.any(gradient):
            break
        direction, kept = -gradient, []
        for s, y in reversed(steps):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            kept.append(a)
        if steps:
            s, y = steps[-1]
            direction = direction * ((s @ y) / (y @ y))
        for (s, y), a in zip(steps, reversed(kept)):
            direction = direction + s * (a - (y @ direction) / (s @ y))
        slope = gradient @ direction
        if slope >= 0:  # not downhill: start anew from the gradient
            steps, direction, slope = [], -gradient, -(gradient @ gradient)
        step = 1.0 if steps else 1.0 / max(1.0, float(np.sqrt(gradient @ gradient)))
        for _ in range(20):
            new_value, new_gradient = loss(weights + step * direction)
            if np.isfinite(new_value) and new_value <= value + 1e-4 * step * slope:
                break
            step /= 2 if np.isfinite(new_value) else 10
        else:
            break
        s, y = step * direction, new_gradient - gradient
        if s @ y > 1e-10 * (y @ y):
            steps = [*steps[1 - memory:], (s, y)] if len(steps) >= memory else [*steps, (s, y)]
        gained, weights, value, gradient = value - new_value, weights + s, new_value, new_gradient
        if gained <= tolerance * max(1e-12, abs(value)):
            break
    return weights


def fitted(
    rows: DataFrame, of: BatchLoss, weights: np.ndarray, iterations: int, penalty: np.ndarray | float = 0.0,
    tolerance: float = 1e-6,
) -> np.ndarray:
    """Weights that minimise the mean of ``of`` over the rows plus half the ``penalty`` times the squared weights."""
    with packed(rows) as rows:
        n, parts = rows.count(), rows.rdd.getNumPartitions()
        if n == 0:
            raise ValueError("no rows to fit on")

        def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
            total, gradient = summed(rows, of, w, parts)
            return total / n + 0.5 * float(np.sum(penalty * w * w)), gradient / n + penalty * w

        return minimised(loss, weights, iterations, tolerance)
