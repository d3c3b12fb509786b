"""Embedding near-duplicates by lattice hashing.

Unit vectors are projected by a random orthogonal matrix (a Hadamard matrix with random signs) and its rows are dealt to
tables of eight. In each table the eight numbers are decoded to the nearest point of the E8 lattice, which is the vector's
cell, and neighbouring cells are probed as well: all those that the ball of half the radius around the projection may
reach. Two vectors whose projections are no further apart than the radius then share the cell of their midpoint.

Nothing is left to chance: the tables' rows are orthogonal, so the squared distance of two vectors is at least the sum of
their squared distances in the tables, and with ``tables`` tables the smallest of these is at most the distance divided by
the root of ``tables``. That is the radius, so every pair within the threshold meets, and it is counted in one place only:
in the table where it is closest, in the cell of its midpoint.

The first pass shuffles narrow rows (cell, vector number, eight coordinates in 16 bytes) and keeps those that have a
neighbour within the radius; only these meet again with their vectors to have the cosine verified. Cells that hold many
vectors are cut into blocks, and pairs of blocks are dealt out. Tasks return counts and the edges of spanning forests,
never pairs.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import compact, joined, written
from rankloom.llm.simhash import _forest as forest
from rankloom.llm.simhash import components
from rankloom.llm.words import mixed

SEED = 13
#: Eight tables of eight coordinates use all of a vector of 64.
TABLES = 8
#: Radii in a unit of the lattice. Smaller cells hold fewer strangers, but each vector is in more of them.
CELL = 2.8
#: Vectors of one cell that one task compares; a cell with more is cut into blocks of about so many.
BLOCK = 4096
#: One in so many vectors is counted to find the cells with more than BLOCK.
COUNTED = 16
#: Pairs whose vectors are compared at once.
PAIRS = 1 << 15

_UNIT = float(1 << 24)  # unit vectors are whole numbers of this, so that projections are exact
_NARROW = float(1 << 13)
_GROUP = ["cell", "low", "high"]


def _signed_hadamard(size: int) -> np.ndarray:
    """A Hadamard matrix of ``size``, a power of two, with random signs of columns and in random order of rows."""
    rng = np.random.default_rng(SEED)
    out = np.ones((1, 1))
    while len(out) < size:
        out = np.block([[out, out], [out, -out]])
    return (out * rng.choice([-1.0, 1.0], size=size))[rng.permutation(size)]


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest point of E8 (whole numbers with an even sum, or all of them shifted by a half) to each row."""

    def even(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        off = y - near
        odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(axis=1)
        near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
        return near

    whole, half = even(x), even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def _shells() -> np.ndarray:
    """The lattice vectors of squared length 2 (240) and 4 (2160): the neighbours that a small ball can reach."""
    roots = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            roots.append(v)
    roots += [list(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    first = np.array(roots)
    both = np.unique((first[:, None] + first[None]).reshape(-1, 8), axis=0)
    return np.concatenate([first, both[(both ** 2).sum(axis=1) == 4]])


def cell_key(points: np.ndarray, table, space: np.ndarray) -> np.ndarray:
    """A 64-bit name of lattice points in a table of a space (label and size). Different points may share it, which costs
    time only."""
    h = space ^ mixed(np.atleast_1d(table).astype(np.uint64) + np.uint64(1))
    for k in range(8):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.rint(2 * points[:, k]).astype(np.int64).view(np.uint64))
    return h.view(np.int64)


def radius(threshold: float, tables: int) -> float:
    """How far two vectors within the threshold are apart, at most, in the table where they are closest."""
    return math.sqrt(max(0.0, 2 - 2 * threshold) / tables) * (1 + 1e-5) + 1e-6


class Lattice:
    """Tables, cells and neighbours for vectors of ``size`` components."""

    def __init__(self, size: int, threshold: float, tables: int = TABLES, cell: float = CELL):
        padded = 1 << max(8 * tables - 1, size - 1, 1).bit_length()
        self.size, self.tables = size, tables
        self.matrix = np.ascontiguousarray(_signed_hadamard(padded)[: 8 * tables, :size].T)
        self.scale = 1.0 / (_UNIT * math.sqrt(padded))
        self.radius = radius(threshold, tables)
        self.cell = cell * self.radius
        if cell <= 2.23:
            raise ValueError("cells below 2.23 radii would reach beyond the second shell of their neighbours")
        self.shells = _shells()
        self.lengths = np.sqrt((self.shells ** 2).sum(axis=1))

    def project(self, unit: np.ndarray) -> np.ndarray:
        """Coordinates of unit vectors in all tables: (rows, tables, 8). Products of whole numbers below 2**53 are exact, so
        that the result does not depend on the order in which they are added."""
        exact = np.rint(unit * _UNIT) @ self.matrix
        return (exact * self.scale).reshape(len(unit), self.tables, 8)

    def cells(self, z: np.ndarray, table: int, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for the own cell of each row and for those that the ball of half the radius may reach."""
        x = z / self.cell
        own = nearest_e8(x)
        # Distance to the plane half way to each neighbour.
        away = (self.lengths / 2 - (x - own) @ (self.shells / self.lengths[:, None]).T) * self.cell
        row, neighbour = np.nonzero(away <= self.radius / 2)
        row = np.concatenate([np.arange(len(x)), row])
        points = np.concatenate([own, own[row[len(x):]] + self.shells[neighbour]])
        found = np.unique(np.stack([row, cell_key(points, table, space[row])], axis=1), axis=0)
        return found[:, 0], found[:, 1]


_known: dict[tuple, Lattice] = {}


def _lattice(*of) -> Lattice:
    if of not in _known:
        _known[of] = Lattice(*of)
    return _known[of]


def _spaces(names: list[str]) -> np.ndarray:
    each = {n: int.from_bytes(hashlib.sha256(n.encode()).digest()[:8], "little") for n in set(names)}
    return np.array([each[n] for n in names], dtype=np.uint64)


def _doubles(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype="<f8") for b in column.to_pylist()]


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _linkable(df: DataFrame, with_vector: bool) -> DataFrame:
    """``vec_id``, ``space`` (label and size) and ``key``, a digest of the components; both null where nothing can link.
    ``vector``: the components as bytes."""
    label = F.col("label")
    if isinstance(df.schema["label"].dataType, (T.FloatType, T.DoubleType)):
        label = label + F.lit(0.0)  # there is a zero with a sign
    fields = [("vec_id", pa.int64()), ("space", pa.string()), ("key", pa.binary())]
    schema = pa.schema([*fields, ("vector", pa.binary())] if with_vector else fields)

    def digest(batches):
        for batch in batches:
            labels, column = batch.column("label").to_pylist(), batch.column("embedding")
            values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64) + 0.0
            sizes = np.array([-1 if v is None else v for v in pc.list_value_length(column).to_pylist()], dtype=np.int64)
            ends = np.cumsum(np.maximum(sizes, 0))
            spaces, keys, vectors = [], [], []
            for label_, n, end in zip(labels, sizes.tolist(), ends.tolist()):
                mine = values[end - max(n, 0): end]
                if label_ is None or n < 1 or not np.isfinite(mine).all() or not mine.any():
                    spaces.append(None), keys.append(None), vectors.append(None)
                    continue
                raw = mine.astype("<f8").tobytes()
                spaces.append(f"{n}:{label_}"), keys.append(hashlib.sha256(raw).digest()[:16]), vectors.append(raw)
            columns = [batch.column("vec_id"), pa.array(spaces, pa.string()), pa.array(keys, pa.binary())]
            columns += [pa.array(vectors, pa.binary())] if with_vector else []
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return df.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).mapInArrow(digest, "vec_id bigint, space string, key binary" + ", vector binary" * with_vector)


def _entries(nodes: DataFrame, of: tuple) -> DataFrame:
    """One row for each vector and cell it is in: ``cell``, ``tab``, ``node`` and the table's coordinates, ``at``."""
    schema = pa.schema([("cell", pa.int64()), ("tab", pa.int8()), ("node", pa.int64()), ("at", pa.binary())])

    def look(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                node, space = part.column("node").to_numpy(), _spaces(part.column("space").to_pylist())
                vectors = _doubles(part.column("vector"))
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes):
                    rows = np.flatnonzero(sizes == size)
                    lattice = _lattice(int(size), *of)
                    z = lattice.project(_unit(np.stack([vectors[r] for r in rows])))
                    short = np.rint(z * _NARROW).astype("<i2")
                    for table in range(lattice.tables):
                        row, cell = lattice.cells(z[:, table], table, space[rows])
                        raw = pa.FixedSizeBinaryArray.from_buffers(
                            pa.binary(16), len(row), [None, pa.py_buffer(np.ascontiguousarray(short[row, table]))])
                        yield pa.RecordBatch.from_arrays([
                            pa.array(cell), pa.array(np.full(len(row), table, dtype=np.int8)), pa.array(node[rows][row]),
                            raw.cast(pa.binary())], schema=schema)

    return nodes.select("node", "space", "vector").mapInArrow(look, "cell bigint, tab tinyint, node bigint, at binary")


def _whole_groups(batches) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by group, each of at least one batch if there are so many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _GROUP])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if any(last.column(c)[0].as_py() != batch.column(c)[0].as_py() for c in _GROUP):
                yield pa.Table.from_batches(held)
                held = []
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _partners(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays (i, j) of the rows that are to be compared: all pairs of a group, or those of its two blocks. Sorted by group
    and block."""
    cell, low, high, block = (table.column(c).to_numpy().astype(np.int64) for c in (*_GROUP, "block"))
    n = len(cell)
    new = np.flatnonzero((np.diff(cell) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
    begins = np.concatenate([[0], new])
    group = np.repeat(np.arange(len(begins)), np.diff([*begins, n]))
    ends = np.concatenate([new, [n]])[group]
    ahead = np.arange(n) + 1
    cross = low != high
    # Of two blocks, the rows of the lower one meet those of the higher one, which follow it in the group.
    lower = np.bincount(group, (block == low) & cross, minlength=len(begins)).astype(np.int64)
    ahead = np.where(cross, begins[group] + lower[group], ahead)
    count = np.where(cross & (block != low), 0, ends - ahead)
    upto = np.cumsum(count)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        rows = np.arange(at, to)
        i = np.repeat(rows, count[rows])
        if len(i):
            inside = np.arange(len(i)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
            for part in range(0, len(i), PAIRS):  # a row may have more partners than that
                k = slice(part, part + PAIRS)
                yield i[k], ahead[i[k]] + inside[k]
        at = to


def _dealt(rows: DataFrame) -> DataFrame:
    """The pairs of blocks that a row is needed for: ``low``, ``high``. ``blocks`` of its cell is null for one block."""
    block = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.withColumn("block", block).withColumn("_other", F.explode(other)).withColumns({
        "low": F.least("block", "_other"), "high": F.greatest("block", "_other")}).drop("_other", "blocks")


def _with_neighbours(entries: DataFrame, of: tuple) -> DataFrame:
    """The entries that have another one of their cell within the radius."""
    schema = pa.schema([("cell", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("block", pa.int32()),
                        ("tab", pa.int8()), ("node", pa.int64())])
    reach = radius(*of[:2]) * _NARROW + 3  # coordinates are rounded, which moves eight of them by at most the root of 8

    def search(batches):
        for table in _whole_groups(batches):
            at = np.frombuffer(b"".join(table.column("at").to_pylist()), dtype="<i2").reshape(-1, 8).astype(np.int32)
            near = np.zeros(len(at), dtype=bool)
            for i, j in _partners(table):
                close = ((at[i] - at[j]) ** 2).sum(axis=1) <= reach * reach
                near[i[close]] = near[j[close]] = True
            kept = table.select(schema.names).filter(pa.array(near)).combine_chunks()
            yield from kept.to_batches()

    return entries.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "block").mapInArrow(
        search, "cell bigint, low int, high int, block int, tab tinyint, node bigint")


def _links(candidates: DataFrame, of: tuple) -> DataFrame:
    """``node``, ``n`` vectors that it is linked with (copies counted), and rows with an ``other``: the edges of a forest
    that connects the vectors of a group as their links do."""
    schema = pa.schema([("node", pa.int64()), ("other", pa.int64()), ("n", pa.int64())])
    threshold = of[0]

    def verified(table: pa.Table) -> pa.RecordBatch:
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        tab, cell = table.column("tab").to_numpy().astype(np.int64), table.column("cell").to_numpy()
        names = table.column("space").to_pylist()
        spaces, space = _spaces(names), np.unique(names, return_inverse=True)[1]
        vectors = _doubles(table.column("vector"))
        sizes = np.array([len(v) for v in vectors])
        unit = np.zeros((len(node), sizes.max()))
        z = np.empty((len(node), of[1], 8))
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            unit[rows, :size] = _unit(np.stack([vectors[r] for r in rows]))
            z[rows] = _lattice(int(size), *of).project(np.ascontiguousarray(unit[rows, :size]))
        width = of[2] * radius(*of[:2])
        counts = np.zeros(len(node), dtype=np.int64)

        def linked():
            """The linked pairs of which this group is the place."""
            for i, j in _partners(table):
                here = (space[i] == space[j]) & (tab[i] == tab[j])
                i, j = i[here], j[here]
                here = ((z[i] - z[j]) ** 2).sum(axis=2).argmin(axis=1) == tab[i]
                i, j = i[here], j[here]
                points = nearest_e8((z[i, tab[i]] + z[j, tab[j]]) / 2 / width)
                here = cell_key(points, tab[i], spaces[i]) == cell[i]
                i, j = i[here], j[here]
                cosine = np.concatenate([np.zeros(0), *(
                    np.einsum("ij,ij->i", unit[i[a:a + 4096]], unit[j[a:a + 4096]]) for a in range(0, len(i), 4096))])
                for k in np.flatnonzero(np.abs(cosine - threshold) < 1e-12):  # the same verdict whatever the order of sums
                    cosine[k] = math.fsum(unit[i[k]] * unit[j[k]])
                close = cosine >= threshold
                i, j = i[close], j[close]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                yield i, j

        root = forest(len(node), linked())
        hit, child = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([node[hit], node[child]])),
            pa.array(np.concatenate([node[hit], node[root[child]]]), mask=np.arange(len(hit) + len(child)) < len(hit)),
            pa.array(np.concatenate([counts[hit], np.zeros(len(child), dtype=np.int64)]))], schema=schema)

    def search(batches):
        for table in _whole_groups(batches):
            yield verified(table)

    return candidates.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "block").mapInArrow(
        search, "node bigint, other bigint, n bigint")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tables: int = TABLES, cell: float = CELL) -> DataFrame:
    """``vec_id``, ``n_links`` (other rows with the same label and a cosine of at least ``threshold``), ``component_id``
    (smallest ``vec_id`` reachable over links) and ``kept`` (``vec_id`` is that one), one row for each row of ``vectors``.

    No link is missed (see above) and none is below the threshold. Rows whose label or embedding is null, or whose vector
    is empty, all zero or holds null, NaN or infinity, link with nothing; vectors of different sizes do not link either.
    Equal vectors are one entry with a count. Null ids stay null and are never the smallest unless all of the component
    are; repeated ids and rows stay rows of their own. Other columns aren't read; an empty table gives an empty result.
    """
    of = (threshold, tables, cell)
    rows = written(_linkable(vectors, False), "vectors")
    grouped = _linkable(vectors, True).where("key IS NOT NULL").groupBy("space", "key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first"), F.first("vector").alias("vector"))
    nodes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    # Cells with many vectors, from a counted share of all; only the dealing depends on it, not the result.
    share = _entries(nodes.where(F.pmod(F.xxhash64("node"), F.lit(COUNTED)) == 0), of)
    large = written(share.groupBy("cell").count().where(F.col("count") > BLOCK // COUNTED).select(
        "cell", F.ceil(F.col("count") * COUNTED / BLOCK).cast("int").alias("blocks")), "large")
    entries = _dealt(joined(_entries(nodes, of), large, "cell", "left", large.count(), 12))
    near = written(_with_neighbours(entries, of), "near")
    candidates = near.join(nodes.select("node", "space", "copies", "vector"), "node")
    found = written(_links(candidates, of), "links")
    links = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")), n)
    rooted = written(compact(
        nodes.drop("vector").join(links, "node", "left").join(roots.withColumnRenamed("fp", "node"), "node", "left").select(
            "space", "key", "first", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("root")), n), "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    each = rooted.join(least, "root").select("space", "key", "n_links", "component_id")
    result = rows.where("key IS NOT NULL").join(each, ["space", "key"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("key IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionAll(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
