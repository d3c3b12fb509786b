"""SimHash near-duplicates through a Gray-order hierarchical index.

The upper nodes of the index are masked bit patterns: the 64 bits are cut into three segments and the rest into three
again, and a node is the value of one segment and one of the parts of the rest. Two fingerprints that differ in two bits
or fewer agree in at least one of these nine masks, so every pair meets below some upper node, and nodes are what Spark
deals out. Below a node the fingerprints are sorted by Gray rank and a binary tree is laid over them, whose nodes hold
the bits that all their fingerprints share and no ancestor held; a search adds up the differences on its way down and
leaves a whole branch when they exceed the limit.

Equal fingerprints are one entry. A fingerprint has at most 2,080 others within two bits, and below a node only the edges
of a spanning forest are kept, so no step is quadratic in the size of a group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankloom.llm.common import compact, written
from rankloom.llm.words import UNSPACED, words_of

#: Fingerprints in a leaf of the tree.
LEAF = 16
#: Pairs of a search and a tree node that are open at once.
FRONTIER = 1 << 18
SEED = 42

_PRINTED = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])


def _fingerprints(column: pa.Array, shingle: int) -> np.ndarray:
    """The SimHash of each text, as uint64."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = []
    for words in words_of(column, UNSPACED, lower=True):
        bounds = words.bounds()
        raw = words.data.tobytes()
        word = [raw[s:e] for s, e in zip(words.start.tolist(), words.end.tolist())]
        found = np.zeros(words.last - words.first, dtype=np.uint64)
        for text in np.flatnonzero(np.diff(bounds)):
            mine = word[bounds[text]: bounds[text + 1]]
            n = max(1, len(mine) - shingle + 1)
            ahead = [mine[k: k + n] for k in range(min(shingle, len(mine)))]
            h = np.fromiter((digest(b" ".join(t), SEED) for t in zip(*ahead)), dtype="<u8", count=n)
            ones = np.zeros(64, dtype=np.int64)
            for at in range(0, n, 1 << 14):
                bits = np.unpackbits(h[at: at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.uint32)
            found[text] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
        out.append(found)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def fingerprint_of(text: Column, shingle: int = 3) -> Column:
    """The SimHash of a text as a signed long; null and blank texts have 0."""

    @F.arrow_udf("bigint")
    def simhash(column: pa.Array) -> pa.Array:
        return pa.array(_fingerprints(column, shingle).view(np.int64))

    return simhash(text.cast("string"))


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each code in the order of the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp ^ (fp >> np.uint64(shift))
    return fp


def _parts(first: int, last: int) -> list[tuple[int, int]]:
    step = (last - first) / 3
    cuts = [first + round(i * step) for i in range(4)]
    return list(zip(cuts, cuts[1:]))


def upper_masks() -> list[int]:
    """The nine masks: a third of the bits, and a third of the bits that are left."""
    masks = []
    for a, b in _parts(0, 64):
        segment = ((1 << b) - 1) ^ ((1 << a) - 1)
        rest = [i for i in range(64) if not segment >> i & 1]
        for c, d in _parts(0, len(rest)):
            masks.append(segment | sum(1 << i for i in rest[c:d]))
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


class GrayTree:
    """A binary tree over fingerprints in Gray order; each node has the bits that are shared in it and new in it."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        size = len(fps)
        leaves = 1 << max(0, (max(1, -(-size // LEAF)) - 1).bit_length())
        self.cuts = (np.arange(leaves + 1) * size) // leaves  # the same number of fingerprints in each leaf, but for one
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        ones, zeros = [], []
        for a, b in zip(self.cuts, self.cuts[1:]):
            ones.append(np.bitwise_and.reduce(self.fps[a:b], initial=full))
            zeros.append(np.bitwise_and.reduce(~self.fps[a:b], initial=full))
        self.levels = [(np.array(ones, dtype=np.uint64), np.array(zeros, dtype=np.uint64))]
        while len(self.levels[0][0]) > 1:
            one, zero = self.levels[0]
            self.levels.insert(0, (one[::2] & one[1::2], zero[::2] & zero[1::2]))
        self.masks, self.values = [], []
        for depth, (one, zero) in enumerate(self.levels):
            shared = one | zero
            if depth:
                above = self.levels[depth - 1]
                shared = shared & ~np.repeat(above[0] | above[1], 2)
            self.masks.append(shared)
            self.values.append(one & shared)

    def pairs(self, limit: int):
        """Arrays (i, j), i < j, of the fingerprints within ``limit`` bits, by their place in Gray order."""
        step = max(1, FRONTIER // (4 * max(1, len(self.cuts))))
        for begin in range(0, len(self.fps), step):
            query = np.arange(begin, min(begin + step, len(self.fps)))
            node = np.zeros(len(query), dtype=np.int64)
            differ = np.zeros(len(query), dtype=np.int64)
            for depth in range(len(self.levels)):
                if depth:
                    query, differ = np.repeat(query, 2), np.repeat(differ, 2)
                    node = np.repeat(2 * node, 2)
                    node[1::2] += 1
                odd = (self.fps[query] & self.masks[depth][node]) ^ self.values[depth][node]
                differ = differ + np.bitwise_count(odd)
                open_ = (differ <= limit) & (self.cuts[(node + 1) << (len(self.levels) - 1 - depth)] > query)
                query, node, differ = query[open_], node[open_], differ[open_]
            first, n = self.cuts[node], self.cuts[node + 1] - self.cuts[node]
            for at in range(0, len(query), FRONTIER // LEAF):
                part = slice(at, at + FRONTIER // LEAF)
                i = np.repeat(query[part], n[part])
                ends = np.cumsum(n[part])
                j = np.arange(len(i)) - np.repeat(ends - n[part], n[part]) + np.repeat(first[part], n[part])
                near = (j > i) & (np.bitwise_count(self.fps[i] ^ self.fps[j]) <= limit)
                yield i[near], j[near]


def _forest(size: int, pairs) -> np.ndarray:
    """The smallest member of each one's component."""
    label = np.arange(size)
    for i, j in pairs:
        while len(i):
            a, b = label[i], label[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(label, high, low)
            while True:  # every label points to a root
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
            open_ = label[i] != label[j]
            i, j = i[open_], j[open_]
    return label


def _edges_below(fps: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the fingerprints below one upper node: (fingerprint, smaller root)."""
    tree = GrayTree(fps)
    label = _forest(len(fps), tree.pairs(limit))
    child = np.flatnonzero(label != np.arange(len(fps)))
    return tree.fps[child], tree.fps[label[child]]


def links(distinct: DataFrame, limit: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` that connect the distinct fingerprints ``fp`` exactly as all pairs within ``limit`` bits do."""
    if not 0 <= limit <= 2:
        raise ValueError("the nine masks find pairs that differ in two bits or fewer")
    masks = upper_masks()
    nodes = distinct.select("fp", F.explode(F.array(*(
        F.struct(F.lit(k).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"))
        for k, m in enumerate(masks)))).alias("node")).select("node.mask", "node.value", "fp")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(batches):
        held: list[np.ndarray] = []
        key = None

        def close():
            fps = np.concatenate(held) if held else np.empty(0, dtype=np.uint64)
            if len(fps) > 1:
                a, b = _edges_below(fps, limit)
                yield from zip(a.view(np.int64).tolist(), b.view(np.int64).tolist())

        for batch in batches:
            out: list[tuple[int, int]] = []
            mask, value, fp = (batch.column(c).to_numpy() for c in range(3))
            new = np.flatnonzero((np.diff(mask) != 0) | (np.diff(value) != 0)) + 1
            for a, b in zip([0, *new], [*new, len(fp)]):
                if b == a:
                    continue
                mine = (int(mask[a]), int(value[a]))
                if mine != key:
                    out += close()
                    held, key = [], mine
                held.append(fp[a:b].view(np.uint64))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)
        out = list(close())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    # A node with one fingerprint has no pair: most rows go before Python sees them.
    many = F.count(F.lit(1)).over(Window.partitionBy("mask", "value")) > 1
    alone = nodes.withColumn("_many", many).where("_many").drop("_many")
    return alone.sortWithinPartitions("mask", "value").mapInArrow(search, "a bigint, b bigint").distinct()


def components(edges: DataFrame, rows: int = 0) -> DataFrame:
    """``fp``, ``root`` for every end of an edge: the smallest fingerprint reachable. Large stars and small stars in turn,
    until every component is a star; every round is written, and no node's neighbours are gathered. ``rows`` is about how
    many edges there are."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    edges = written(compact(edges.distinct(), rows), "edges")
    while True:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("m"))
        large = both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()  # every larger neighbour to the smallest of the neighbourhood
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
            .alias("e")).select("e.a", "e.b").where("a <> b").distinct()
        edges = written(compact(small, rows), "edges")
        parents = edges.agg(F.count(F.lit(1)) == F.countDistinct("a")).first()[0]
        if parents and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("b").alias("fp")).distinct()
    return edges.select(F.col("a").alias("fp"), F.col("b").alias("root")).unionAll(
        roots.select("fp", F.col("fp").alias("root")))


def near_duplicates(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest ``doc_id`` reachable over links.

    Null and blank texts have fingerprint zero and link like any other. Null ids stay null and are never the smallest,
    unless all ids of the component are null; repeated rows stay. Other columns aren't read; an empty table gives an
    empty result.
    """
    printed = written(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), fingerprint_of(F.col("text"), shingle).alias("fp")), "printed")
    least = _least(printed, F.col("doc_id"), limit)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    # One row per fingerprint on the right side: a hot fingerprint can be split on the left.
    rows = compact(printed.join(least, "fp", "left"), printed.count())
    return rows.select("doc_id", hexed.alias("fingerprint"), F.col("least").alias("component_id"))


def _least(printed: DataFrame, what: Column, limit: int) -> DataFrame:
    """For every distinct ``fp``, the smallest ``what`` in its component."""
    rows = printed.count()
    distinct = written(compact(printed.groupBy("fp").agg(F.min(what).alias("first")), rows), "distinct")
    roots = components(links(distinct.select("fp"), limit), rows)
    rooted = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = written(compact(rooted, rows), "rooted")
    best = rooted.groupBy("root").agg(F.min("first").alias("least"))
    return rooted.join(best, "root").select("fp", "least")


def one_of_each(docs: DataFrame, shingle: int = 3, limit: int = 2) -> DataFrame:
    """``docs`` with all its columns, one row of each component: the one with the smallest ``doc_id`` (a null id only where
    there is no other), of several with that id the one whose content hash is smallest, of equal rows one."""
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    ident, text = F.col(f"c{names.index('doc_id')}"), F.col(f"c{names.index('text')}")
    content = F.xxhash64(*plain.columns)
    marked = plain.withColumn("_row", F.struct(ident.isNull().alias("none"), ident.alias("id"), content.alias("hash")))
    printed = written(marked.select(fingerprint_of(text, shingle).alias("fp"), "_row"), "printed")
    kept = _least(printed, F.col("_row"), limit).select("least.hash", "least.id").distinct()
    # The row's content hash is the key of the join and of the last window, so that they share one shuffle.
    own = plain.withColumn("hash", content).join(
        kept.select("hash", "id"), "hash").where(ident.eqNullSafe(F.col("id")))
    nth = F.row_number().over(Window.partitionBy("hash").orderBy("hash"))
    return own.withColumn("_nth", nth).where("_nth = 1").select(*plain.columns).toDF(*names)
