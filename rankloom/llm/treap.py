"""Ranked lexical search with a K2-treap over the grid of terms and documents.

The grid's rows are the terms that the items ask for, its columns documents, and a cell holds what the term adds to the
document's score. A quadtree over the grid keeps its non-empty cells only, each with the largest impact below it. An item
is a set of rows; it goes down all its row paths at once, over ranges of documents: a range's bound is the sum of its
rows' cells, the ranges with the largest bounds are halved first, and a range goes as soon as its bound cannot enter the
ten best. A single document's bound is its score.

Documents are dealt in blocks, each with a quadtree of its own, so that memory is bounded; a task keeps the best of its
blocks for each item and passes their least score on to the next block. Texts are read once, into postings of the terms
that are asked for; counts cover all documents. Items go in slices of a bounded number of terms.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankloom.llm.common import buckets_for, written
from rankloom.llm.words import ALNUM, words_of

#: Rows (item, term) of one slice of items, about 150 bytes each in a task.
TERMS_PER_SLICE = 200_000
#: Documents and postings of one block at most.
BLOCK_DOCUMENTS = 4096
BLOCK_POSTINGS = 1 << 20
#: Node numbers that the open ranges of a block may hold before those of closed ones are thrown out.
ARENA = 1 << 22

_LAST = np.iinfo(np.int64).max


class Vocabulary:
    """The terms that are asked for, to be looked up among the words of many texts."""

    def __init__(self, terms: list[bytes]):
        words = next(words_of(pa.array([b" ".join(terms).decode()]), ALNUM, lower=False), None)
        hashes = words.hashes() if words is not None else np.zeros(0, dtype=np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.lengths = np.array([len(t) for t in terms], dtype=np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(terms), dtype=np.uint8)

    def find(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) for every word that is a term, compared byte by byte."""
        if not len(self.hashes) or not len(words):
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        word = np.flatnonzero(self.hashes[at] == hashes)
        term = self.order[at[word]]
        good = words.end[word] - words.start[word] == self.lengths[term]
        word, term = word[good], term[good]
        good = np.ones(len(word), dtype=bool)
        for size in np.unique(self.lengths[term]):
            rows = np.flatnonzero(self.lengths[term] == size)
            for k in range(size):
                good[rows] &= words.data[words.start[word[rows]] + k] == self.bytes[self.begins[term[rows]] + k]
        return word[good], term[good]


class K2Treap:
    """A quadtree over (row, column, impact): nodes of all levels in one numbering, each with its largest impact and its up
    to four children. ``children[node, 2 * lower half of rows + lower half of columns]`` is -1 where there is none."""

    def __init__(self, row: np.ndarray, column: np.ndarray, impact: np.ndarray, columns: int):
        self.height = max(1, int(max(row.max(initial=0), columns - 1)).bit_length())
        code = np.zeros(len(row), dtype=np.int64)
        for bit in range(self.height):
            code |= (row >> bit & 1) << (2 * bit + 1) | (column >> bit & 1) << (2 * bit)
        order = np.argsort(code)
        code, best = code[order], impact[order]
        codes, maxima, begins = [code], [best], []
        for _ in range(self.height):
            begin = np.flatnonzero(np.concatenate([[True], code[1:] >> 2 != code[:-1] >> 2])) if len(code) else code
            maxima.append(np.maximum.reduceat(maxima[-1], begin) if len(begin) else best)
            begins.append(begin)
            code = code[begin] >> 2
            codes.append(code)
        sizes = [len(c) for c in codes]
        firsts = np.cumsum(sizes) - sizes  # leaves come first, the root is the last node
        self.maxima = np.concatenate(maxima)
        self.children = np.full((len(self.maxima), 4), -1, dtype=np.int32)
        for level, begin in enumerate(begins):
            parent = np.repeat(np.arange(len(begin)), np.diff([*begin, sizes[level]]))
            self.children[firsts[level + 1] + parent, codes[level] & 3] = firsts[level] + np.arange(sizes[level])
        self.root = len(self.maxima) - 1


def _ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``begin[0]`` .. ``begin[0] + size[0] - 1``, then those of the next, and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)


class Best:
    """The ``k`` best documents of each item so far: scores (0: none), ids (``_LAST`` for null) and where they stand."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.score = np.zeros((items, k), dtype=np.int64)
        self.id = np.full((items, k), _LAST, dtype=np.int64)
        self.null = np.zeros((items, k), dtype=bool)

    def open(self, item: np.ndarray, bound: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether a document with that score and id, at best, would still enter."""
        last = self.score[item, -1]
        return (bound > last) | ((bound == last) & (last > 0) & (least < self.id[item, -1]))

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        mine = np.unique(item)
        n = len(mine)
        all_item = np.concatenate([np.repeat(mine, self.k), item])
        all_score = np.concatenate([self.score[mine].ravel(), score])
        all_id = np.concatenate([self.id[mine].ravel(), ids])
        all_null = np.concatenate([self.null[mine].ravel(), null])
        order = np.lexsort((all_null, all_id, -all_score, all_item))
        first = np.searchsorted(all_item[order], mine)
        kept = order[(first[:, None] + np.arange(self.k)).ravel()]
        for held, new in ((self.score, all_score), (self.id, all_id), (self.null, all_null)):
            held[mine] = new[kept].reshape(n, self.k)


def descend(treap: K2Treap, rows: list[np.ndarray], ids: np.ndarray, null: np.ndarray, best: Best) -> int:
    """Search one block for all items: ``rows`` are the rows of each one's terms. Returns how many ranges were halved.

    A batch takes the best quarter of each item's open ranges, eight at least, rather than one range at a time.
    """
    height = treap.height
    least = [np.concatenate([ids, np.full((1 << height) - len(ids), _LAST)])]  # smallest id in each range, by level
    for _ in range(height):
        least.append(least[-1].reshape(-1, 2).min(axis=1))
    level_begin = np.cumsum([0, *(len(x) for x in least)])
    least = np.concatenate(least)

    item = np.array([k for k, r in enumerate(rows) if len(r)], dtype=np.int64)
    if not len(item):
        return 0
    size = np.array([len(rows[k]) for k in item], dtype=np.int64)
    row = np.concatenate([rows[k] for k in item]).astype(np.int32)
    node = np.full(len(row), treap.root, dtype=np.int32)
    begin = np.cumsum(size) - size
    level = np.full(len(item), height, dtype=np.int64)
    column = np.zeros(len(item), dtype=np.int64)
    bound = size * treap.maxima[treap.root]
    halved = 0
    while True:
        live = best.open(item, bound, least[level_begin[level] + column])
        item, level, column, bound, begin, size = (x[live] for x in (item, level, column, bound, begin, size))
        if not len(item):
            return halved
        if len(row) > ARENA and size.sum() < len(row) // 2:
            at = _ragged(begin, size)
            row, node, begin = row[at], node[at], np.cumsum(size) - size
        order = np.lexsort((column, level, -bound, item))
        each, first, n = np.unique(item[order], return_index=True, return_counts=True)
        place = np.arange(len(order)) - np.repeat(first, n)
        taken = np.zeros(len(item), dtype=bool)
        taken[order[place < np.repeat(np.maximum(8, n // 4), n)]] = True
        halved += int(taken.sum())

        at = _ragged(begin[taken], size[taken])
        state = np.repeat(np.arange(int(taken.sum())), size[taken])
        down = level[taken] - 1
        child = treap.children[node[at]]
        half = 2 * (row[at] >> down[state] & 1)
        made = []
        for side in (0, 1):
            to = child[np.arange(len(at)), half + side]
            there = to >= 0
            to, of, r = to[there], state[there], row[at][there]
            ends = np.concatenate([[0], np.cumsum(treap.maxima[to])])
            count = np.bincount(of, minlength=len(down))
            upto = np.cumsum(count)
            made.append((item[taken], down, 2 * column[taken] + side, ends[upto] - ends[upto - count], count, r, to))
        kept = ~taken
        a_item, a_level, a_column, a_bound, a_size, a_row, a_node = (np.concatenate(x) for x in zip(*made))
        a_begin = np.cumsum(a_size) - a_size + len(row)
        row, node = np.concatenate([row, a_row]), np.concatenate([node, a_node])
        single = (a_level == 0) & (a_bound > 0)
        if single.any():
            at = a_column[single]
            best.add(a_item[single], a_bound[single], ids[at], null[at])
        more = (a_level > 0) & (a_bound > 0)
        item, level, column, bound, begin, size = (np.concatenate([x[kept], y[more]]) for x, y in (
            (item, a_item), (level, a_level), (column, a_column), (bound, a_bound), (begin, a_begin), (size, a_size)))


def _item_terms(items: DataFrame) -> DataFrame:
    """``row`` (a number of the item's row), ``item_id`` and ``term``, each once."""
    schema = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("term", pa.binary())])

    def cut(batches):
        for batch in batches:
            for words in words_of(batch.column("text"), ALNUM, lower=True):
                raw = words.data.tobytes()
                each = sorted({(t, raw[s:e]) for t, s, e in zip(words.text.tolist(), words.start.tolist(), words.end.tolist())})
                at = pa.array([words.first + t for t, _ in each], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").take(at), batch.column("item_id").take(at),
                    pa.array([w for _, w in each], pa.binary())], schema=schema)

    return items.select(
        F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("bigint").alias("item_id"),
        F.col("text").cast("string").alias("text")).mapInArrow(cut, "row bigint, item_id bigint, term binary")


def _postings(docs: DataFrame, vocabulary) -> DataFrame:
    """``doc_id``, ``n`` terms of its text, and of those in the vocabulary (``terms``) how often each occurs (``tf``)."""
    many = pa.list_(pa.int32())
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", many), ("tf", many)])

    def count(batches):
        known: Vocabulary = vocabulary.value
        for batch in batches:
            for words in words_of(batch.column("text"), ALNUM, lower=True):
                rows = words.last - words.first
                word, term = known.find(words)
                key, tf = np.unique(words.text[word] << 32 | term, return_counts=True)
                cuts = pa.array(np.searchsorted(key, np.arange(rows + 1) << 32), pa.int32())
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (key & 0xFFFFFFFF, tf)]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(words.first, rows), pa.array(words.counts().astype(np.int64)), *lists],
                    schema=schema)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        count, "doc_id bigint, n bigint, terms array<int>, tf array<int>")


def _blocks(batches) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, null ids, n, column, term, tf) of blocks of documents."""
    held, documents, postings = [], 0, 0
    for batch in batches:
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            held.append(part)
            documents += part.num_rows
            postings += len(part.column("terms").flatten())
            if documents >= BLOCK_DOCUMENTS or postings >= BLOCK_POSTINGS:
                yield _block(held)
                held, documents, postings = [], 0, 0
    if held:
        yield _block(held)


def _block(held: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    table = pa.Table.from_batches(held).combine_chunks()
    ids, terms = table.column("doc_id"), table.column("terms").combine_chunks()
    column = np.repeat(np.arange(table.num_rows), np.diff(terms.offsets.to_numpy()))
    return (ids.fill_null(int(_LAST)).to_numpy(), ids.is_null().to_numpy(), table.column("n").to_numpy(), column,
            terms.flatten().to_numpy().astype(np.int64),
            table.column("tf").combine_chunks().flatten().to_numpy().astype(np.int64))


def impacts(weight: np.ndarray, tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """What a term of that weight adds to the score of a document of ``n`` terms in which it occurs ``tf`` times."""
    if 90 * int(n.max(initial=0)) * documents >= 1 << 63:
        m = np.array([10 + 90 * x * documents // length for x in n.tolist()], dtype=np.int64)
    else:
        m = 10 + 90 * n * documents // length
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def _slice(docs: DataFrame, items: list, k: int) -> DataFrame:
    """The ``k`` best documents of each task for some items, given as rows of ``_item_terms``."""
    spark = docs.sparkSession
    terms = sorted({bytes(r["term"]) for r in items})
    number = {t: i for i, t in enumerate(terms)}
    postings = written(_postings(docs, spark.sparkContext.broadcast(Vocabulary(terms))), "postings")
    documents, length = postings.agg(
        F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weight = np.zeros(len(terms), dtype=np.int64)
    # One row for each term of the slice.
    for term, df in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weight[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    of: dict[int, list[int]] = {}
    names = {}
    for r in items:
        names[r["row"]] = r["item_id"]
        of.setdefault(r["row"], []).append(number[bytes(r["term"])])
    rows = sorted(of)
    shared = spark.sparkContext.broadcast((rows, [names[r] for r in rows], [np.array(of[r]) for r in rows], weight))
    schema = pa.schema([("row", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches):
        numbers, names, wanted, weight = shared.value
        best = Best(len(numbers), k)
        by_weight = np.argsort(weight, kind="stable")  # cells with rows of like weights have tight maxima
        place = np.empty_like(by_weight)
        place[by_weight] = np.arange(len(by_weight))
        for ids, null, n, column, term, tf in _blocks(batches):
            impact = impacts(weight[term], tf, n[column], documents, length)
            good = impact > 0
            column, term, impact = column[good], term[good], impact[good]
            if not len(term):
                continue
            # Documents with the same strongest term next to each other: few ranges then have all of an item's terms.
            order = np.lexsort((impact, column))
            last = np.flatnonzero(np.diff(column[order], append=-1))
            strongest = np.full(len(ids), -1, dtype=np.int64)
            strongest[column[order][last]] = place[term[order][last]]
            order = np.lexsort((n, strongest))
            to = np.empty_like(order)
            to[order] = np.arange(len(order))
            present, row = np.unique(place[term], return_inverse=True)
            treap = K2Treap(row, to[column], impact, len(ids))
            mine = []
            for w in wanted:
                at = np.searchsorted(present, place[w])
                mine.append(at[present[np.minimum(at, len(present) - 1)] == place[w]])
            descend(treap, mine, ids[order], null[order], best)
        item, at = np.nonzero(best.score > 0)
        yield pa.RecordBatch.from_arrays([
            pa.array([numbers[i] for i in item], pa.int64()), pa.array([names[i] for i in item], pa.int64()),
            pa.array(best.id[item, at], mask=best.null[item, at]), pa.array(best.score[item, at])], schema=schema)

    return postings.mapInArrow(search, "row bigint, item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score`` of the ``k`` documents with the highest scores above 0 for each
    row of ``items``, equal scores by ascending ``doc_id`` (null last).

    Null and empty texts have no terms: such a document is not counted and never found, such an item has no rows. Items
    with equal or null ids are ranked one by one; documents with equal or null ids, and repeated rows, are documents of
    their own. Other columns aren't read; an empty table gives an empty result.
    """
    terms = written(_item_terms(items), "terms")
    slices = buckets_for(terms.count(), TERMS_PER_SLICE)
    found = None
    for s in range(slices):
        mine = terms.where(F.pmod(F.xxhash64("row"), F.lit(slices)) == s).collect()
        if mine:
            part = _slice(docs, mine, k)
            found = part if found is None else found.unionAll(part)
    if found is None:
        return terms.selectExpr("item_id", "1 AS rank", "0L AS doc_id", "0L AS score").where("false")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
