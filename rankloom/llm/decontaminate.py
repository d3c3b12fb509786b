"""Benchmark decontamination: the word windows of the benchmark are broadcast as a hash set, every window of a document is
looked up, and hits are verified word by word.

The set is broadcast in slices of a bounded size; a benchmark of more windows is scanned slice after slice, each pass
adding its hits to those of the passes before, so memory is bounded whatever the benchmark holds.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.llm.common import buckets_for, compact, written
from rankloom.llm.words import ALNUM, Words, mixed, words_of

#: Windows of one broadcast slice, about 250 bytes each in a task.
WINDOWS_PER_SLICE = 200_000
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_FILTER_BITS = 20

_FOUND = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_ITEMS = pa.list_(pa.int64())


def _window_hashes(hashes: np.ndarray, longest: int):
    """(n, hashes of the windows of n words that begin at each word) for n from 1 on."""
    total = np.zeros(len(hashes), dtype=np.uint64)
    factor = np.uint64(1)
    for n in range(1, longest + 1):
        if len(hashes) < n:
            return
        total = total[: len(hashes) - n + 1] + hashes[n - 1:] * factor
        factor = factor * _STEP
        yield n, mixed(total)


def _window(words: Words, i: int, n: int) -> bytes:
    return b" ".join(words.data[s:e].tobytes() for s, e in zip(words.start[i:i + n], words.end[i:i + n]))


def windows(benchmark: DataFrame, size: int) -> DataFrame:
    """The distinct windows of all items: ``n`` words, ``words`` joined by spaces, ``hash``, ``item_id``. An item with
    fewer than ``size`` words, but not none, is one window."""
    schema = pa.schema([("n", pa.int32()), ("words", pa.binary()), ("hash", pa.int64()), ("item_id", pa.int64())])

    def cut(batches):
        for batch in batches:
            ids = batch.column(0)
            for words in words_of(batch.column(1), ALNUM, lower=True):
                bounds, counts = words.bounds(), words.counts()
                by_length = dict(_window_hashes(words.hashes(), size))
                rows = []
                for text in range(words.last - words.first):
                    n = min(size, int(counts[text]))
                    if n:
                        item = ids[words.first + text].as_py()
                        rows += [(n, _window(words, i, n), int(by_length[n][i].view(np.int64)), item)
                                 for i in range(bounds[text], bounds[text + 1] - n + 1)]
                columns = zip(*rows) if rows else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        cut, "n int, words binary, hash bigint, item_id bigint").distinct()


class HashSet:
    """The windows of one slice: a bit filter over hashes, the hashes, and the items of each window for the check."""

    def __init__(self, rows):
        self.longest = 0
        self.filters: dict[int, np.ndarray] = {}
        self.hashes = np.unique(np.array([r["hash"] for r in rows], dtype=np.int64).view(np.uint64))
        self.items: dict[tuple[int, bytes], list[int]] = defaultdict(list)
        for r in rows:
            n = r["n"]
            self.longest = max(self.longest, n)
            bits = self.filters.setdefault(n, np.zeros(1 << _FILTER_BITS, dtype=bool))
            bits[np.int64(r["hash"]).view(np.uint64) >> np.uint64(64 - _FILTER_BITS)] = True
            if r["item_id"] is not None:
                self.items[n, bytes(r["words"])].append(r["item_id"])
            else:
                self.items.setdefault((n, bytes(r["words"])), [])
        self.items = dict(self.items)

    def hits(self, words: Words):
        """(text, first word, end word, items) of every occurrence; words count from the text's first."""
        bounds = words.bounds()
        for n, hashes in _window_hashes(words.hashes(), self.longest):
            if n not in self.filters:
                continue
            maybe = np.flatnonzero(self.filters[n][hashes >> np.uint64(64 - _FILTER_BITS)])
            maybe = maybe[words.text[maybe] == words.text[maybe + n - 1]]  # not across two texts
            at = np.searchsorted(self.hashes, hashes[maybe])
            maybe = maybe[self.hashes[np.minimum(at, len(self.hashes) - 1)] == hashes[maybe]]
            for i in maybe:
                items = self.items.get((n, _window(words, i, n)))
                if items is not None:
                    text = int(words.text[i])
                    yield text, int(i - bounds[text]), int(i - bounds[text]) + n, items


def _slices(benchmark: DataFrame, size: int):
    """The broadcast hash sets, one after another."""
    found = written(compact(windows(benchmark, size), 0), "windows")
    slices = buckets_for(found.count(), WINDOWS_PER_SLICE)
    sc = benchmark.sparkSession.sparkContext
    for k in range(slices):
        rows = found.where(F.pmod(F.xxhash64("n", "words"), F.lit(slices)) == k).collect()
        yield sc.broadcast(HashSet(rows)), k == slices - 1


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((first, end))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``spans`` (word ranges, end exclusive, merged and sorted)
    and ``items`` (ids of the items with a window in the text).

    Null and empty texts have no words. Null and repeated document ids and repeated rows stay rows of their own. Items
    with equal ids are one item; windows of an item without an id hit words but are not listed. An empty benchmark hits
    nothing; other columns aren't read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_words", pa.int64()), ("spans", _FOUND),
                        ("items", _ITEMS)])
    ddl = ("doc_id bigint, text string, n_words bigint, spans array<struct<first: bigint, end: bigint>>, "
           "items array<bigint>")

    def look(hash_set, last):
        def run(batches):
            known = hash_set.value
            for batch in batches:
                for words in words_of(batch.column("text"), ALNUM, lower=True):
                    rows = words.last - words.first
                    part = batch.slice(words.first, rows)
                    spans: list = [[] for _ in range(rows)]
                    items: list = [[] for _ in range(rows)]
                    if "spans" in part.schema.names:
                        spans = [[(x["first"], x["end"]) for x in v] for v in part.column("spans").to_pylist()]
                        items = part.column("items").to_pylist()
                    touched = {}
                    for text, first, end, ids in known.hits(words):
                        spans[text].append((first, end))
                        touched.setdefault(text, set(items[text])).update(ids)
                    for text, ids in touched.items():
                        spans[text], items[text] = _merged(spans[text]), sorted(ids)
                    texts = pa.nulls(rows, pa.string()) if last else part.column("text").cast(pa.string())
                    yield pa.RecordBatch.from_arrays([
                        part.column("doc_id"), texts, pa.array(words.counts().astype(np.int64)),
                        pa.array([[{"first": a, "end": b} for a, b in v] for v in spans], _FOUND),
                        pa.array(items, _ITEMS)], schema=schema)
        return run

    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    for hash_set, last in _slices(benchmark, size):
        out = out.mapInArrow(look(hash_set, last), ddl)
        if not last:
            out = written(out, "scanned")
    return out.drop("text")


def decontaminated(docs: DataFrame, benchmark: DataFrame, size: int = 10, remove: str = "documents") -> DataFrame:
    """``docs`` with all its columns, without what is in the benchmark: ``remove="documents"`` drops each row with a hit,
    ``remove="spans"`` cuts the words that are hit, with what stands between them, out of the text (``n_chars``, where
    there is one, follows). Rows without a hit stay as they are."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    names = docs.columns
    at = names.index("text")
    inner = docs.toDF(*(f"c{i}" for i in range(len(names)))).withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    length = names.index("n_chars") if "n_chars" in names and isinstance(
        docs.schema["n_chars"].dataType, (T.LongType, T.IntegerType)) else None

    # Spans of all slices are collected on the whole text and cut once: a cut text has other windows.
    hits = T.StructField("hits", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("first", "end")])))
    with_hits = T.StructType([*inner.schema.fields, hits])

    def clean(hash_set, last):
        def run(batches):
            known = hash_set.value
            for batch in batches:
                column = batch.column(at)
                for words in words_of(column, ALNUM, lower=True):
                    rows = words.last - words.first
                    part = batch.slice(words.first, rows)
                    spans = defaultdict(list)
                    if len(part.schema.names) > len(names):
                        for text, found in enumerate(part.column(len(names)).to_pylist()):
                            if found:
                                spans[text] = [(x["first"], x["end"]) for x in found]
                        part = part.select(part.schema.names[:-1])
                    for text, first, end, _ in known.hits(words):
                        spans[text].append((first, end))
                    if remove == "documents":
                        keep = np.ones(rows, dtype=bool)
                        keep[list(spans)] = False
                        yield part.filter(pa.array(keep))
                    elif not last:
                        found = [[{"first": a, "end": b} for a, b in _merged(spans.get(k, []))] for k in range(rows)]
                        yield pa.RecordBatch.from_arrays(
                            [*part.columns, pa.array(found, _FOUND)], names=[*part.schema.names, "hits"])
                    elif spans:
                        yield _cut_out(part, words, spans, at, length)
                    else:
                        yield part
        return run

    plain = inner.schema
    for hash_set, last in _slices(benchmark, size):
        inner = inner.mapInArrow(clean(hash_set, last), plain if last or remove == "documents" else with_hits)
        if not last:
            inner = written(inner, "cleaned")
    return inner.toDF(*names)


def _cut_out(part: pa.RecordBatch, words: Words, spans: dict, at: int, length: int | None) -> pa.RecordBatch:
    texts, bounds = part.column(at).to_pylist(), words.bounds()
    lengths = part.column(length).to_pylist() if length is not None else []
    for text, found in spans.items():
        raw, begin, kept, done = texts[text].encode(), words.offsets[text], [], 0
        for first, end in _merged(found):
            kept.append(raw[done: words.start[bounds[text] + first] - begin])
            done = words.end[bounds[text] + end - 1] - begin
        texts[text] = b"".join([*kept, raw[done:]]).decode()
        if lengths:
            lengths[text] = len(texts[text])
    columns = list(part.columns)
    columns[at] = pa.array(texts, columns[at].type)
    if lengths:
        columns[length] = pa.array(lengths, columns[length].type)
    return pa.RecordBatch.from_arrays(columns, schema=part.schema)
