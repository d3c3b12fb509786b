"""Best-fit decreasing packing of token sequences.

Lengths are whole numbers up to the capacity, so the whole corpus is described by one histogram of at most ``capacity``
counts. Best-fit decreasing is run on that histogram: bins with the same remaining capacity form groups, and a segment
tree over the remaining capacities finds the tightest open one in logarithmic time. Equal lengths are placed in runs, so
the plan has a size that depends on the capacity alone, whatever the number of documents; it is the very packing that
placing the documents one by one would give.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from rankloom.llm.common import buckets_for, compact, written
from rankloom.llm.words import UNSPACED, words_of

#: Distinct runs whose ids a worker remembers before it starts anew. About 200 bytes each.
REMEMBERED_RUNS = 450_000
#: Runs of up to so many bytes are kept when the others are forgotten.
SHORT_RUN = 8
#: Rows of one window that numbers pieces of equal length.
ROWS_PER_BUCKET = 1024

# Fixed values of byte-level BPE: bytes 0 to 32, 127 to 160 and 173 are written as the characters from U+0100 on.
UNPRINTED = {b: 0x100 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}

#: Bytes that characters from U+0300 on begin with. The tokenizer joins combining marks to their letters before it lower-cases,
#: so a word that may hold one goes to it as it is.
COMPOSING = np.arange(256) >= 0xCC

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PIECES_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
])


class RunIds:
    """Token ids of many texts at once.

    A text is cut into runs between which the tokenizer never joins anything: at ASCII white space, and inside words of
    plain letters and signs also between letters and signs. Words with an apostrophe or with a character beyond Latin-1
    letters stay whole, those with characters that may combine in their own case. Each distinct run is encoded once by the
    tokenizer and remembered; the rest is numpy. A run of letters goes straight to the tokenizer's merges, as normalising and splitting change nothing about it but the case;
    whether they do so in the given tokenizer is tried out first.

    With ``added``, the tokenizer's added tokens, such as ``<|endoftext|>``, are recognised in texts as the tokenizer does
    when it is loaded; a text that may hold one goes to it whole. Without, they are letters and signs like any others.
    """

    LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

    def __init__(self, tokenizer_path: str, added: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self._start()
        probe = "the unbelievably über naïve ÉÈÀ ßÿ øþ".split()
        self.direct = [self._merged(w.lower()) for w in probe] == [
            e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]

    def _merged(self, letters: str) -> list[int]:
        """Ids of a lower-case word: its UTF-8 bytes, as the characters that byte-level merges are written in."""
        if not letters.isascii():
            # Bytes of two-byte characters that have no printable Latin-1 character are written from U+0100 on.
            letters = letters.encode().decode("latin-1").translate(UNPRINTED)
        return [t.id for t in self.tokenizer.model.tokenize(letters)]

    def _start(self) -> None:
        self.rows: dict[bytes, int] = {}
        self.ids = np.empty(1 << 20, dtype=np.uint32)
        self.begin = np.zeros(1 << 18, dtype=np.int64)  # of each row in ids; the next one's is its end

    def _forget(self) -> None:
        """Keep the short runs, which come again and again, as long as they leave room for others."""
        kept, longest = list(self.rows.items()), SHORT_RUN
        while len(kept) > REMEMBERED_RUNS // 2:
            kept, longest = [(run, row) for run, row in kept if len(run) <= longest], longest - 1
        ids, begin = self.ids, self.begin
        self._start()
        if kept:
            row = np.fromiter((r for _, r in kept), dtype=np.int64, count=len(kept))
            self._store([run for run, _ in kept], np.concatenate([ids[begin[r]: begin[r + 1]] for r in row]),
                        begin[row + 1] - begin[row])

    def _store(self, runs: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        row = len(self.rows)
        ends = self.begin[row] + np.cumsum(sizes)
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while row + len(runs) + 1 > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        self.ids[self.begin[row]: ends[-1]] = ids
        self.begin[row + 1: row + 1 + len(runs)] = ends
        self.rows.update(zip(runs, range(row, row + len(runs))))

    def _learn(self, runs: list[bytes]) -> None:
        for at in range(0, len(runs), 5_000):  # an encoding holds far more than the ids
            some = runs[at: at + 5_000]
            words = [r.decode() for r in some]
            plain = [self.direct and self.LETTERS.fullmatch(r) is not None for r in some]
            other = iter(self.tokenizer.encode_batch_fast(
                [w for w, p in zip(words, plain) if not p], add_special_tokens=False))
            ids = [self._merged(w.lower()) if p else next(other).ids for w, p in zip(words, plain)]
            self._store(some, np.fromiter(chain.from_iterable(ids), dtype=np.uint32),
                        np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)))

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        whole = np.zeros(len(column), dtype=bool)
        for token in self.added:
            whole |= pc.fill_null(pc.match_substring(column, token, ignore_case=True), False).to_numpy(zero_copy_only=False)
        if not whole.any():
            yield from self._of_runs(column)
            return
        rest = self._of_runs(pc.if_else(pa.array(whole), pa.scalar("", column.type), column))
        for text, (ids, alone) in enumerate(zip(rest, whole)):
            if alone:
                ids = np.array(self.tokenizer.encode(column[text].as_py(), add_special_tokens=False).ids, dtype=np.uint32)
            yield ids

    def _of_runs(self, column: pa.Array) -> Iterator[np.ndarray]:
        for runs in words_of(column, UNSPACED, lower=True, cut=_letters_from_signs, keep=COMPOSING):
            _, first, which = np.unique(runs.hashes(), return_index=True, return_inverse=True)
            raw = runs.data.tobytes()
            distinct = [raw[s:e] for s, e in zip(runs.start[first].tolist(), runs.end[first].tolist())]
            if len(self.rows) + len(distinct) > REMEMBERED_RUNS:
                self._forget()
            self._learn([r for r in distinct if r not in self.rows])
            row = np.fromiter(map(self.rows.__getitem__, distinct), dtype=np.int64, count=len(distinct))
            begin, size = self.begin[row][which], (self.begin[row + 1] - self.begin[row])[which]
            ends = np.cumsum(size)
            ids = self.ids[np.repeat(begin - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
            upto = np.concatenate(([0], ends))[runs.bounds()]
            for a, b in zip(upto, upto[1:]):
                yield ids[a:b]


def _letters_from_signs(data: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Where a run begins inside a word. ``word`` numbers the word of each byte."""
    letter = (data >= 97) & (data <= 122)
    pair = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # a Latin-1 letter
    letter[:-1] |= pair
    letter[1:] |= pair
    begins = np.zeros(len(data), dtype=bool)
    begins[1:] = letter[1:] != letter[:-1]
    whole = np.zeros(int(word[-1]) + 2 if len(word) else 1, dtype=bool)
    whole[word[(data == 39) | ((data >= 128) & ~letter)]] = True
    return begins & ~whole[word]


_known: dict[tuple[str, bool], RunIds] = {}


def _run_ids(path: str, added: bool) -> RunIds:
    if (path, added) not in _known:
        _known[path, added] = RunIds(path, added)
    return _known[path, added]


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0, added: bool = False
) -> DataFrame:
    """One row per piece of each document: its ids and ``end_id``, cut into pieces of ``capacity`` where longer."""

    def cut(batches):
        run_ids = _run_ids(tokenizer_path, added)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        width = 4 * capacity
        for batch in batches:
            rows: list[tuple] = []
            for key, ids in zip(batch.column(0).to_pylist(), run_ids.of(batch.column(1))):
                raw = ids.astype("<u4").tobytes() + end
                for piece, at in enumerate(range(0, len(raw), width)):
                    part = raw[at:at + width]
                    rows.append((key, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, PIECES_ARROW.types)],
                schema=PIECES_ARROW)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


class TightestFit:
    """A segment tree over remaining capacities: which is the smallest one, at least ``need``, that has bins?"""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [False] * (2 * self.leaves)

    def mark(self, room: int, open_: bool) -> None:
        at = room + self.leaves
        self.tree[at] = open_
        while at > 1:
            at //= 2
            self.tree[at] = self.tree[2 * at] or self.tree[2 * at + 1]

    def find(self, need: int) -> int | None:
        at = need + self.leaves
        if self.tree[at]:
            return need
        while at > 1:  # up to the first subtree to the right that has bins, then down to its leftmost
            if at % 2 == 0 and self.tree[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.tree[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


@dataclass(frozen=True)
class Run:
    """Documents ``first`` to ``first + count - 1`` of one length: ``per_bin`` to a bin, from ``bin`` on, at ``offset``."""

    length: int
    first: int
    count: int
    per_bin: int
    bin: int
    offset: int


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[Run]:
    """The runs of a best-fit decreasing packing of ``histogram`` (length to count).

    Of bins with equal room the ones put there last are taken first. A touched group keeps less than half of its room and
    each length splits one group at most, so there are O(capacity log capacity) runs.
    """
    tree = TightestFit(capacity)
    rooms: dict[int, list[tuple[int, int]]] = {}  # room -> (first bin, bins), each group with consecutive bins
    runs, bins = [], 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            rooms.setdefault(room, []).append((first, n))
            tree.mark(room, True)

    def fill(length: int, left: int, room: int, first: int, n: int) -> int:
        """Place documents into bins of equal room; returns how many are left."""
        per_bin = room // length
        placed = min(left, n * per_bin)
        runs.append(Run(length, histogram[length] - left, placed, per_bin, first, capacity - room))
        full, rest = divmod(placed, per_bin)
        put(room, first + full + (rest > 0), n - full - (rest > 0))
        put(room - per_bin * length, first, full)
        put(room - rest * length, first + full, int(rest > 0))
        return left - placed

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = tree.find(length)
            if room is None:
                n = -(-left // (capacity // length))
                first, bins = bins, bins + n
                room = capacity
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.mark(room, False)
            left = fill(length, left, room, first, n)
    return runs


def numbered_in_length(pieces: DataFrame, rows: int) -> DataFrame:
    """Add ``nth``: gapless numbers from 0 among the pieces of equal length, without a window over a whole length."""
    dealt = pieces.withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets_for(rows, ROWS_PER_BUCKET))))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (
        dealt.withColumn("_i", F.row_number().over(inside) - 1)
        .join(bases, ["length", "_bucket"])
        .withColumn("nth", F.col("_base") + F.col("_i"))
        .drop("_bucket", "_i", "_base")
    )


def placed(pieces: DataFrame, runs: list[Run]) -> DataFrame:
    """Give every numbered piece its ``sequence_id`` and ``offset``. The runs go to the tasks: their number is bounded
    by the capacity alone."""
    table = np.array([(r.length, r.first, r.per_bin, r.bin, r.offset) for r in runs], dtype=np.int64).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    schema = pa.schema([*PIECES_ARROW, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            at = np.empty(len(nth), dtype=np.int64)
            for v in np.unique(length):
                rows = np.flatnonzero(length == v)
                low, high = np.searchsorted(table[:, 0], [v, v + 1])
                at[rows] = low + np.searchsorted(table[low:high, 1], nth[rows], side="right") - 1
            _, first, per_bin, bin_, offset = table[at].T
            bins, inside = np.divmod(nth - first, per_bin)
            columns = [batch.column(c) for c in PIECES_ARROW.names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(bin_ + bins), pa.array(offset + inside * length)], schema=schema)

    return pieces.select(*PIECES_ARROW.names, "nth").mapInArrow(
        place, PIECES + ", sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, added: bool = False) -> DataFrame:
    """Pack all documents (``doc_id``, ``text``) into sequences of at most ``capacity`` tokens; ``added`` as in ``RunIds``.

    A null or empty text is a document of one end token. Null and repeated ids are packed like any others, repeated rows
    as often as they come, and only ``doc_id`` and ``text`` are read, so other columns may have any name. An empty table
    gives an empty result.
    """
    pieces = written(token_pieces(docs, tokenizer_path, capacity, added=added), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = best_fit_decreasing(histogram, capacity)
    rows = sum(histogram.values())
    return placed(compact(numbered_in_length(pieces, rows), rows), runs)
