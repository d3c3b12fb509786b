"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes of a class; bytes above 127 belong to every class, so no character is ever cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken in slices of about so many bytes.
SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Everything but space, tab, line feed, vertical tab, form feed and carriage return.
UNSPACED = np.ones(256, dtype=bool)
UNSPACED[[9, 10, 11, 12, 13, 32]] = False
#: Digits, a-z, and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse, at least ``n`` of them."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, _INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


@dataclass
class Words:
    """The words of the texts ``first`` to ``last - 1`` of a column."""

    first: int
    last: int
    data: np.ndarray  # the bytes of these texts
    offsets: np.ndarray  # where each text begins in them, and the end of the last
    start: np.ndarray  # of each word
    end: np.ndarray
    text: np.ndarray  # number of its text, from 0
    _sums: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        """How many words each text has."""
        return np.bincount(self.text, minlength=self.last - self.first)

    def bounds(self) -> np.ndarray:
        """Where the words of each text begin among all, and the end of the last."""
        return np.concatenate(([0], np.cumsum(self.counts())))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: differences of a running polynomial, moved to the origin."""
        running, down = self._running()
        return mixed((running[self.end] - running[self.start]) * down[self.start])

    def stems(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash of the first ``size`` bytes) of the words with more bytes than that."""
        running, down = self._running()
        long = self.end - self.start > size
        at = self.start[long]
        return self.text[long], mixed((running[at + size] - running[at]) * down[at])

    def _running(self) -> tuple[np.ndarray, np.ndarray]:
        if self._sums is None:
            up, down = _tables(len(self.data) + 1)
            running = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=running[1:])
            self._sums = running, down
        return self._sums


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column, without a copy; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1] if len(column) else \
        np.zeros(1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8), at


def _lowered(part: np.ndarray, offsets: np.ndarray, kind: np.ndarray, keep: np.ndarray) -> np.ndarray:
    inside = kind[part]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[offsets < len(part)]
    begins[at] = inside[at]
    word = np.cumsum(begins)
    kept = np.zeros(int(word[-1]) + 1, dtype=bool)
    kept[word[keep[part] & inside]] = True
    return np.where(kept[word], part, LOWER[part])


def words_of(
    column: pa.Array, kind: np.ndarray, lower: bool, cut: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
    keep: np.ndarray | None = None,
) -> Iterator[Words]:
    """Slices of a column, each as its words. ``cut`` may cut words further: from the bytes, and the number of the word
    that each byte is in or after, it tells where in a word another one begins. Words with a byte of the class ``keep`` are not
    lower-cased."""
    data, at = texts_of(column)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLICE_BYTES, side="right")) - 1)
        part, offsets = data[at[first]: at[last]], at[first: last + 1] - at[first]
        if lower:
            part = LOWER[part] if keep is None or not keep[part].any() else _lowered(part, offsets, kind, keep)
        inside = np.zeros(len(part) + 2, dtype=np.int8)
        inside[1:-1] = kind[part]
        border = np.zeros(len(part) + 1, dtype=bool)
        border[offsets] = True  # a word ends with its text
        if cut is not None:
            begins = (inside[1:] == 1) & ((inside[:-1] == 0) | border)
            border[:-1] |= cut(part, np.cumsum(begins[:-1]))
        start = np.flatnonzero((inside[1:] == 1) & ((inside[:-1] == 0) | border))
        end = np.flatnonzero((inside[:-1] == 1) & ((inside[1:] == 0) | border))
        text = np.searchsorted(offsets, start, side="right") - 1
        yield Words(first, last, part, offsets, start, end, text)
        first = last
