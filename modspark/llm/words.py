"""Words of a column of texts as numpy arrays, straight from the Arrow buffers.

All separators used by the operators are ASCII, so words can be cut on UTF-8 bytes. A word
is known by a 64-bit sum of its bytes with one random odd factor per position, mixed once
more; a block of texts is handled in slices, so memory follows the longest text and not the
batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 256 << 10
"""Texts are taken together up to this many bytes; one longer text is a slice of its own."""

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def factors(n: int, salt: int = 0) -> np.ndarray:
    """n odd pseudo-random 64-bit numbers; a longer list starts with the shorter one."""
    with np.errstate(over="ignore"):
        seed = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 40)
        return mix(seed * _STEP) | np.uint64(1)


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def separator_table(ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


LOWER = lower_table()
BLANK = separator_table(((0x20, 0x20), (0x09, 0x0D)))


@dataclass
class Words:
    """Words of several texts: their bytes, bounds, and the text each belongs to."""

    rows: slice
    data: np.ndarray
    is_word: np.ndarray
    """For every byte whether it belongs to a word."""
    bounds: np.ndarray
    """Byte offsets of the texts in data, one more than texts."""
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    """Index of each text's first word, one more than texts."""

    def hashes(self) -> np.ndarray:
        """A 64-bit number for every word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        begins = np.zeros(len(length), np.int64)
        np.cumsum(length[:-1], out=begins[1:])
        inside = np.flatnonzero(self.is_word)
        values = self.data[inside] + np.uint64(1)
        inside -= np.repeat(self.start, length)
        with np.errstate(over="ignore"):
            values *= factors(int(length.max()))[inside]
            return mix(np.add.reduceat(values, begins) + length.astype(np.uint64))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def byte_column(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null counts as an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    return offsets, np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[slice]:
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        to = min(max(to, at + 1), n)
        yield slice(at, to)
        at = to


def word_slices(
    texts: pa.Array, separators: np.ndarray = BLANK, lower: bool = True, most: int = SLICE_BYTES
) -> Iterator[Words]:
    """Cut the texts into words, slice by slice; words are maximal runs of other bytes."""
    offsets, raw = byte_column(texts)
    for rows in slices(offsets, most):
        bounds = offsets[rows.start : rows.stop + 1] - offsets[rows.start]
        data = raw[offsets[rows.start] : offsets[rows.stop]]
        if lower:
            data = LOWER[data]
        is_word = ~separators[data]
        begins = is_word.copy()
        begins[1:] &= ~is_word[:-1]
        heads = bounds[:-1][np.diff(bounds) > 0]
        begins[heads] = is_word[heads]
        ends = is_word.copy()
        ends[:-1] &= ~is_word[1:]
        tails = bounds[1:][np.diff(bounds) > 0] - 1
        ends[tails] = is_word[tails]
        start = np.flatnonzero(begins)
        end = np.flatnonzero(ends) + 1
        yield Words(rows, data, is_word, bounds, start, end, np.searchsorted(start, bounds))


def run_hashes(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words inside one text, and each text's first run.

    A text with fewer than k words, but not none, has one run: all its words.
    """
    n_words = np.diff(first)
    n_runs = np.where(n_words >= k, n_words - k + 1, (n_words > 0).astype(np.int64))
    at = np.zeros(len(n_words) + 1, np.int64)
    np.cumsum(n_runs, out=at[1:])
    total = int(at[-1])
    if not total:
        return np.zeros(0, np.uint64), at
    place = np.arange(total, dtype=np.int64) - np.repeat(at[:-1], n_runs)
    head = np.repeat(first[:-1], n_runs) + place
    room = np.repeat(np.minimum(n_words, k), n_runs)
    by = factors(k, salt=7)
    value = np.zeros(total, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            inside = i < room
            word = words[np.minimum(head + i, len(words) - 1)]
            value += np.where(inside, word * by[i], np.uint64(0))
        return mix(value + room.astype(np.uint64)), at
