"""Words of whole texts as numpy arrays of 64-bit hashes.

A task receives its rows as Arrow batches with the text as binary (UTF-8). The
helpers below find the words of all texts of a slice of a batch at once, straight
on the Arrow buffers: no Python object per word. Slices are bounded in bytes
(``SLICE_BYTES``), so a task's memory doesn't depend on the batch size; only a
single longer text makes a larger slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

#: Bytes of words: anything but space and \x09-\x0D (any byte of a non-ASCII letter counts).
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words: digits, a-z and every byte of a non-ASCII character.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public SplitMix64 constants)."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weights(n: int, salt: int = 0) -> np.ndarray:
    """n pseudorandom odd 64-bit weights, the same in every process."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * _GOLDEN) | np.uint64(1)


@dataclass
class Words:
    """The words of some texts: ``data`` are all lower-cased bytes, word w is
    ``data[start[w]:end[w]]``, text t has the words ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, word: int) -> bytes:
        return self.data[self.start[word]:self.end[word]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: a weighted sum of its bytes, finalised with its length."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        length = self.end - self.start
        # Bytes of words only, back to back: word w starts at at[w].
        at = np.concatenate(([0], np.cumsum(length)))
        total = int(at[-1])
        offset = np.repeat(self.start - at[:-1], length)
        place = np.arange(total, dtype=np.int64)
        own = self.data[place + offset].astype(np.uint64)
        place -= np.repeat(at[:-1], length)
        with np.errstate(over="ignore"):
            own += np.uint64(1)
            own *= weights(int(length.max()))[place]
            return mix64(np.add.reduceat(own, at[:-1]) + length.astype(np.uint64) * _GOLDEN)


def binary_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a binary or string array; a null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or offsets.size == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return every[ends[0]:ends[-1]], ends - ends[0]


def words_of(column: pa.Array, is_word: np.ndarray) -> Words:
    """The words of each text: maximal runs of bytes in ``is_word`` after A-Z are
    lower-cased. Words don't cross texts."""
    raw, ends = binary_buffers(column)
    data = LOWER[raw]
    inside = is_word[data]
    if not len(data):
        return Words(data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(ends), np.int64))
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    begin = ends[:-1][(ends[:-1] < ends[1:])]  # of texts that aren't empty
    starts[begin] = inside[begin]
    last = begin[1:] - 1
    stops[last] = inside[last]
    start, end = np.flatnonzero(starts), np.flatnonzero(stops) + 1
    return Words(data, start, end, np.searchsorted(start, ends))


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        _, ends = binary_buffers(column)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
