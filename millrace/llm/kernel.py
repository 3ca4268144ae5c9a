"""Vectorised word kernels over Arrow batches.

A batch of texts is treated as one byte buffer: word edges, word hashes and
shingle hashes come from whole-array numpy operations, so the cost per byte is
a few nanoseconds and no Python object is made per word. Words are the runs
``[^\\x20\\x09-\\x0D]+``; those separators are single bytes in UTF-8, so bytes
and code points give the same words. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at once; longer single texts are handled alone.
CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK + 1)
            self.up = np.full(size, _BASE)
            self.down = np.full(size, _INVERSE)
            self.up[0] = self.down[0] = U64(1)
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def text_chunks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of about CHUNK bytes.

    Yields (first row, end row, bytes, offsets); offsets has one entry more
    than the run has rows and starts at 0.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + CHUNK, side="right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_edges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each row.

    The last array has one entry more than there are rows, like offsets.
    """
    n = len(data)
    word = np.zeros(n + 1, bool)
    np.logical_not(_SPACE[data], out=word[:n])
    before = np.zeros(n + 1, bool)
    before[1:] = word[:n]
    inner = offsets[(offsets > 0) & (offsets < n)]
    cut = np.zeros(n + 1, bool)
    cut[inner] = True
    starts = np.flatnonzero(word & (~before | cut))
    ends = np.flatnonzero(before & (~word | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_sums(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a byte polynomial, and the factors that move a run's sum to its start."""
    up, down = _powers.get(len(letters) + 1)
    sums = np.zeros(len(letters) + 1, U64)
    terms = letters.astype(U64)
    terms += U64(1)
    terms *= up[: len(letters)]
    np.cumsum(terms, out=sums[1:])
    return sums, down


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, finalised."""
    sums, down = prefix_sums(_LOWER[data] if lower else data)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def sequence_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words, across row borders too."""
    if len(words) < k:
        return np.zeros(0, U64)
    out = words[: len(words) - k + 1].copy()
    for i in range(1, k):
        out *= U64(0xD6E8FEB86659FD93)
        out += words[i : len(words) - k + 1 + i]
    return mix(out)


def shingle_sets(words: np.ndarray, k: int) -> np.ndarray:
    """The sorted distinct k-word shingle hashes of one row's words.

    With fewer than k words the whole row is one shingle; without words the
    set is empty.
    """
    if not len(words):
        return np.zeros(0, U64)
    if len(words) < k:
        return sequence_hashes(words, len(words)) ^ U64(len(words))
    return np.unique(sequence_hashes(words, k))


_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def fold(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased and all ASCII but letters and digits as spaces: words without punctuation."""
    return _FOLD[data]
