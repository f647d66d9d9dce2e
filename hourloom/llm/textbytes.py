"""Vectorised views of Arrow text: words, hashes and counts per document, a few megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21
LEAST_POWERS = (1 << 19) + 1
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def mixed(x: np.ndarray, copy: bool = True) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit. Without ``copy`` an array of unsigned 64-bit numbers is changed itself."""
    x = x.astype(np.uint64, copy=copy)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))


@lru_cache(maxsize=1)
def _powers_of(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _U(_BASE))
    down = np.full(size, _U(pow(_BASE, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = LEAST_POWERS
    while size < n:
        size *= 2
    return _powers_of(size)


def per_document(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Number of set flags between neighbouring edges."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


@dataclass
class TextSlice:
    """Consecutive documents of one Arrow batch: their rows, UTF-8 bytes and edges in them. Null texts are empty."""

    first: int
    data: np.ndarray
    edges: np.ndarray

    def __len__(self) -> int:
        return len(self.edges) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.edges[i] : self.edges[i + 1]].tobytes()

    def prefix_codes(self, data: np.ndarray) -> np.ndarray:
        """Running sums of byte codes times powers: the hash of any range is a difference."""
        sums = np.zeros(len(data) + 1, np.uint64)
        own = sums[1:]  # made in place: a block has many bytes
        np.take(_BYTE_CODES, data, out=own, mode="clip")
        own *= _powers(len(data) + 1)[0][: len(data)]
        np.cumsum(own, out=own)
        return sums

    @staticmethod
    def range_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((sums[end] - sums[begin]) * _powers(len(sums))[1][begin])

    @staticmethod
    def spread_hashes(sums: np.ndarray, width: int, first: int = 0, end: int | None = None) -> np.ndarray:
        """The hashes of all ranges of ``width`` bytes that begin from ``first`` up to ``end``, as ``range_hashes`` has them."""
        n = max(first, len(sums) - width if end is None else end)
        found = sums[first + width : n + width] - sums[first:n]
        found *= _powers(len(sums))[1][first:n]
        return mixed(found, copy=False)

    def white(self) -> np.ndarray:
        return _WHITE[self.data]

    def word_ranges(self, white: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of every run without white space; documents never share a word."""
        n = len(self.data)
        edge = np.zeros(n + 1, bool)
        edge[self.edges] = True
        solid = ~white
        before = np.concatenate([[False], solid[:-1]]) if n else solid
        after = np.concatenate([solid[1:], [False]]) if n else solid
        begins = np.flatnonzero(solid & (~before | edge[:-1]))
        ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
        return begins, ends

    def words(self, lower: bool) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word, and the edges of the documents among the words."""
        begins, ends = self.word_ranges(self.white())
        sums = self.prefix_codes(_LOWER[self.data] if lower else self.data)
        return self.range_hashes(sums, begins, ends), np.searchsorted(begins, self.edges)


def windows(hashes: np.ndarray, edges: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every run of ``width`` words inside one document."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    end = np.repeat(edges[1:], np.diff(edges))
    start = np.flatnonzero(np.arange(n) + width <= end[:n])
    out = np.zeros(len(start), np.uint64)
    for k in range(width):
        out = out * _U(_BASE) + hashes[start + k]
    return mixed(out), start


def owners(edges: np.ndarray) -> np.ndarray:
    """The document each element belongs to."""
    return np.repeat(np.arange(len(edges) - 1), np.diff(edges))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[TextSlice]:
    """Cut a text column into slices of about ``limit`` bytes; a longer document is a slice of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, values = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.empty(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + limit, side="right")) - 1)
        yield TextSlice(at, data[edges[at] : edges[to]], edges[at : to + 1] - edges[at])
        at = to
