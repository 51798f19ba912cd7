"""Vectorised passes over the UTF-8 bytes of an Arrow column of texts.

Texts are handled in slices of bounded size, so that memory doesn't depend on the batch. A very long text is hashed in pieces
cut between words; the hashes and places of its words, 24 bytes a word, are held together. Null counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are handled at once.
PIECE = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every bit depends on every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A letter's value for hashing, A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
VALUE = mix(LOWER.astype(np.uint64) + np.uint64(1))
#: Bytes of words: digits, letters, everything that isn't ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = WORD[128:] = True


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and the n + 1 offsets of its texts in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    first = offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[first : offsets[-1]], offsets - first


def slices(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or of one longer text."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, to
        at = to


class WordHasher:
    """64-bit hashes of the words of texts: runs of ``WORD`` bytes, A-Z lowered."""

    def __init__(self) -> None:
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(int(_BASE), n), _powers(_inverse(int(_BASE)), n)

    def _hashed(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n = len(data)
        if n > len(self.up):
            self.grow(max(n, PIECE + 1))
        inside = WORD[data]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        if len(cuts):
            starts[cuts] = inside[cuts]
            ends[cuts - 1] = inside[cuts - 1]
        begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        with np.errstate(over="ignore"):
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum(VALUE[data] * self.up[:n], out=sums[1:])
            return mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64)), begin, end

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, begin and end (in ``data``) of each word, and the n + 1 offsets of the texts in the words."""
        if len(offsets) == 2 and len(data) > PIECE:
            parts, at = [], 0
            while at < len(data):
                to = min(len(data), at + PIECE)
                if to < len(data):
                    gap = np.flatnonzero(~WORD[data[at:to]][::-1])
                    if len(gap):
                        to -= int(gap[0])
                    else:
                        gap = np.flatnonzero(~WORD[data[to:]])
                        to = to + int(gap[0]) if len(gap) else len(data)
                h, b, e = self._hashed(data[at:to], np.empty(0, np.int64))
                parts.append((h, b + at, e + at))
                at = to
            h, b, e = (np.concatenate(x) for x in zip(*parts, strict=True))
            return h, b, e, np.array([0, len(h)])
        cuts = offsets[1:-1]
        h, b, e = self._hashed(data, cuts[(cuts > 0) & (cuts < len(data))])
        return h, b, e, np.searchsorted(b, offsets, "left")


_ROUND = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words of one text; of the whole text where it has fewer words, but some."""
    m = len(hashes)
    k = min(n, m)
    if not k:
        return hashes[:0]
    with np.errstate(over="ignore"):
        out = np.full(m - k + 1, k, np.uint64)
        for i in range(k):
            out = mix(out * _ROUND[i % 5] + hashes[i : m - k + 1 + i])
    return out
