"""Vectorised word tables over Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. Texts are
handled whole, a few megabytes at a time, so memory does not depend on how many
rows an Arrow batch holds. Hashes are polynomial over fixed random byte codes
(modulo 2**64, then mixed), the same in every task and run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _spans(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of codes[start:end] for every span."""
    up, down = _power(len(codes) + 1)
    total = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


class Texts:
    """Some consecutive rows of a string column: ``raw`` bytes, ``offsets`` of
    the rows, and the words: byte ``starts`` / ``ends``, ``row`` and ``first``
    (index of each row's first word, plus the total)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE):
        self.raw, self.offsets, self.n = raw, offsets, len(offsets) - 1
        space = separators[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[offsets] = True
        before = np.ones(len(raw), dtype=bool)
        before[1:] = space[:-1]
        after = np.ones(len(raw), dtype=bool)
        after[:-1] = space[1:]
        self.space = space
        self.starts = np.flatnonzero(~space & (before | edge[:-1]))
        self.ends = np.flatnonzero(~space & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.row = np.repeat(np.arange(self.n), np.diff(self.first))

    def count(self, mask: np.ndarray) -> np.ndarray:
        """Per row, how many of its bytes are in ``mask``."""
        total = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word."""
        return _spans(_CODES[self.raw], self.starts, self.ends)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _spans(_CODES[self.raw], starts, ends)

    def grams(self, hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every ``k`` consecutive words of one row."""
        return grams(hashes, self.row, k)


def grams(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1:]) if len(row) >= k else np.zeros(0, dtype=np.int64)
    return at, _spans(hashes, at, at + k)


def texts(column: pa.Array | pa.ChunkedArray, lower: bool = False, slice_bytes: int = SLICE_BYTES,
          separators: np.ndarray = SPACE) -> Iterator[tuple[int, Texts]]:
    """(index of the first row, Texts) over a string column, whole rows, about
    ``slice_bytes`` at a time. Null rows count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, where, data = column.buffers()
    if len(column) == 0:
        return
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + slice_bytes, side="right")) - 1
        end = min(max(end, begin + 1), len(column))
        raw = data[offsets[begin]: offsets[end]]
        yield begin, Texts(LOWER[raw] if lower else raw, offsets[begin: end + 1] - offsets[begin], separators)
        begin = end


def per_row(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Keys that are equal only for equal values of the same row."""
    return mix(keys ^ mix(row.astype(np.uint64) + np.uint64(0x1000193)))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the entries whose key occurs at least twice."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = s[1:] == s[:-1]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
