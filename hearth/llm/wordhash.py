"""Vectorised words, word hashes and shingles of an Arrow batch of texts.

A batch is read as one byte buffer: words are maximal runs of bytes that are not
separators, never cross a text's end, and are named by a 64-bit hash of their
bytes.  Equal words get equal names everywhere (in every task, run and table), so
names can be shuffled, grouped and compared instead of strings.  A null text has
no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
#: Bytes of text handled at once, so that the working arrays stay in the CPU cache.
CHUNK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def separators(punctuation: bool = False) -> np.ndarray:
    """256 flags: white space (bytes 32 and 9 to 13) and, if asked, every other
    ASCII byte that is neither a letter nor a digit."""
    out = np.zeros(256, dtype=bool)
    out[[32, 9, 10, 11, 12, 13]] = True
    if punctuation:
        out[:128] |= [not chr(i).isalnum() for i in range(128)]
    return out


def _byte_names(lower: bool) -> np.ndarray:
    names = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
    if lower:
        names[65:91] = names[97:123]
    return names


class _Powers:
    """Powers of the hash base and of its inverse, extended on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=_U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, CHUNK_BYTES * 2)
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, dtype=_U), np.full(m - 1, b, dtype=_U)])) for b in (_BASE, _INV))
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Words of consecutive texts: ``name[bounds[d]:bounds[d + 1]]`` are those of
    text ``d``; ``start`` and ``end`` are byte positions in ``data``."""

    data: np.ndarray
    name: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray
    #: Running sums of the byte names times the powers of the hash base.
    total: np.ndarray
    #: Byte positions of the texts' ends.
    offsets: np.ndarray

    def text_start(self, d: int) -> int:
        """Position of the first byte of text ``d``."""
        return int(self.offsets[d])

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, name) of the first ``size`` bytes of each longer word."""
        at = np.flatnonzero(self.end - self.start > size)
        first = self.start[at]
        down = _POWERS.upto(len(self.total))[1]
        return at, mix((self.total[first + size] - self.total[first]) * down[first] + _U(size) + (_U(1) << _U(32)))

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of all runs of ``k`` words and their bounds; a text of 1 to
        ``k - 1`` words gives one name, that of its whole sequence."""
        n, b = len(self.name), self.bounds
        size = np.diff(b)
        full = np.maximum(size - k + 1, 0)
        out_bounds = np.concatenate([[0], np.cumsum(np.where(size > 0, np.maximum(full, 1), 0))])
        runs = named_runs(self.name, k)
        keep = np.zeros(n + 1, dtype=np.int64)
        np.add.at(keep, b[:-1], full > 0)
        np.add.at(keep, b[:-1] + full, -(full > 0).astype(np.int64))
        out = np.empty(out_bounds[-1], dtype=_U)
        short = np.flatnonzero((size > 0) & (size < k))
        at = np.ones(len(out), dtype=bool)
        at[out_bounds[short]] = False
        out[at] = runs[np.flatnonzero(np.cumsum(keep[:n]) > 0)]
        for d in short:
            out[out_bounds[d]] = named_runs(self.name[b[d]:b[d + 1]], int(size[d]))[0]
        return out, out_bounds


def named_runs(name: np.ndarray, k: int) -> np.ndarray:
    """Name of each run of ``k`` consecutive names (``len(name) - k + 1`` of them)."""
    n = len(name) - k + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    acc = np.zeros(n, dtype=_U)
    for j in range(k):
        acc = acc * _U(0x2545F4914F6CDD1D) + name[j:j + n]
    return mix(acc ^ _U(k))


def chunks(texts: pa.Array, lower: bool, sep: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, Words]]:
    """(first row, Words) of consecutive rows of about ``limit`` bytes together;
    one longer text forms a chunk of its own."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    n = len(texts)
    if n == 0:
        return
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    names, lo = _byte_names(lower), 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, _words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], names, sep)
        lo = hi


def _words(data: np.ndarray, offsets: np.ndarray, names: np.ndarray, sep: np.ndarray) -> Words:
    size = len(data)
    inside = ~sep[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    lo, hi = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]]
    first[lo], last[hi - 1] = inside[lo], inside[hi - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _POWERS.upto(size + 1)
    total = np.zeros(size + 1, dtype=_U)
    np.cumsum(names[data] * up[:size], out=total[1:])
    name = mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))
    return Words(data, name, start, end, np.searchsorted(start, offsets), total, offsets)
