"""64-bit hashes of all words of a piece of text at once.

Words are runs of bytes other than ASCII white space. A word's hash is a polynomial in its bytes' random codes, taken
from prefix sums, and mixed with its length; equal words have equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np

from clicktide.llm.exchange import mix

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
# Bytes whose prefix sums are taken at once; a longer word is a stretch of its own.
STRETCH = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_tables: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers; kept in the worker and made longer when needed."""
    name = str(base)
    if name not in _tables or len(_tables[name]) < n:
        out = np.full(max(n, STRETCH + 1), base, np.uint64)
        out[0] = 1
        _tables[name] = np.cumprod(out, dtype=np.uint64)
    return _tables[name][:n]


def words_in(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and byte behind every word of ``data``, which ends in white space."""
    space = np.concatenate([[True], _SPACE[data]])
    edges = np.flatnonzero(space[1:] != space[:-1])
    return edges[::2], edges[1::2]


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def hashes_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, low + STRETCH, "right")))
        n = int(ends[last - 1]) - low
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data[low:low + n]] * powers(BASE, n), out=sums[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((sums[b] - sums[a]) * powers(INVERSE, n)[a] + (b - a).astype(np.uint64))
        first = last
    return out
