"""Byte n-grams of whole texts as packed integers, sharded by the two bytes before the predicted one.

A key holds, from its high to its low byte, the context from the nearest byte backwards and then the predicted
byte. Sorted keys therefore keep every context of every length in one run, and a shard holds all contexts that
end in its pairs of bytes: it needs nothing from other shards for contexts of two bytes or more. Texts begin in
a context of BREAK bytes and end with one BREAK as their last symbol; no UTF-8 text holds that byte.
"""

from __future__ import annotations

import numpy as np

from clicktide.llm.exchange import merged_counts, mix

BREAK = 0xFF
CONTEXT = 5  # bytes before the predicted one
PAIRS = 8 * (CONTEXT - 1)  # a key without its symbol and farther contexts is the pair of nearest bytes


def keys_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One key per symbol (every byte, then the end) and the texts' numbers of symbols."""
    gap = bytes([BREAK]) * CONTEXT
    data = np.frombuffer(gap + gap.join(texts) + gap[:1], np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    n = len(data) - CONTEXT
    keys = np.zeros(n, np.uint64)
    for back in range(1, CONTEXT + 1):
        keys |= data[CONTEXT - back:CONTEXT - back + n].astype(np.uint64) << np.uint64(8 * (CONTEXT + 1 - back))
    keys |= data[CONTEXT:]
    # Between texts, the symbols after the end are no symbols of any text.
    keep = np.ones(n, bool)
    ends = np.cumsum(lengths + CONTEXT - 1) - (CONTEXT - 1)
    for extra in range(CONTEXT - 1):
        at = ends[:-1] + extra
        keep[at] = False
    return keys[keep], lengths


def shard_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (mix(keys >> np.uint64(PAIRS)) % np.uint64(n)).astype(np.int32)


def counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    keys, _ = keys_of(texts)
    keys.sort()
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1]) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.diff(np.concatenate([starts, [len(keys)]])).astype(np.int64)


def distinct(parts: list[np.ndarray]) -> np.ndarray:
    return merged_counts([(k, np.ones(len(k), np.int64)) for k in parts])[0]


class Symbols:
    """All symbols of consecutive texts by key: the distinct keys in order, how often each occurs, and whose symbols.

    One sort puts equal symbols together, so values of distinct keys are looked up in order and go back by it.
    """

    def __init__(self, texts: list[bytes]) -> None:
        keys, lengths = keys_of(texts)
        order = np.argsort(keys)
        self.lengths = lengths
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)[order]
        keys = keys[order]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1]) if len(keys) else np.empty(0, np.int64)
        self.keys, self.times = keys[starts], np.diff(np.concatenate([starts, [len(keys)]]))

    def sums(self, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sum of the symbols' values of every text; ``values`` are those of the sorted ``keys``, which hold all."""
        own = values[np.searchsorted(keys, self.keys)]
        return np.bincount(self.owner, np.repeat(own, self.times), len(self.lengths))
