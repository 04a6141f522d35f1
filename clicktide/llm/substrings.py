"""Substring dedup: words covered by a window that occurs anywhere else, found by difference-cover anchors.

COVER is a difference cover modulo PERIOD: for any two positions i and j some shift k < PERIOD brings both i + k and
j + k onto cover positions. Two equal windows of WINDOW words therefore share an anchor, an aligned sub-window of
``WINDOW - PERIOD + 1`` words at a cover position in both. So it is enough to

1. hash anchors at cover positions only (5 of 21) and ask which occur more than once,
2. extend around repeated anchors to the full windows that hold them, hash these and ask again.

A window repeats exactly if its hash is asked for more than once in step 2; copies of a window are all extended, so
no pair of documents is ever compared and no group of copies is gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.exchange import (
    REPLIES, block_number, blocks_of, by_shard, merged_counts, mix, pieces, replies_in_order, written,
)
from clicktide.llm.wordhash import BASE, INVERSE, hashes_of, powers, words_in

# Smaller blocks than other operators': the last step holds a block's texts, as they were and as they are kept.
BLOCK_BYTES = 8 << 20
WINDOW = 35
PERIOD = 21
COVER = (0, 1, 6, 8, 18)
ASKED_TWICE = "shard int, block int, keys binary, often binary"


class Words:
    """Words of consecutive texts in one array, with hashes of any windows of them."""

    def __init__(self, texts: list[bytes]) -> None:
        self.data = b"\n".join([*texts, b""])
        data = np.frombuffer(self.data, np.uint8)
        self.begins, self.ends = words_in(data)  # bytes
        bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.starts = np.searchsorted(self.begins, bounds)
        self.lengths = np.diff(self.starts)
        self.starts = self.starts[:-1]
        n = len(self.begins)
        owner = np.repeat(np.arange(len(texts)), self.lengths)
        self.position = np.arange(n) - self.starts[owner]
        self.room = self.lengths[owner] - self.position  # words from here to the end of the text
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes_of(data, self.begins, self.ends) * powers(BASE, n), out=self.sums[1:])

    def __len__(self) -> int:
        return len(self.begins)

    def kept(self, text: int, gone: np.ndarray) -> bytes:
        """A text's words but for those marked, joined by one space."""
        own = slice(self.starts[text], self.starts[text] + self.lengths[text])
        stays = ~gone[own]
        return b" ".join(
            self.data[a:b] for a, b in zip(self.begins[own][stays].tolist(), self.ends[own][stays].tolist()))

    def windows(self, at: np.ndarray, width: int) -> np.ndarray:
        return mix((self.sums[at + width] - self.sums[at]) * powers(INVERSE, len(self) + 1)[at])

    def anchors(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions with room for an anchor, in texts with room for a window; the anchors' hashes."""
        width = window - PERIOD + 1
        on_cover = np.isin(np.arange(PERIOD), COVER)[self.position % PERIOD]
        at = np.flatnonzero(on_cover & (self.room >= width) & (self.position + self.room >= window))
        return at, self.windows(at, width)

    def around(self, anchors: np.ndarray, window: int) -> np.ndarray:
        """Starts of the windows that hold one of the anchors (at their first PERIOD positions)."""
        n = len(self)
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, anchors - np.minimum(PERIOD - 1, self.position[anchors]), 1)
        np.add.at(edge, anchors + 1, -1)
        return np.flatnonzero((np.cumsum(edge[:n]) > 0) & (self.room >= window))

    def covered(self, windows: np.ndarray, window: int) -> np.ndarray:
        n = len(self)
        edge = np.zeros(n + 1, np.int64)
        edge[windows] += 1
        edge[windows + window] -= 1
        return np.cumsum(edge[:n]) > 0


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and whether each occurs more than once."""
    keys, counts = merged_counts([(k, np.ones(len(k), np.int64)) for k in parts])
    return keys, counts > 1


def _asked(keys: np.ndarray, often: np.ndarray, shards: np.ndarray, block: int) -> pa.Table:
    order, spans = by_shard(shards)
    keys, often = keys[order], often[order]
    return pa.table({
        "shard": pa.array([s for s, _, _ in spans], pa.int32()),
        "block": pa.array([block] * len(spans), pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for _, a, b in spans], pa.binary()),
        "often": pa.array([np.packbits(often[a:b]).tobytes() for _, a, b in spans], pa.binary()),
    })


def _answer(key: tuple, asked: pa.Table) -> pa.Table:
    """For every key, whether it occurs more than once anywhere."""
    blobs = [np.frombuffer(k, np.uint64) for k in asked["keys"].to_pylist()]
    often = [np.unpackbits(np.frombuffer(o, np.uint8), count=len(k)) for o, k in zip(asked["often"].to_pylist(), blobs)]
    keys, counts = merged_counts([(k, 1 + o.astype(np.int64)) for k, o in zip(blobs, often)])
    return pa.table({
        "shard": asked["shard"], "block": asked["block"],
        "reply": pa.array(
            [(counts[np.searchsorted(keys, b)] > 1).astype(np.uint8).tobytes() for b in blobs], pa.binary()),
    })


def _shards(keys: np.ndarray, n: int, step: int) -> np.ndarray:
    return ((keys >> np.uint64(20)) % np.uint64(n)).astype(np.int32) + step * n


def _asker_of_anchors(n_shards: int, window: int) -> Callable:
    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        texts = rows["_text"].to_pylist()
        keys, often = _distinct([Words(texts[a:b]).anchors(window)[1] for a, b in pieces(texts)])
        return _asked(keys, often, _shards(keys, n_shards, 0), block_number(key))

    return ask


class _Block:
    """A block of texts, in pieces, with the repeated windows' candidates by the replies about anchors."""

    def __init__(self, rows: pa.Table, replies: pa.Table, n_shards: int, window: int) -> None:
        self.texts = rows["_text"].to_pylist()
        self.pieces = [(a, Words(self.texts[a:b])) for a, b in pieces(self.texts)]
        found = [words.anchors(window) for _, words in self.pieces]
        anchors, _ = _distinct([keys for _, keys in found])
        repeated = replies_in_order(anchors, _shards(anchors, n_shards, 0), replies, "u1") > 0
        # Per piece: candidate starts and their hashes.
        self.candidates = []
        for (_, words), (at, keys) in zip(self.pieces, found):
            starts = words.around(at[repeated[np.searchsorted(anchors, keys)]], window)
            self.candidates.append((starts, words.windows(starts, window)))
        self.keys, self.often = _distinct([keys for _, keys in self.candidates])


def _asker_of_windows(n_shards: int, window: int) -> Callable:
    def ask(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(rows, replies, n_shards, window)
        return _asked(block.keys, block.often, _shards(block.keys, n_shards, 1), block_number(key))

    return ask


def _remover(n_shards: int, window: int, names: list[str], with_text: bool) -> Callable:
    def remove(rows: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(rows, replies, n_shards, window)
        repeated = replies_in_order(block.keys, _shards(block.keys, n_shards, 1), replies, "u1") > 0
        n_words, n_removed, digests, kept_texts = [], [], [], []
        while block.pieces:
            first, words = block.pieces.pop(0)
            starts, hashed = block.candidates.pop(0)
            gone = words.covered(starts[repeated[np.searchsorted(block.keys, hashed)]], window)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[np.append(words.starts, len(words))])
            n_words += words.lengths.tolist()
            n_removed += removed.tolist()
            for i, cut in enumerate(removed.tolist()):
                text = block.texts[first + i]
                joined = words.kept(i, gone) if cut else b" ".join(text.split())
                digests.append(hashlib.sha256(joined).hexdigest())
                if with_text:
                    kept_texts.append(joined if cut else text)
        columns = {name: rows[name] for name in names}
        columns |= {"n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                    "kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            # Text without whole words is still valid UTF-8: words end at ASCII white space.
            columns["kept_text"] = pa.array(kept_texts, pa.binary()).cast(pa.string())
        return pa.table(columns)

    return remove


def remove_repeats(
    docs: DataFrame, keep: dict[str, object] | None = None, window: int = WINDOW, with_text: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Remove every word covered by a window of ``window`` words (PERIOD + 4 at least) that starts anywhere else.

    Words are runs of bytes other than ASCII white space, unchanged; windows lie in one text and are judged on the
    input. Returns the ``keep`` columns (doc_id), n_words, n_removed, kept_sha256 (of the kept words joined by one
    space) and, if asked for, ``kept_text``: those, or the text as it was if nothing is removed. Null and empty texts
    have no words. Repeated
    rows are copies of each other like any others, so all their windows go. Other columns are ignored; an empty
    table gives an empty result.
    """
    if window < PERIOD + 4:
        raise ValueError(f"a window has {PERIOD + 4} words at least")
    keep = keep or {"doc_id": F.col("doc_id")}
    rows, n = blocks_of(docs, keep, block_bytes)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(keep)])
    asked = rows.groupBy("_block").applyInArrow(_asker_of_anchors(n, window), ASKED_TWICE)
    anchors = written(asked.groupBy("shard").applyInArrow(_answer, REPLIES), "anchors")
    asked = rows.groupBy("_block").cogroup(anchors.groupBy("block")).applyInArrow(
        _asker_of_windows(n, window), ASKED_TWICE)
    replies = anchors.unionByName(asked.groupBy("shard").applyInArrow(_answer, REPLIES))
    text = ", kept_text string" if with_text else ""
    return rows.groupBy("_block").cogroup(replies.groupBy("block")).applyInArrow(
        _remover(n, window, list(keep), with_text),
        f"{kinds}, n_words long, n_removed long, kept_sha256 string{text}")
