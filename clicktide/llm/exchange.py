"""Questions from blocks of documents to sharded tables, and the answers back, by two small shuffles.

Several operators need, for every n-gram, word or window of every document, one number that depends on the
whole corpus. One row for each of them would multiply the corpus; here a block of documents (tens of MB) asks
for its distinct 64-bit keys once, as one packed column per shard, and a shard replies with a packed column in
the same order:

    documents --(_block)--> distinct keys --(shard)--> replies --(_block)--> documents with their numbers

Blocks are dealt by a hash of id and text and hold about ``block_bytes`` of texts and rows, whatever the size of a
source or a group of copies with ids of their own; rows that repeat as a whole, id included, share a block. A key that
every document holds arrives once per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.session import new_work_dir

BLOCK_BYTES = 24 << 20
# What a row counts in a block besides its text.
ROW_BYTES = 64
# Texts are worked on in pieces of about this size inside a task.
PIECE_BYTES = 3 << 20

ASKED = "shard int, block int, keys binary"
REPLIES = "shard int, block int, reply binary"
COUNTED = "shard int, keys binary, counts binary"


def written(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends there and later jobs read it back."""
    spark = df.sparkSession
    path = new_work_dir(spark, purpose)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has at most so many (narrow) rows; left to a shuffle join otherwise."""
    return F.broadcast(df) if df.count() <= rows else df


def blocks_of(docs: DataFrame, keep: dict[str, object], block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """``keep`` columns, the text as bytes (null: empty) and the block of every row; the number of blocks.

    The block follows from the row alone, so a repeated task deals rows alike.
    """
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES).cast("long"))).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        *[c.alias(name) for name, c in keep.items()],
        F.pmod(F.xxhash64(F.col("doc_id"), text), F.lit(n)).cast("int").alias("_block"),
        text.cast("binary").alias("_text"),
    )
    return rows, n


def mix(keys: np.ndarray) -> np.ndarray:
    """64-bit finalizer; spreads packed keys evenly."""
    x = keys.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def by_shard(shards: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """A stable order that puts shards together, and (shard, from, to) in it."""
    order = np.argsort(shards, kind="stable")
    if not len(order):
        return order, []
    ordered = shards[order]
    cuts = np.flatnonzero(np.diff(ordered)) + 1
    starts = np.concatenate([[0], cuts])
    ends = np.concatenate([cuts, [len(ordered)]])
    return order, [(int(ordered[a]), int(a), int(b)) for a, b in zip(starts, ends)]


def planes(values: np.ndarray) -> bytes:
    """All first bytes of the values, then all second ones and so on: like bytes lie together and compress well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def steps(keys: np.ndarray) -> bytes:
    """Sorted keys as the planes of their differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def from_steps(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, "u8"), dtype=np.uint64)


def asked_rows(
    keys: np.ndarray, shards: np.ndarray, block: int, pack: Callable[[np.ndarray], bytes] = np.ndarray.tobytes,
) -> pa.Table:
    """One row per shard with the block's keys for it."""
    order, spans = by_shard(shards)
    keys = keys[order]
    return pa.table({
        "shard": pa.array([s for s, _, _ in spans], pa.int32()),
        "block": pa.array([block] * len(spans), pa.int32()),
        "keys": pa.array([pack(keys[a:b]) for _, a, b in spans], pa.binary()),
    })


def replies_in_order(
    keys: np.ndarray, shards: np.ndarray, replies: pa.Table, dtype: str,
    unpack: Callable[[bytes, str], np.ndarray] = np.frombuffer,
) -> np.ndarray:
    """Replies to ``asked_rows(keys, shards, ...)``, one value per key."""
    out = np.zeros(len(keys), dtype)
    order, spans = by_shard(shards)
    where = {s: (a, b) for s, a, b in spans}
    for shard, reply in zip(replies["shard"].to_pylist(), replies["reply"].to_pylist()):
        if shard in where:
            a, b = where[shard]
            out[order[a:b]] = unpack(reply, dtype)
    return out


def block_number(key: tuple) -> int:
    value = key[0]
    return int(value.as_py() if hasattr(value, "as_py") else value)


def merged_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    keys = np.concatenate([k for k, _ in parts]) if parts else np.empty(0, np.uint64)
    counts = np.concatenate([c for _, c in parts]) if parts else np.empty(0, np.int64)
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
    return keys[starts], np.add.reduceat(counts, starts)


def counted_rows(keys: np.ndarray, counts: np.ndarray, shards: np.ndarray) -> pa.RecordBatch:
    order, spans = by_shard(shards)
    keys, counts = keys[order], counts[order]
    return pa.record_batch({
        "shard": pa.array([s for s, _, _ in spans], pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for _, a, b in spans], pa.binary()),
        "counts": pa.array([counts[a:b].astype(np.int64).tobytes() for _, a, b in spans], pa.binary()),
    })


def counts_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All packed counts of a table, merged."""
    return merged_counts([
        (np.frombuffer(k, np.uint64), np.frombuffer(c, np.int64))
        for k, c in zip(table["keys"].to_pylist(), table["counts"].to_pylist())
    ])


def sharded_counts(
    docs: DataFrame, keys_of: Callable[[pa.RecordBatch], list[tuple[np.ndarray, np.ndarray]]],
    shard_of: Callable[[np.ndarray], np.ndarray], purpose: str,
) -> DataFrame:
    """Count keys over all rows: map tasks combine what they read, shards add it up. One row per shard."""
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            for part in keys_of(batch):
                pending.append(part)
                held += len(part[0])
                if held > 4_000_000:
                    merged = merged_counts(pending)
                    pending, held = [merged], len(merged[0])
                    if held > 2_000_000:
                        yield counted_rows(*merged, shard_of(merged[0]))
                        pending, held = [], 0
        if pending:
            merged = merged_counts(pending)
            yield counted_rows(*merged, shard_of(merged[0]))

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = counts_of(table)
        return pa.table({
            "shard": pa.array([block_number(key)], pa.int32()),
            "keys": pa.array([keys.tobytes()], pa.binary()),
            "counts": pa.array([counts.tobytes()], pa.binary()),
        })

    return written(docs.mapInArrow(combine, COUNTED).groupBy("shard").applyInArrow(add_up, COUNTED), purpose)


def pieces(texts: list, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` in length, one text at least."""
    start = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


class WordHashes(dict):
    """64-bit hash of a word, remembered up to a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

