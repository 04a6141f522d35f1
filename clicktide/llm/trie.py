"""Prefix trie of rebuilt conversations, in shards of neighbouring paths with a minimal perfect hash each.

A node is a sequence of first turns and is named by a chained 128-bit digest, so a conversation's path is the row of
its prefixes' digests. Paths are unique (equal conversations are counted together first) and are dealt by range in
their order: however many conversations share first turns, a shard holds a bounded stretch of neighbouring paths.
Within a shard

* the distinct prefix digests are enumerated and get the slots 0 .. n-1 of a minimal perfect hash, whose keys are
  compared with the slots' keys again, so no two digests ever share one;
* counts of ending conversations are scattered into flat arrays by slot;
* from the deepest level up, every slot adds its sums to its parent's slot.

Nodes on a shard's first and last path may go on in a neighbour. These two paths, with what the shard's own nodes
below them add up to, are the input of the next level, which works alike on far fewer paths, until one shard is left.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.exchange import mix, small, written

# Nodes of paths (repeats included) in a shard.
SHARD_NODES = 400_000
# Nodes on shard borders that are broadcast (two longs and a digest each); joined by shuffle beyond.
BROADCAST_BORDERS = 500_000
# A shard has that many paths at least, so that its two border paths are always fewer.
LEAST_PATHS = 16
IDS_PER_CHUNK = 50_000
DIGEST_BYTES = 16
ROOT = bytes(DIGEST_BYTES)
# Slots tried per key in each round of the perfect hash.
ROOM = 2

CHAINED = "conv_id bigint, path binary, chars binary"
# Of every node of a path: code points of its last text; of conversations ending there: number and least id (LEAST if
# none); and of nodes below it that are not on the path: saved tokens, childless nodes, children of the node itself.
VALUES = ("chars", "ended", "least", "saved", "leaves", "children")
NONE = np.iinfo(np.int64).max
SUMMED = (
    "digest binary, parent binary, depth bigint, conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, parent_conv_id bigint, path binary, " + ", ".join(f"{v} binary" for v in VALUES))


# ---- rebuilding ------------------------------------------------------------------------------------


def shared_turns(conv_id: Column) -> Column:
    """Number of first turns that a conversation takes over from the first of its hundred."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def own_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, base, shared, turn, digest, chars) of every turn, without its text."""
    text = F.coalesce("text", F.lit(""))
    role = F.coalesce("role", F.lit(""))
    # The role's length keeps role and text apart.
    spelled = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    conv_id = F.col("conv_id").cast("bigint")
    return conversations.where(F.col("conv_id").isNotNull()).select(
        conv_id.alias("conv_id"), (conv_id - conv_id % 100).alias("base"), shared_turns(conv_id).alias("shared"),
        F.col("turn").cast("bigint").alias("turn"),
        F.substring(F.unhex(F.sha2(spelled, 256)), 1, DIGEST_BYTES).alias("digest"),
        F.length(text).cast("bigint").alias("chars"))


def _chain(digests: list[bytes]) -> bytes:
    """Digests of a conversation's prefixes, the textless one first."""
    out, last = [ROOT], ROOT
    for digest in digests:
        last = hashlib.blake2b(last + digest, digest_size=DIGEST_BYTES).digest()
        out.append(last)
    return b"".join(out)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns in order of (base, whether not the base, conv_id, turn) -> one row per rebuilt conversation."""
    base, first = None, []  # the base conversation's first five turns
    current, shared, turns = None, 0, []
    done: list[tuple[int, bytes, bytes]] = []
    held = 0

    def close() -> int:
        own = turns if current == base else first[:shared] + turns[shared:]
        chars = np.array([0, *(c for _, c in own)], "<i8")
        done.append((current, _chain([d for d, _ in own]), chars.tobytes()))
        return len(chars)

    def flush() -> pa.RecordBatch:
        ids, paths, chars = zip(*done)
        return pa.record_batch({
            "conv_id": pa.array(ids, pa.int64()), "path": pa.array(paths, pa.binary()), "chars": pa.array(chars, pa.binary())})

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("conv_id", "base", "shared", "digest", "chars"))
        for conv_id, own_base, own_shared, digest, n_chars in zip(*columns):
            if conv_id != current:
                if current is not None:
                    held += close()
                    if held >= SHARD_NODES:
                        yield flush()
                        done, held = [], 0
                if own_base != base:
                    base, first = own_base, []
                current, shared, turns = conv_id, own_shared, []
            turns.append((digest, n_chars))
            if conv_id == base and len(first) < 5:
                first.append((digest, n_chars))
    if current is not None:
        close()
        yield flush()


def rebuilt(conversations: DataFrame, n: int) -> DataFrame:
    """One row per conversation: conv_id, the digests of its prefixes and the code points of their last texts.

    The hundred conversations of a base lie in one task, the base first, and are read one after the other. Ties of
    turn go by the turn's digest.
    """
    turns = own_turns(conversations)
    in_order = turns.repartition(n, "base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "digest")
    return in_order.select("conv_id", "base", "shared", "digest", "chars").mapInArrow(_rebuild, CHAINED)


# ---- one shard -------------------------------------------------------------------------------------


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: every round places the keys that are alone in their place, and a
    key's slot is the number of taken places before its own."""

    def __init__(self, low: np.ndarray, high: np.ndarray) -> None:
        self.rounds: list[tuple[int, np.ndarray]] = []  # places of a round, and which are taken
        waiting = np.arange(len(low))
        while len(waiting):
            n = ROOM * len(waiting)
            at = self._place(low[waiting], high[waiting], len(self.rounds), n)
            alone = np.bincount(at, minlength=n) == 1
            self.rounds.append((n, alone))
            waiting = waiting[~alone[at]]
        self.before = [np.cumsum(alone) - alone for _, alone in self.rounds]
        self.offsets = np.concatenate([[0], np.cumsum([alone.sum() for _, alone in self.rounds])]).astype(np.int64)
        slots = self.slots(low, high)
        self.low, self.high = np.empty_like(low), np.empty_like(high)
        self.low[slots], self.high[slots] = low, high
        self.verify(low, high, slots)

    @staticmethod
    def _place(low: np.ndarray, high: np.ndarray, seed: int, n: int) -> np.ndarray:
        return (mix(low ^ mix(high + np.uint64(seed))) % np.uint64(n)).astype(np.int64)

    def slots(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        out = np.full(len(low), -1, np.int64)
        waiting = np.arange(len(low))
        for seed, (n, alone) in enumerate(self.rounds):
            at = self._place(low[waiting], high[waiting], seed, n)
            hit = alone[at]
            out[waiting[hit]] = self.offsets[seed] + self.before[seed][at[hit]]
            waiting = waiting[~hit]
        return out

    def verify(self, low: np.ndarray, high: np.ndarray, slots: np.ndarray) -> None:
        if (slots < 0).any() or (self.low[slots] != low).any() or (self.high[slots] != high).any():
            raise ValueError("a digest has no slot of its own")


class _Paths:
    """Rows of a shard, flat: one entry per node of every path."""

    def __init__(self, rows: list[dict]) -> None:
        self.rows = rows
        self.lengths = np.array([len(r["path"]) // DIGEST_BYTES for r in rows], np.int64)
        starts = np.cumsum(self.lengths) - self.lengths
        total = int(self.lengths.sum())
        self.depth = np.arange(total) - np.repeat(starts, self.lengths)
        self.last = starts + self.lengths - 1
        keys = np.frombuffer(b"".join(r["path"] for r in rows), "<u8").reshape(-1, 2)
        self.keys, self.low, self.high = keys, np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1])
        self.starts = starts
        # The textless node is its own parent.
        self.parent = np.where(self.depth > 0, np.arange(total) - 1, np.arange(total))
        self.values = {}
        for name in VALUES:
            if name in rows[0] and rows[0][name] is not None:
                self.values[name] = np.frombuffer(b"".join(r[name] for r in rows), "<i8")
            else:
                self.values[name] = np.full(total, NONE if name == "least" else 0, np.int64)
        if rows[0].get("n_convs") is not None:  # whole conversations count where they end
            self.values["ended"][self.last] = [r["n_convs"] for r in rows]
            self.values["least"][self.last] = [r["conv_id"] for r in rows]

    def digests(self, entries: np.ndarray) -> pa.Array:
        data = pa.py_buffer(self.keys[entries].tobytes())
        return pa.Array.from_buffers(pa.binary(DIGEST_BYTES), len(entries), [None, data]).cast(pa.binary())


def sum_shard(rows: list[dict], whole: bool) -> pa.Table:
    """Nodes of a shard of neighbouring paths with their sums, and unless it is the ``whole`` the two border paths."""
    paths = _Paths(rows)
    order = np.lexsort((paths.low, paths.high))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(paths.low[order]) != 0) | (np.diff(paths.high[order]) != 0)
    distinct = order[new]
    table = PerfectHash(paths.low[distinct], paths.high[distinct])
    slot = table.slots(paths.low, paths.high)
    table.verify(paths.low, paths.high, slot)
    n = len(distinct)
    # Flat arrays by slot.
    node = np.empty(n, np.int64)  # an entry that shows the node
    node[slot[distinct]] = distinct
    parent = slot[paths.parent[node]]
    depth = paths.depth[node]
    chars = paths.values["chars"][node]
    if (parent[slot] != slot[paths.parent]).any() or (depth[slot] != paths.depth).any() or (
            chars[slot] != paths.values["chars"]).any():
        raise ValueError("two different prefixes have one digest")

    def scattered(name: str) -> np.ndarray:
        out = np.zeros(n, np.int64)
        np.add.at(out, slot, paths.values[name])
        return out

    convs, saved, leaves, children = map(scattered, ("ended", "saved", "leaves", "children"))
    least = np.full(n, NONE, np.int64)
    np.minimum.at(least, slot, paths.values["least"])
    border = np.zeros(n, bool)
    if not whole:
        for row in (0, len(rows) - 1):
            border[slot[paths.starts[row]:paths.last[row] + 1]] = True
    np.add.at(children, parent[(depth > 0) & ~border], 1)

    by_depth = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(-depth[by_depth])) + 1
    for level in np.split(by_depth, cuts):
        inner = level[~border[level]]
        leaves[inner] += children[inner] == 0
        saved[inner] += (convs[inner] - 1) * chars[inner]
        up = inner[depth[inner] > 0]
        np.add.at(convs, parent[up], convs[up])
        np.add.at(leaves, parent[up], leaves[up])
        np.add.at(saved, parent[up], saved[up])
        np.minimum.at(least, parent[up], least[up])

    own = np.flatnonzero(~border)
    above = paths.digests(paths.parent[node[own]])
    known = (depth[own] > 0) & ~border[parent[own]]
    columns = {
        "digest": paths.digests(node[own]), "parent": above,
        "depth": pa.array(depth[own]), "conv_id": pa.array(least[own]), "n_convs": pa.array(convs[own]),
        "n_children": pa.array(children[own]), "n_leaves": pa.array(leaves[own]), "saved_tokens": pa.array(saved[own]),
        "parent_conv_id": pa.array(least[parent[own]], mask=~known)}
    nodes = pa.table({**columns, **{c: pa.nulls(len(own), pa.binary()) for c in ("path", *VALUES)}})
    if whole:
        return nodes
    # What border nodes gathered goes with the first border path that has them.
    gathered = {
        "chars": chars, "ended": convs, "least": least, "saved": saved, "leaves": leaves, "children": children}
    sent = np.zeros(n, bool)
    out = {c: [] for c in ("path", *VALUES)}
    for row in (0, len(rows) - 1) if len(rows) > 1 else (0,):
        at = slot[paths.starts[row]:paths.last[row] + 1]
        again = sent[at]
        sent[at] = True
        out["path"].append(rows[row]["path"])
        for name in VALUES:
            empty = NONE if name == "least" else 0
            value = gathered[name][at] if name == "chars" else np.where(again, empty, gathered[name][at])
            out[name].append(value.astype("<i8").tobytes())
    k = len(out["path"])
    borders = pa.table({
        **{c: pa.nulls(k, nodes.schema.field(c).type) for c in columns},
        **{c: pa.array(v, pa.binary()) for c, v in out.items()}})
    return pa.concat_tables([nodes, borders])


# ---- all shards ------------------------------------------------------------------------------------


def _summer(whole: bool, shard_nodes: int) -> Callable:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                held += len(row["path"]) // DIGEST_BYTES
                if not whole and held >= shard_nodes and len(rows) >= LEAST_PATHS:
                    yield from sum_shard(rows, whole).to_batches()
                    rows, held = [], 0
        if rows:
            yield from sum_shard(rows, whole).to_batches()

    return work


def _levels(paths: DataFrame, shard_nodes: int) -> list[DataFrame]:
    """Nodes by level: first those inside shards of ``paths``, then those inside shards of their borders, and so on."""
    found = []
    while True:
        size = paths.agg(F.count("*").alias("n"), (F.sum(F.octet_length("path")) / DIGEST_BYTES).alias("nodes")).first()
        whole = (size["nodes"] or 0) <= shard_nodes or size["n"] <= LEAST_PATHS
        if whole:
            dealt = paths.coalesce(1)
        else:
            dealt = paths.repartitionByRange(math.ceil(size["nodes"] / shard_nodes), "path")
        summed = written(dealt.sortWithinPartitions("path").mapInArrow(_summer(whole, shard_nodes), SUMMED), "trie")
        found.append(summed.where(F.col("digest").isNotNull()).drop("path", *VALUES))
        if whole:
            return found
        paths = summed.where(F.col("path").isNotNull()).select("path", *VALUES)


def _chunker(ids_per_chunk: int) -> Callable:
    """Sorted (digest, conv_id) -> runs of ids of one node, comma-joined."""
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, ids = None, []
        done: list[tuple[bytes, int, str]] = []

        def flush() -> pa.RecordBatch:
            digests, firsts, texts = zip(*done)
            return pa.record_batch({
                "digest": pa.array(digests, pa.binary()), "first": pa.array(firsts, pa.int64()), "ids": pa.array(texts)})

        for batch in batches:
            for own, conv_id in zip(batch["digest"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (own != digest or len(ids) >= ids_per_chunk):
                    done.append((digest, ids[0], ",".join(map(str, ids))))
                    ids = []
                digest = own
                ids.append(conv_id)
                if len(done) >= 1000:
                    yield flush()
                    done = []
        if ids:
            done.append((digest, ids[0], ",".join(map(str, ids))))
        if done:
            yield flush()

    return chunk


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted runs -> one hash per node; a node's runs pass by one after the other."""
    digest, state = None, None
    for batch in batches:
        digests, hashes = [], []
        for own, ids in zip(batch["digest"].to_pylist(), batch["ids"].to_pylist()):
            if own == digest:
                state.update(b"," + ids.encode())
                continue
            if digest is not None:
                digests.append(digest), hashes.append(state.hexdigest())
            digest, state = own, hashlib.sha256(ids.encode())
        yield pa.record_batch({"digest": pa.array(digests, pa.binary()), "ends_sha256": pa.array(hashes, pa.string())})
    if digest is not None:
        yield pa.record_batch({"digest": pa.array([digest], pa.binary()), "ends_sha256": pa.array([state.hexdigest()])})


def _ends(conversations: DataFrame, n: int, ids_per_chunk: int) -> DataFrame:
    """For every node where conversations end, the hash of their ids in order.

    Ids are put in order by range, so a node with very many is spread over tasks; its hash, which is one chain by
    nature, then reads joined runs of ids as a stream.
    """
    ids = conversations.select(F.expr(f"substring(path, octet_length(path) - {DIGEST_BYTES - 1})").alias("digest"), "conv_id")
    runs = ids.repartitionByRange(n, "digest", "conv_id").sortWithinPartitions("digest", "conv_id").mapInArrow(
        _chunker(ids_per_chunk), "digest binary, first bigint, ids string")
    return runs.repartition(n, "digest").sortWithinPartitions("digest", "first").mapInArrow(
        _hashed, "digest binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, ids_per_chunk: int = IDS_PER_CHUNK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conversations(conv_id, turn, role, text, ...)`` are ordered by turn, null first, ties by a digest of role and
    text; null roles and texts are empty. Conversation c takes its first h turns from conversation c - c % 100 (all if
    that has fewer, none if it is absent) and goes on with its own after its first h, h = crc32 of c's digits % 6. Rows
    without a conv_id belong to no conversation and are left out; repeated rows are turns each; other columns are
    ignored; an empty table gives no nodes, not even the root.

    Returns digest, parent (digest, the root's its own), depth, conv_id (least member), parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256 (of the comma-joined ids that end here).
    """
    spark = conversations.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(rebuilt(conversations, n), "rebuilt")
    paths = rows.groupBy("path", "chars").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    levels = _levels(written(paths, "paths"), shard_nodes)
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    open_parent = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    if len(levels) > 1:
        tops = levels[1]
        for level in levels[2:]:
            tops = tops.unionByName(level)
        tops = small(tops.select(F.col("digest").alias("parent"), F.col("conv_id").alias("top_conv_id")), BROADCAST_BORDERS)
        found = nodes.where(open_parent).join(tops, "parent").withColumn("parent_conv_id", F.col("top_conv_id"))
        nodes = nodes.where(~open_parent).unionByName(found.select(nodes.columns))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.join(_ends(rows, n, ids_per_chunk), "digest", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", empty))
