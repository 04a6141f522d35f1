"""Language-model scoring by context-tree weighting.

Every byte is decomposed into eight binary decisions; each decision has a tree of contexts of 0 to CONTEXT bytes.
A node holds how often training saw 0 and 1 there, its Krichevsky-Trofimov estimate, and the weight that the tree
gives to stopping there:

    P_w(node) = 1/2 P_kt(node) + 1/2 product of P_w(children),      weight = 1/2 P_kt(node) / P_w(node)

A symbol's probability mixes the estimates of all depths on its path by those weights. A context that training
never saw has no node: the path ends above it. Counts are taken over all training rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm import bytegrams
from clicktide.llm.bytegrams import CONTEXT
from clicktide.llm.exchange import (
    ASKED, REPLIES, asked_rows, block_number, blocks_of, counts_of, mix, pieces, replies_in_order, sharded_counts,
)
from clicktide.llm.wordhash import hashes_of, is_space, words_in

HALF = math.log(0.5)
LOG10 = math.log(10)
# The end of a text stands among the words' hashes as this value.
END = np.uint64(0xE4D0F7E87E57A11)
# Smaller blocks than other operators': the last step holds the order of all of a block's symbols.
BLOCK_BYTES = 16 << 20
SCORES = """doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double,
    score double, n_bytes long, bits_per_byte double"""


# ---- the tree ------------------------------------------------------------------------------------


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For x >= 1/2: recurrence up to x + 8, then the asymptotic series."""
    y = x + 8.0
    product = x.copy()
    for k in range(1, 8):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence with these numbers of 0 and 1."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)


def bit_nodes(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Node of every decision of every key at this depth, (8, n), and the decision taken."""
    context = (keys >> np.uint64(8 * (CONTEXT + 1 - depth))) << np.uint64(8) if depth else np.zeros_like(keys)
    symbol = keys & np.uint64(255)
    nodes = np.empty((8, len(keys)), np.uint64)
    bits = np.empty((8, len(keys)), bool)
    for k in range(8):
        nodes[k] = context | np.uint64(1 << k) | (symbol >> np.uint64(8 - k))
        bits[k] = (symbol >> np.uint64(7 - k)) & np.uint64(1)
    return nodes, bits


class Level:
    """Nodes of one depth, sorted: their counts, log P_w and weight of stopping."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> None:
        self.nodes, self.zeros, self.ones = nodes, zeros, ones
        own = log_kt(zeros, ones)
        if below is None:
            self.log_weighted, self.weight = own, np.ones(len(nodes))
        else:
            self.log_weighted = np.logaddexp(HALF + own, HALF + below)
            self.weight = np.exp(HALF + own - self.log_weighted)

    def above(self, parents: np.ndarray) -> np.ndarray:
        """Sum of log P_w over the children of each of the sorted ``parents``."""
        parent = ((self.nodes >> np.uint64(16)) << np.uint64(8)) | (self.nodes & np.uint64(255))
        return np.bincount(np.searchsorted(parents, parent), self.log_weighted, len(parents))

    def mixed(self, nodes: np.ndarray, bits: np.ndarray, deeper: np.ndarray, has_deeper: np.ndarray) -> tuple:
        """Probability of the decisions from this depth down, and whether there is any node."""
        if not len(self.nodes):
            return deeper, has_deeper
        at = np.minimum(np.searchsorted(self.nodes, nodes), len(self.nodes) - 1)
        here = self.nodes[at] == nodes
        zeros, ones = self.zeros[at], self.ones[at]
        estimate = (np.where(bits, ones, zeros) + 0.5) / (zeros + ones + 1.0)
        weight = np.where(has_deeper, self.weight[at], 1.0)
        return np.where(here, weight * estimate + (1 - weight) * deeper, deeper), here | has_deeper


def levels_of(keys: np.ndarray, counts: np.ndarray) -> dict[int, Level]:
    """The nodes of depths 2 to CONTEXT of one shard."""
    counted = {}
    for depth in range(2, CONTEXT + 1):
        nodes, bits = bit_nodes(keys, depth)
        distinct, where = np.unique(nodes.ravel(), return_inverse=True)
        weights = np.tile(counts.astype(np.float64), 8)
        ones = np.bincount(where, weights * bits.ravel(), len(distinct))
        counted[depth] = distinct, np.bincount(where, weights, len(distinct)) - ones, ones
    levels: dict[int, Level] = {}
    for depth in range(CONTEXT, 1, -1):
        nodes, zeros, ones = counted[depth]
        levels[depth] = Level(nodes, zeros, ones, levels[depth + 1].above(nodes) if depth < CONTEXT else None)
    return levels


TOP = "node long, zeros double, ones double, below double"


def _top_rows(batches):
    """Each shard's share of the nodes of depth 1."""
    for batch in batches:
        for keys, counts in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
            keys, counts = np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64)
            if not len(keys):
                continue
            level = levels_of(keys, counts)[2]
            parent = ((level.nodes >> np.uint64(16)) << np.uint64(8)) | (level.nodes & np.uint64(255))
            nodes, where = np.unique(parent, return_inverse=True)
            yield pa.record_batch({
                "node": pa.array(nodes.astype(np.int64)),
                "zeros": np.bincount(where, level.zeros, len(nodes)),
                "ones": np.bincount(where, level.ones, len(nodes)),
                "below": np.bincount(where, level.log_weighted, len(nodes)),
            })


def top_levels(model: DataFrame) -> dict[int, tuple]:
    """Depths 0 and 1: at most 256 contexts of 255 decisions each, so they fit everywhere."""
    rows = (model.mapInArrow(_top_rows, TOP).groupBy("node")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below"))
            .orderBy("node").toPandas())
    nodes = rows["node"].to_numpy(np.uint64)
    zeros, ones = rows["zeros"].to_numpy(np.float64), rows["ones"].to_numpy(np.float64)
    one = Level(nodes, zeros, ones, rows["below"].to_numpy(np.float64))
    decision = nodes & np.uint64(255)
    root, where = np.unique(decision, return_inverse=True)
    zero = Level(root, np.bincount(where, zeros, len(root)), np.bincount(where, ones, len(root)),
                 np.bincount(where, one.log_weighted, len(root)))
    return {0: zero, 1: one}


def log_probabilities(keys: np.ndarray, levels: dict[int, Level]) -> np.ndarray:
    """Natural log of the model's probability of each key's symbol in its context."""
    total = np.zeros(len(keys))
    for a in range(0, len(keys), 100_000):
        part = keys[a:a + 100_000]
        probability, known = np.full((8, len(part)), 0.5), np.zeros((8, len(part)), bool)
        for depth in range(CONTEXT, -1, -1):
            nodes, bits = bit_nodes(part, depth)
            probability, known = levels[depth].mixed(nodes, bits, probability, known)
        total[a:a + 100_000] = np.log(probability).sum(axis=0)
    return total


# ---- training and scoring ------------------------------------------------------------------------


def tokens_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """What the model scores of each text, its words (A-Z in lower case) joined by one space; the hashes of all texts'
    words, each text's followed by its end; and the numbers of these. (The end follows a scored text as a symbol.)"""
    data = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    begins, ends = words_in(data)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(begins, bounds)
    n_words = np.diff(first)
    # Of the white space, one byte behind each word stays, unless the word is its text's last.
    followed = np.ones(len(ends), bool)
    followed[first[1:][n_words > 0] - 1] = False
    stays = ~is_space(data)
    stays[ends[followed]] = True
    spaced = data.copy()
    spaced[ends[followed]] = 32
    kept = spaced[stays].tobytes()
    at = np.concatenate([[0], np.cumsum(stays)])[bounds].tolist()
    words = np.insert(hashes_of(data, begins, ends), first[1:], END)
    return [kept[a:b] for a, b in zip(at, at[1:])], words, n_words + 1


def train(rows: DataFrame, n_shards: int) -> tuple[DataFrame, DataFrame]:
    """Packed counts of byte n-grams and of words over all rows with a ``_text``."""
    def grams(batch: pa.RecordBatch) -> list:
        texts = batch["_text"].to_pylist()
        return [bytegrams.counted(tokens_of(texts[a:b])[0]) for a, b in pieces(texts)]

    def words(batch: pa.RecordBatch) -> list:
        texts = batch["_text"].to_pylist()
        return [np.unique(tokens_of(texts[a:b])[1], return_counts=True) for a, b in pieces(texts)]

    texts = rows.select("_text")
    return (
        sharded_counts(texts, grams, lambda keys: bytegrams.shard_of(keys, n_shards), "ctw-grams"),
        sharded_counts(texts, words, lambda keys: (mix(keys) % np.uint64(n_shards)).astype(np.int32), "ctw-words"),
    )


def _asker(n_shards: int) -> Callable:
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams, words = _questions(table)
        block = block_number(key)
        return pa.concat_tables([
            asked_rows(grams, bytegrams.shard_of(grams, n_shards), block),
            asked_rows(words, _word_shard(words, n_shards), block),
        ])

    return ask


def _word_shard(words: np.ndarray, n_shards: int) -> np.ndarray:
    """Shards of words come after those of n-grams."""
    return (mix(words) % np.uint64(n_shards)).astype(np.int32) + n_shards


class _Piece:
    """Symbols and words of consecutive texts."""

    def __init__(self, texts: list[bytes]) -> None:
        spelled, words, self.n_words = tokens_of(texts)
        self.size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.symbols = bytegrams.Symbols(spelled)
        self.words, self.word_at = np.unique(words, return_inverse=True)


def _questions(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-gram and word keys of a block, sorted."""
    texts = table["_text"].to_pylist()
    grams, words = [], []
    for a, b in pieces(texts):
        spelled, own, _ = tokens_of(texts[a:b])
        grams.append(bytegrams.counted(spelled)[0])
        words.append(np.unique(own))
    return bytegrams.distinct(grams), bytegrams.distinct(words)


def _answerer(n_shards: int, top: dict[int, Level]) -> Callable:
    def answer(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
        blobs = [np.frombuffer(k, np.uint64) for k in asked["keys"].to_pylist()]
        keys, counts = counts_of(model)
        distinct = np.unique(np.concatenate(blobs)) if blobs else np.empty(0, np.uint64)
        if block_number(key) < n_shards:
            levels = {**top, **levels_of(keys, counts)}
            values = log_probabilities(distinct, levels)
        else:
            at = np.minimum(np.searchsorted(keys, distinct), max(0, len(keys) - 1))
            values = np.where(keys[at] == distinct, counts[at], 0) if len(keys) else np.zeros(len(distinct))
        values = values.astype(np.float64)
        return pa.table({
            "shard": asked["shard"], "block": asked["block"],
            "reply": pa.array([values[np.searchsorted(distinct, b)].tobytes() for b in blobs], pa.binary()),
        })

    return answer


def _scorer(n_shards: int, n_train: int, n_distinct: int) -> Callable:
    def score(rows: pa.Table, replies: pa.Table) -> pa.Table:
        texts = rows["_text"].to_pylist()
        parts = [_Piece(texts[a:b]) for a, b in pieces(texts)]
        grams = bytegrams.distinct([p.symbols.keys for p in parts])
        words = bytegrams.distinct([p.words for p in parts])
        gram_values = replies_in_order(grams, bytegrams.shard_of(grams, n_shards), replies, "f8")
        word_values = replies_in_order(words, _word_shard(words, n_shards), replies, "f8")
        base_of = np.log10((word_values + 0.1) / (n_train + 0.1 * (n_distinct + 1)))
        tokens, known, base, scores, size = ([] for _ in range(5))
        for part in parts:
            size += part.size.tolist()
            scores.append(part.symbols.sums(grams, gram_values) / LOG10)
            at = np.searchsorted(words, part.words)[part.word_at]
            starts = np.concatenate([[0], np.cumsum(part.n_words)[:-1]])
            tokens.append(part.n_words)
            known.append(np.add.reduceat((word_values[at] > 0).astype(np.int64), starts))
            base.append(np.add.reduceat(base_of[at], starts))
        score = np.concatenate(scores) if scores else np.empty(0)
        size = np.array(size, np.int64)
        return pa.table({
            "doc_id": rows["doc_id"], "held_out": rows["held_out"],
            "n_tokens": np.concatenate(tokens) if tokens else np.empty(0, np.int64),
            "n_known": np.concatenate(known) if known else np.empty(0, np.int64),
            "train_tokens": np.full(len(score), n_train, np.int64),
            "base_score": np.concatenate(base) if base else np.empty(0), "score": score,
            "n_bytes": size, "bits_per_byte": -score * (LOG10 / math.log(2)) / (size + 1),
        })

    return score


def score_documents(docs: DataFrame, held_out: object, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row of ``docs(doc_id, text, ...)``, learning from the rows where ``held_out`` is false.

    A text is taken as its words (A-Z in lower case, separated by ASCII white space) joined by one space; both
    scores are log10 probabilities of that sequence with its end: ``score`` by context-tree weighting over bytes,
    ``base_score`` by smoothed word frequencies. Null texts are empty and have one token, the end. A null
    ``held_out`` counts as held out. Repeated rows are learnt from and scored each; other columns are ignored; an
    empty table gives an empty result.
    """
    rows, n_blocks = blocks_of(
        docs, {"doc_id": F.col("doc_id"), "held_out": F.coalesce(held_out, F.lit(True))}, block_bytes)
    grams, words = train(rows.where(~F.col("held_out")), n_blocks)
    top = top_levels(grams)
    sizes = words.mapInArrow(_word_totals, "tokens long, distinct long").agg(F.sum("tokens"), F.sum("distinct")).first()
    n_train, n_distinct = int(sizes[0] or 0), int(sizes[1] or 0)
    model = grams.unionByName(words.withColumn("shard", (F.col("shard") + n_blocks).cast("int")))
    asked = rows.groupBy("_block").applyInArrow(_asker(n_blocks), ASKED)
    replies = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(_answerer(n_blocks, top), REPLIES)
    return rows.groupBy("_block").cogroup(replies.groupBy("block")).applyInArrow(
        _scorer(n_blocks, n_train, n_distinct), SCORES)


def _word_totals(batches):
    for batch in batches:
        counts = [np.frombuffer(c, np.int64) for c in batch["counts"].to_pylist()]
        yield pa.record_batch({
            "tokens": pa.array([int(c.sum()) for c in counts], pa.int64()),
            "distinct": pa.array([len(c) for c in counts], pa.int64()),
        })
