"""Quality classifier: perplexity under an interpolated modified Kneser-Ney byte n-gram model of trusted text.

The model is trained on all trusted rows but those set aside for the thresholds. Counts live in shards keyed by the
two nearest context bytes; a shard joins its counts with the n-grams that blocks of documents ask for. Discounts
(three per order) and the two shortest orders are global and small: at most 256 * 256 rows.

A document is kept if its perplexity is at most the limit of its language and length class (short texts vary more): a
high quantile of the set-aside trusted documents, its distance from the median widened by SLACK. Quantiles are read off
counts in fine bins of log perplexity. A class's limit leans on its language's and length class's, and a language's on
that of all, by PRIOR documents: the fewer its own, the more, by one formula at every size. There is no lower limit:
texts that the model has seen lie low.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm import bytegrams
from clicktide.llm.bytegrams import CONTEXT
from clicktide.llm.exchange import (
    ASKED, BLOCK_BYTES, REPLIES, asked_rows, block_number, blocks_of, counts_of, from_planes, from_steps, pieces,
    planes, replies_in_order, sharded_counts, small, steps, written,
)

# Ids of trusted documents are broadcast up to this many (8 bytes each), and joined by shuffle beyond.
BROADCAST_IDS = 4_000_000
QUANTILE, SLACK = 0.995, 1.3
# Documents that the wider group's limit counts for in that of a narrower one.
PRIOR = 40
# Width of the bins of log perplexity.
BIN = 0.01
MEASURED = "row_id long, doc_id long, lang string, trusted boolean, aside boolean, n_symbols long, perplexity double"


class Order:
    """Grams of one context length, their counts, and their contexts' totals and numbers of counts 1, 2, 3 or more."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray) -> None:
        self.grams, self.counts = grams, counts
        self.contexts, where = np.unique(grams >> np.uint64(8), return_inverse=True)
        n = len(self.contexts)
        self.total = np.bincount(where, counts, n)
        self.kinds = np.stack([
            np.bincount(where, counts == 1, n), np.bincount(where, counts == 2, n), np.bincount(where, counts > 2, n)])

    def count_of_counts(self) -> np.ndarray:
        return np.array([(self.counts == k).sum() for k in (1, 2, 3, 4)], np.float64)

    def interpolated(self, grams: np.ndarray, discounts: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Probability of the last symbol of each gram, given that of the next shorter context."""
        if not len(self.grams):
            return lower
        at = np.minimum(np.searchsorted(self.contexts, grams >> np.uint64(8)), len(self.contexts) - 1)
        known = self.contexts[at] == grams >> np.uint64(8)
        total = np.where(known, self.total[at], 1.0)
        left = (discounts @ self.kinds)[at] / total
        where = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        count = np.where(self.grams[where] == grams, self.counts[where], 0)
        taken = np.where(count > 0, discounts[np.clip(count.astype(np.int64) - 1, 0, 2)], 0.0)
        return np.where(known, (count - taken) / total + left * lower, lower)


def discounts_of(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ from the numbers of grams seen 1, 2, 3, 4 times; half counts where those are missing."""
    if (n <= 0).any():
        return np.array([0.5, 1.0, 1.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)])
    return np.clip(d, 0.01, [0.99, 1.99, 2.99])


def gram(keys: np.ndarray, length: int) -> np.ndarray:
    """The key cut to a context of this length."""
    if not length:
        return keys & np.uint64(255)
    return ((keys >> np.uint64(8 * (CONTEXT + 1 - length))) << np.uint64(8)) | (keys & np.uint64(255))


def _shorter(grams: np.ndarray) -> np.ndarray:
    return ((grams >> np.uint64(16)) << np.uint64(8)) | (grams & np.uint64(255))


def orders_of(keys: np.ndarray, counts: np.ndarray) -> dict[int, Order]:
    """Context lengths CONTEXT (counts) to 2 (numbers of different bytes before) of one shard."""
    orders = {CONTEXT: Order(keys, counts.astype(np.float64))}
    for length in range(CONTEXT - 1, 1, -1):
        grams, before = np.unique(_shorter(orders[length + 1].grams), return_counts=True)
        orders[length] = Order(grams, before.astype(np.float64))
    return orders


SHARES = "length int, item long, value double"


def _shares(batches):
    """A shard's part of the counts of counts (items -1 to -4) and of the grams with one context byte."""
    for batch in batches:
        for keys, counts in zip(batch["keys"].to_pylist(), batch["counts"].to_pylist()):
            orders = orders_of(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64))
            grams, before = np.unique(_shorter(orders[2].grams), return_counts=True)
            length, item, value = [np.ones(len(grams), np.int32)], [grams.astype(np.int64)], [before.astype(np.float64)]
            for m, order in orders.items():
                length.append(np.full(4, m, np.int32))
                item.append(-np.arange(1, 5))
                value.append(order.count_of_counts())
            yield pa.record_batch({
                "length": np.concatenate(length), "item": np.concatenate(item), "value": np.concatenate(value)})


def top_of(model: DataFrame) -> tuple[dict[int, Order], dict[int, np.ndarray]]:
    """The orders with no and one context byte and all discounts; at most 256 * 256 + 20 rows."""
    rows = (model.mapInArrow(_shares, SHARES).groupBy("length", "item").agg(F.sum("value").alias("value"))
            .orderBy("length", "item").toPandas())
    ones = rows[(rows["length"] == 1) & (rows["item"] >= 0)]
    orders = {1: Order(ones["item"].to_numpy(np.uint64), ones["value"].to_numpy(np.float64))}
    grams, before = np.unique(orders[1].grams & np.uint64(255), return_counts=True)
    orders[0] = Order(grams, before.astype(np.float64))
    discounts = {m: discounts_of(orders[m].count_of_counts()) for m in (0, 1)}
    for m in range(2, CONTEXT + 1):
        part = rows[(rows["length"] == m) & (rows["item"] < 0)].sort_values("item", ascending=False)
        discounts[m] = discounts_of(part["value"].to_numpy(np.float64) if len(part) == 4 else np.zeros(4))
    return orders, discounts


def log_probabilities(keys: np.ndarray, orders: dict[int, Order], discounts: dict[int, np.ndarray]) -> np.ndarray:
    p = np.full(len(keys), 1 / 256)
    for length in range(CONTEXT + 1):
        p = orders[length].interpolated(gram(keys, length), discounts[length], p)
    return np.log(p)


def _grams(texts: list[bytes]) -> np.ndarray:
    return bytegrams.distinct([bytegrams.counted(texts[a:b])[0] for a, b in pieces(texts)])


def _asker(n_shards: int) -> Callable:
    def ask(key: tuple, table: pa.Table) -> pa.Table:
        grams = _grams(table["_text"].to_pylist())
        return asked_rows(grams, bytegrams.shard_of(grams, n_shards), block_number(key), steps)

    return ask


def _answerer(top: dict[int, Order], discounts: dict[int, np.ndarray]) -> Callable:
    def answer(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
        blobs = [from_steps(k) for k in asked["keys"].to_pylist()]
        distinct = np.unique(np.concatenate(blobs)) if blobs else np.empty(0, np.uint64)
        values = log_probabilities(distinct, {**top, **orders_of(*counts_of(model))}, discounts).astype(np.float32)
        return pa.table({
            "shard": asked["shard"], "block": asked["block"],
            "reply": pa.array([planes(values[np.searchsorted(distinct, b)]) for b in blobs], pa.binary()),
        })

    return answer


def _measurer(n_shards: int) -> Callable:
    def measure(rows: pa.Table, replies: pa.Table) -> pa.Table:
        texts = rows["_text"].to_pylist()
        parts = [bytegrams.Symbols(texts[a:b]) for a, b in pieces(texts)]
        grams = bytegrams.distinct([p.keys for p in parts])
        values = replies_in_order(grams, bytegrams.shard_of(grams, n_shards), replies, "f4", from_planes).astype(np.float64)
        logs = np.concatenate([np.empty(0), *(p.sums(grams, values) for p in parts)])
        sizes = np.concatenate([np.empty(0, np.int64), *(p.lengths for p in parts)])
        return pa.table({
            **{name: rows[name] for name in ("row_id", "doc_id", "lang", "trusted", "aside")},
            "n_symbols": sizes, "perplexity": np.exp(-logs / np.maximum(sizes, 1))})

    return measure


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents of which every label says good and none toxic; null labels say neither."""
    return (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min("quality").alias("_low"), F.max(F.coalesce("toxic", F.lit(0))).alias("_toxic"))
            .where("_low = 1 AND _toxic = 0").select("doc_id"))


def perplexities(docs: DataFrame, trusted: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each row's perplexity per byte; ``aside`` rows are trusted ones that the model has not seen."""
    ids = trusted.select(F.col("doc_id").alias("_trusted")).distinct()
    ids = small(ids, BROADCAST_IDS)
    flagged = docs.join(ids, docs["doc_id"] == ids["_trusted"], "left")
    rows, n_blocks = blocks_of(flagged, {
        "row_id": row_id(docs), "doc_id": F.col("doc_id"), "lang": F.col("lang"),
        "trusted": F.col("_trusted").isNotNull(),
        "aside": F.col("_trusted").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0),
    }, block_bytes)
    model = sharded_counts(
        rows.where("trusted AND NOT aside").select("_text"),
        lambda batch: [bytegrams.counted(t[a:b]) for t in [batch["_text"].to_pylist()] for a, b in pieces(t)],
        lambda keys: bytegrams.shard_of(keys, n_blocks), "kn-grams")
    top, discounts = top_of(model)
    asked = rows.groupBy("_block").applyInArrow(_asker(n_blocks), ASKED)
    replies = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(_answerer(top, discounts), REPLIES)
    return rows.groupBy("_block").cogroup(replies.groupBy("block")).applyInArrow(_measurer(n_blocks), MEASURED)


def row_id(docs: DataFrame) -> object:
    """Identity of a row by its contents: repeated rows share it and are decided alike."""
    return F.xxhash64(docs["doc_id"], docs["lang"], F.coalesce(docs["text"], F.lit("")))


def size_class(n: object) -> object:
    """0 up to 255 symbols, then one class for each four-fold size."""
    return F.greatest(F.lit(0), F.floor(F.log2(n) / 2) - 3).cast("int")


def limits_of(measured: DataFrame, quantile: float, slack: float) -> DataFrame:
    """(lang, _class, limit) of every language and length class of ``measured``; null limits if nothing is set aside."""
    counts = written(
        measured.where("aside").groupBy("lang", "_class", F.floor(F.log("perplexity") / BIN).alias("_bin")).agg(
            F.count("*").alias("_count")), "perplexity-bins")

    def own(*by: str) -> DataFrame:
        """Number of documents of each group and its limit by them alone, as a logarithm."""
        group = Window.partitionBy(*(by or [F.lit(0)]))
        bins = counts.groupBy(*by, "_bin").agg(F.sum("_count").alias("_count")).select(
            *by, "_bin", F.sum("_count").over(group).alias("_n"), F.sum("_count").over(group.orderBy("_bin")).alias("_upto"))

        def at(share: float) -> object:  # upper edge of the bin that reaches the share
            return (F.min(F.when(F.col("_upto") >= share * F.col("_n"), F.col("_bin"))) + 1) * BIN

        found = bins.groupBy(*by).agg(F.max("_n").alias("_n"), at(0.5).alias("_middle"), at(quantile).alias("_high"))
        return found.select(*by, "_n", (F.col("_middle") + slack * (F.col("_high") - F.col("_middle"))).alias("_own"))

    def named(frame: DataFrame, suffix: str) -> DataFrame:
        return frame.toDF(*[f"{c}_{suffix}" for c in frame.columns])

    def leaning(n: str, limit: str, wider: object) -> object:
        n, limit = F.coalesce(F.col(n), F.lit(0)), F.coalesce(F.col(limit), F.lit(0.0))
        return (n * limit + PRIOR * wider) / (n + PRIOR)

    both, lang, size, every = (
        named(own(*by), suffix) for by, suffix in ((("lang", "_class"), "b"), (("lang",), "l"), (("_class",), "c"), ((), "a")))
    groups = measured.select("lang", "_class").distinct().withColumn("_one", F.lit(1))
    joined = (
        groups.join(both, F.col("lang").eqNullSafe(F.col("lang_b")) & (F.col("_class") == F.col("_class_b")), "left")
        .join(lang, F.col("lang").eqNullSafe(F.col("lang_l")), "left")
        .join(size, F.col("_class") == F.col("_class_c"), "left")
        .join(every.withColumn("_one", F.lit(1)), "_one", "left"))
    of_all = F.col("_own_a")
    wider = F.greatest(leaning("_n_l", "_own_l", of_all), leaning("_n_c", "_own_c", of_all))
    return joined.select("lang", "_class", F.exp(leaning("_n_b", "_own_b", wider)).alias("limit"))


def classify(
    docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, slack: float = SLACK,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Decide every row of ``docs(doc_id, text, lang, ...)`` by the trusted rows that ``labels`` names.

    Returns row_id, doc_id, lang, trusted, aside, n_symbols, perplexity, limit and kept. Null texts are empty and, like
    every text, judged by their perplexity; a null language is one. The limit of a language and length class leans, by
    PRIOR documents, on the larger of the language's and the length class's, and these on that of all rows; with no
    set-aside row at all every row is kept. Repeated rows get the same decision. Other columns are ignored; an empty
    table gives an empty result.
    """
    measured = written(perplexities(docs, trusted_ids(labels), block_bytes), "quality").withColumn(
        "_class", size_class(F.col("n_symbols")))
    limits = limits_of(measured, quantile, slack).toDF("_of", "_size", "limit")
    return (
        measured.join(limits, F.col("lang").eqNullSafe(F.col("_of")) & (F.col("_class") == F.col("_size")), "left")
        .withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("limit"), F.lit(True)))
        .select("row_id", "doc_id", "lang", "trusted", "aside", "n_symbols", "perplexity", "limit", "kept"))
