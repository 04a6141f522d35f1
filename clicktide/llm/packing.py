"""Lexical retrieval packing: documents share a training window with their nearest unused neighbours by BM25.

Numbers of documents per term are counted over the whole corpus. Documents are dealt to shards by content: in the order
of their most telling terms, so documents that share rare terms lie next to each other however many shards there are; a
shard is a bounded stretch of that order. It keeps an inverted index of its documents with BM25 weights; each seed
document asks it for unused neighbours by its most telling terms, and these fill the window. Neighbours that fit go in
whole, then the best that does not fit is cut, and its rest opens the next window. So windows are full; what is left at
a shard's end is cut into sequences whose lengths are powers of two, which need no padding. Shards are independent: a
lost task packs its shards again, to the same sequences.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.exchange import written
from clicktide.llm.tokens import encoder, vocabulary_path

WINDOW = 1024
SHARD_BYTES = 4 << 20  # of two-byte ids
# Partitions that the order of telling terms is dealt to at most; a task cuts its own into shards.
MOST_PARTITIONS = 20_000
K1, B = 1.2, 0.75
# Terms of a document that decide its place in the order.
PLACE_TERMS = 4
# Terms that a seed asks with, and neighbours that one question gets; a seed asks again when they are all used.
QUERY_TERMS = 24
NEIGHBOURS = 64
END_ID = 0
# Token ids are written twice; the second table, read once, is kept small.
COMPRESSION = "zstd"
# Numbers of documents and tokens are counted under these, beside the terms.
DOCUMENTS, TOKENS = -1, -2
PIECES = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,
    sequence_length long"""


ENCODED = "doc_id long, _wide boolean, _ids binary, _counts binary"


def _encoded(path: str) -> Callable:
    """The documents' ids and, as one more row of every task, how many of its documents hold each term."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path).ids
        df, n, tokens = np.zeros(0, np.int64), 0, 0
        place = df
        for batch in batches:
            blobs = [np.append(ids_of(t), np.uint32(END_ID)) for t in batch["_text"].to_pylist()]
            wide = []
            for ids in blobs:
                n, tokens = n + 1, tokens + len(ids)
                most = int(ids.max())
                # Two bytes an id where the vocabulary allows it, for the shuffle.
                wide.append(most > 0xFFFF)
                if most >= len(df):
                    df = np.concatenate([df, np.zeros(most + 1 - len(df), np.int64)])
                    place = np.zeros(len(df), np.int64)
                # Each term once, without a sort: where its last place was noted.
                terms, places = ids.astype(np.intp), np.arange(len(ids))
                place[terms] = places
                df[terms[place[terms] == places]] += 1
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "_wide": pa.array(wide, pa.bool_()),
                "_ids": pa.array([b.astype("<u4" if w else "<u2").tobytes() for b, w in zip(blobs, wide)], pa.binary()),
                "_counts": pa.nulls(len(blobs), pa.binary()),
            })
        held = np.flatnonzero(df)
        counts = np.concatenate([[DOCUMENTS, n, TOKENS, tokens], np.stack([held, df[held]], 1).ravel()]).astype(np.int64)
        yield pa.record_batch({
            "doc_id": pa.nulls(1, pa.int64()), "_wide": pa.nulls(1, pa.bool_()), "_ids": pa.nulls(1, pa.binary()),
            "_counts": pa.array([counts.tobytes()], pa.binary())})

    return encode


def _ids_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u4" if w else "<u2").astype("<u4")
            for b, w in zip(batch["_ids"].to_pylist(), batch["_wide"].to_pylist())]


class Corpus:
    """Numbers of documents and tokens, and for each term the number of documents that hold it and its idf."""

    def __init__(self, n: int, tokens: int, df: np.ndarray) -> None:
        self.n, self.tokens, self.mean, self.df = n, tokens, tokens / max(1, n), df
        self.idf = np.log1p((n - df + 0.5) / (df + 0.5))

    def weights(self, terms: np.ndarray, tf: np.ndarray, length: object) -> np.ndarray:
        """BM25 weight of terms that occur ``tf`` times in documents of a length."""
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch["_counts"].to_pylist():
            counts = np.frombuffer(packed, np.int64).reshape(-1, 2)
            yield pa.record_batch({"term": counts[:, 0].copy(), "n": counts[:, 1].copy()})


def corpus_of(encoded: DataFrame) -> Corpus:
    """Counted over all documents; at most one row per token of the vocabulary comes back."""
    rows = encoded.select("_counts").where("_counts IS NOT NULL").mapInArrow(_term_counts, "term long, n long").groupBy(
        "term").agg(F.sum("n").alias("n")).toPandas()
    found = dict(zip(rows["term"].tolist(), rows["n"].tolist()))
    n, tokens = found.pop(DOCUMENTS, 0), found.pop(TOKENS, 0)
    df = np.zeros(max(found, default=0) + 1, np.int64)
    df[list(found)] = list(found.values())
    return Corpus(n, tokens, df)


def telling(ids: np.ndarray, corpus: Corpus, most: int) -> np.ndarray:
    """The document's ``most`` best terms that others hold too, by falling BM25 weight, then by number."""
    terms, tf = np.unique(ids, return_counts=True)
    shared = corpus.df[terms] > 1
    terms, tf = terms[shared], tf[shared]
    weights = corpus.weights(terms, tf, len(ids))
    if len(terms) > most:
        best = np.flatnonzero(weights >= np.partition(weights, -most)[-most])
        terms, weights = terms[best], weights[best]
    return terms[np.lexsort((terms, -weights))][:most]


def _placed(corpus: Corpus) -> Callable:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Rare terms first: those of like documents agree most often.
            firsts = [telling(ids, corpus, PLACE_TERMS) for ids in _ids_of(batch)]
            places = [t[np.lexsort((t, corpus.df[t]))].astype(">u4").tobytes() for t in firsts]
            yield pa.record_batch({
                "_place": pa.array(places, pa.binary()), **{c: batch[c] for c in ("doc_id", "_wide", "_ids")}})

    return place


class Index:
    """Inverted index of a shard: for each term its documents and BM25 weights."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus) -> None:
        n = len(docs)
        lengths = np.fromiter(map(len, docs), np.int64, n)
        owner = np.repeat(np.arange(n, dtype=np.int64), lengths)
        pairs, tf = np.unique(np.concatenate(docs).astype(np.int64) << 32 | owner, return_counts=True)
        del owner
        self.term, self.doc = pairs >> 32, pairs & 0xFFFFFFFF
        self.terms, first, here = np.unique(self.term, return_index=True, return_counts=True)
        self.first = np.append(first, len(pairs))
        self.weight = corpus.weights(self.term, tf, lengths[self.doc])
        # Each document's terms, by number; terms that no other document of the shard holds find nobody.
        self.number = np.repeat(np.arange(len(self.terms)), here)
        shared = np.flatnonzero(np.repeat(here, here) > 1)
        owners = self.doc[shared]
        # Two-byte numbers are sorted by radix.
        self.of_doc = shared[np.argsort(owners.astype(np.uint16) if n <= 1 << 16 else owners, kind="stable")]
        self.bounds = np.searchsorted(self.doc[self.of_doc], np.arange(n + 1))
        self.n = n

    def neighbours(self, seed: int, used: np.ndarray) -> np.ndarray:
        """Unused documents by falling score, then by number."""
        own = self.of_doc[self.bounds[seed]:self.bounds[seed + 1]]
        if not len(own):
            return own
        # By falling weight, then by number; only seeds are asked about.
        query = self.number[own[np.argsort(-self.weight[own], kind="stable")[:QUERY_TERMS]]]
        spans = [slice(self.first[t], self.first[t + 1]) for t in query]
        scores = np.bincount(
            np.concatenate([self.doc[s] for s in spans]), np.concatenate([self.weight[s] for s in spans]), self.n)
        scores[used] = 0
        found = np.flatnonzero(scores)
        if len(found) > NEIGHBOURS:
            bound = np.partition(scores[found], -NEIGHBOURS)[-NEIGHBOURS]
            found = found[scores[found] >= bound]
        return found[np.lexsort((found, -scores[found]))]


def pack(lengths: np.ndarray, index: Index, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length)."""
    n = len(lengths)
    used = np.zeros(n, bool)
    sequences: list[list[tuple[int, int, int]]] = []
    current: list[tuple[int, int, int]] = []
    room = window
    following = 0

    def put(doc: int, start: int) -> None:
        """The document from ``start`` on, over as many windows as it takes."""
        nonlocal current, room
        used[doc] = True
        while start < lengths[doc]:
            length = int(min(room, lengths[doc] - start))
            current.append((doc, start, length))
            start, room = start + length, room - length
            if not room:
                sequences.append(current)
                current, room = [], window

    while True:
        while following < n and used[following]:
            following += 1
        if following == n:
            break
        if not current:
            put(following, 0)
            continue
        seed = current[0][0]
        ranked = index.neighbours(seed, used)
        for doc in ranked[lengths[ranked] < room] if len(ranked) else ranked:
            if lengths[doc] < room:
                put(int(doc), 0)
        left = [d for d in ranked.tolist() if not used[d]]
        if left:
            put(left[0], 0)
            continue
        if len(ranked):  # all put in: there may be more than one question returns
            continue
        while following < n and used[following]:
            following += 1
        if following < n:
            put(following, 0)
    # The rest, in sequences of lengths that are powers of two.
    held = window - room
    for bit in range(held.bit_length() - 1, -1, -1):
        if held >> bit & 1:
            sequence, wanted = [], 1 << bit
            while wanted:
                doc, start, length = current.pop(0)
                take = min(length, wanted)
                sequence.append((doc, start, take))
                wanted -= take
                if take < length:
                    current.insert(0, (doc, start + take, length - take))
            sequences.append(sequence)
    return sequences


def _packer(window: int, with_ids: bool, shard_bytes: int, corpus: Corpus) -> Callable:
    def shard_rows(shard: int, names: list, docs: list[np.ndarray]) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        columns: list[list] = [[] for _ in range(8)]
        ids = []
        for number, sequence in enumerate(pack(lengths, Index(docs, corpus), window)):
            offset = 0
            total = sum(length for _, _, length in sequence)
            for doc, start, length in sequence:
                piece = docs[doc][start:start + length].tobytes()
                values = (names[doc], start, length, zlib.crc32(piece), len(docs[doc]), shard << 32 | number, offset, total)
                for column, value in zip(columns, values):
                    column.append(value)
                if with_ids:
                    ids.append(piece)
                offset += length
        names_of = [c.split()[0] for c in PIECES.split(",")]
        table = {name: pa.array([int(v) if v is not None else None for v in column], pa.int64())
                 for name, column in zip(names_of, columns)}
        if with_ids:
            table["ids"] = pa.array(ids, pa.binary())
        return pa.record_batch(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cut a partition, in order, into shards of about ``shard_bytes`` (as two-byte ids) and pack each."""
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 16
        names, docs, held = [], [], 0
        for batch in batches:
            for name, ids in zip(batch["doc_id"].to_pylist(), _ids_of(batch)):
                names.append(name), docs.append(ids)
                held += 2 * len(ids)
                if held >= shard_bytes:
                    yield shard_rows(shard, names, docs)
                    shard, names, docs, held = shard + 1, [], [], 0
        if docs:
            yield shard_rows(shard, names, docs)

    return run


def pack_documents(
    docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None, with_ids: bool = False,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Pack all rows of ``docs(doc_id, text, ...)`` into sequences of ``window`` tokens (a power of two).

    A document is its token ids and then id 0; null texts are empty. One row per piece: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset, sequence_length and, if asked for, the ids as little-endian unsigned
    32-bit integers. Every id lies in exactly one piece and no sequence needs padding. Repeated rows are packed each,
    null ids like others; other columns are ignored; an empty table gives an empty result.
    """
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    path = vocabulary or vocabulary_path()
    encoded = written(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).mapInArrow(_encoded(path), ENCODED), "encoded")
    corpus = corpus_of(encoded)
    n = min(MOST_PARTITIONS, max(1, math.ceil(2 * corpus.tokens / shard_bytes)))
    # The ids' hash last: copies of a document may fill several shards. Places are written, so that the search for range
    # borders reads these columns alone.
    order = ["_place", "doc_id", "_hash"]
    placed = written(
        encoded.where("_ids IS NOT NULL").select("doc_id", "_wide", "_ids").mapInArrow(
            _placed(corpus), "_place binary, doc_id long, _wide boolean, _ids binary"
        ).withColumn("_hash", F.xxhash64("_ids")), "placed", COMPRESSION)
    dealt = placed.coalesce(1) if n == 1 else placed.repartitionByRange(n, *order)
    return dealt.sortWithinPartitions(*order).select("doc_id", "_wide", "_ids").mapInArrow(
        _packer(window, with_ids, shard_bytes, corpus), PIECES + (", ids binary" if with_ids else ""))
