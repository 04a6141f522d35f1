"""Cross-tokenizer alignment: which tokens of two vocabularies meet in the same text, and how often over the corpus.

Both vocabularies cut the same bytes, so a text's tokens are two tilings of one line. Everything inside a task is done
with Arrow tables over all texts of a piece at once:

* token lists are flattened, ``list_parent_indices`` says whose they are, and a cumulative sum of token sizes minus
  that of the text's first token gives every token's end within its text;
* a full outer hash join on (text, end) puts both sides' ends together. In order of ends, each joined row is one
  stretch of bytes between neighbouring ends, the token of a side that covers it is the one that ends next, and so each
  row is one link of an A token and a B token; rows where both sides end close a group;
* ``Table.group_by`` counts id pairs per text and per block of texts. Spark adds the blocks' counts up.

A block asks for each of its pairs once, however often its texts hold it, and gets the corpus count back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.exchange import pieces, small, written
from clicktide.llm.tokens import SPECIAL, encoder

# Bytes of text worked on at once, and of a block of texts that asks for its pairs together.
PIECE_BYTES = 1 << 20
BLOCK_BYTES = 12 << 20
# A row of a block weighs this much besides its text.
ROW_BYTES = 64
# Best counts that are broadcast: one row of two longs for each id of vocabulary B at most.
BROADCAST_IDS = 1_000_000

PER_TEXT = "n_a long, n_b long, n_groups long, n_links long"
ALIGNED = f"doc_id {{id}}, {PER_TEXT}, groups_sha256 string, pairs array<bigint>, times array<bigint>, block bigint, pair bigint, links bigint"


class ByteVocabulary:
    """Byte-level vocabulary A: ids of a space and the text. Strings of special tokens are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.fast = encoder(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        symbols = self._symbols()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            spelled[number] = (
                bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode())
        self.spelled = pa.array(spelled, pa.binary())

    @staticmethod
    def _symbols() -> dict[str, int]:
        """Character -> byte of the byte-level alphabet: printable bytes stand for themselves, the others follow 255."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [
            np.array(self.tokenizer.encode(" " + t, add_special_tokens=False).ids, np.int64)
            if SPECIAL in t else self.fast.ids(" " + t).astype(np.int64) for t in texts]


class PieceVocabulary:
    """Vocabulary B of pieces with byte fallback, which puts a space before the text itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spelled = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            spelled.append(
                bytes([int(piece[3:5], 16)]) if self.model.is_byte(number) else piece.replace("▁", " ").encode())
        self.spelled = pa.array(spelled, pa.binary())

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))


def _spells(flat: pa.Array, spelled: pa.Array, lists: pa.ListArray, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every token's size, and for each text whether its tokens' bytes are a space and the text."""
    taken = spelled.take(flat)
    ends = np.frombuffer(taken.buffers()[1], np.int32, len(taken) + 1, taken.offset * 4).astype(np.int64)
    data = taken.buffers()[2].to_pybytes() if len(taken) else b""
    bounds = ends[lists.offsets.to_numpy()].tolist()  # of each text's tokens in the data
    same = np.fromiter((data[a:b] == b" " + t for a, b, t in zip(bounds, bounds[1:], texts)), bool, len(texts))
    return np.diff(ends), same


def _side(ids: pa.ListArray, sizes: np.ndarray, name: str) -> pa.Table:
    """Every token's text, end within its text, and place among all tokens."""
    parents = pc.list_parent_indices(ids).to_numpy().astype(np.int64)
    ends = pc.cumulative_sum(pa.array(sizes)).to_numpy()
    before = np.concatenate([[0], ends])[ids.offsets.to_numpy()[:-1]]  # of each text's first token
    return pa.table({
        "text": pa.array(parents), "end": pa.array(ends - before[parents]), name: pa.array(np.arange(len(parents)))})


def aligned(a: pa.ListArray, a_sizes: np.ndarray, b: pa.ListArray, b_sizes: np.ndarray) -> pa.Table:
    """Links (text, token places a and b, whether both end) of texts whose tokens spell the same bytes, in order."""
    joined = _side(a, a_sizes, "a").join(
        _side(b, b_sizes, "b"), ["text", "end"], join_type="full outer", use_threads=False,
    ).sort_by([("text", "ascending"), ("end", "ascending")]).combine_chunks()
    closes = pc.and_(pc.is_valid(joined["a"]), pc.is_valid(joined["b"]))
    # A text's last row closes on both sides, so filling from below never crosses texts.
    return pa.table({
        "text": joined["text"], "a": pc.fill_null_backward(joined["a"]), "b": pc.fill_null_backward(joined["b"]),
        "closes": closes})


def _spelled_groups(links: pa.Table, flat_a: pa.Array, flat_b: pa.Array, n_texts: int) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of every text, '' without tokens."""
    closes = np.flatnonzero(links["closes"].to_numpy())
    owner = links["text"].to_numpy()[closes]

    def side(name: str, flat: pa.Array) -> pa.Array:
        # Tokens come in order, so a group's are those up to the one that closes it.
        ends = links[name].to_numpy()[closes] + 1
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(offsets, flat.cast(pa.string())), ",")

    groups = pc.binary_join_element_wise(side("a", flat_a), side("b", flat_b), "|")
    per_text = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_texts))])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), groups), ";").to_pylist()


def _piece(texts: list[str | None], a_of: ByteVocabulary, b_of: PieceVocabulary) -> tuple[dict[str, list], pa.Table]:
    """Columns of the texts, and how often each text links each id pair."""
    whole = [t or "" for t in texts]
    raw = [t.encode() for t in whole]
    filled = [t for t in whole if t]
    a_ids, b_ids = iter(a_of.ids(filled)), iter(b_of.ids(filled))
    none = np.empty(0, np.int64)
    sides = []
    for ids, vocabulary in ((a_ids, a_of), (b_ids, b_of)):
        lists = _lists([next(ids) if t else none for t in whole])
        sides.append((lists, *_spells(lists.flatten(), vocabulary.spelled, lists, raw)))
    good = sides[0][2] & sides[1][2] & np.fromiter(map(bool, whole), bool, len(whole))

    def kept(lists: pa.ListArray, sizes: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
        if good.all():
            return lists, sizes
        parents = pc.list_parent_indices(lists).to_numpy()
        counts = np.where(good, pc.list_value_length(lists).to_numpy(), 0)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        stays = good[parents]
        return pa.ListArray.from_arrays(offsets, lists.flatten().filter(pa.array(stays))), sizes[stays]

    (a, a_sizes), (b, b_sizes) = (kept(lists, sizes) for lists, sizes, _ in sides)
    links = aligned(a, a_sizes, b, b_sizes)
    flat_a, flat_b = a.flatten(), b.flatten()
    spelled = _spelled_groups(links, flat_a, flat_b, len(whole))
    owner = links["text"].to_numpy()
    columns = {
        "n_a": pc.list_value_length(a).to_pylist(), "n_b": pc.list_value_length(b).to_pylist(),
        "n_groups": np.bincount(owner[links["closes"].to_numpy()], minlength=len(whole)).tolist(),
        "n_links": np.bincount(owner, minlength=len(whole)).tolist(),
        "groups_sha256": [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled],
    }
    pair = pc.add(pc.multiply(flat_a.take(links["a"]), pa.scalar(len(b_of.spelled))), flat_b.take(links["b"]))
    counted = pa.table({"text": links["text"], "pair": pair}).group_by(
        ["text", "pair"], use_threads=False).aggregate([([], "count_all")])
    return columns, counted.rename_columns(["text", "pair", "times"]).sort_by(
        [("text", "ascending"), ("pair", "ascending")]).combine_chunks()


_vocabularies: dict[tuple[str, str], tuple[ByteVocabulary, PieceVocabulary]] = {}


def _both(paths: tuple[str, str]) -> tuple[ByteVocabulary, PieceVocabulary]:
    """One pair per Python worker."""
    if paths not in _vocabularies:
        _vocabularies[paths] = ByteVocabulary(paths[0]), PieceVocabulary(paths[1])
    return _vocabularies[paths]


def _per_text(counted: pa.Table, n: int) -> dict[str, pa.Array]:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(counted["text"].to_numpy(), minlength=n))])
    offsets = pa.array(offsets, pa.int32())
    return {
        name: pa.ListArray.from_arrays(offsets, counted[name].combine_chunks()) for name in ("pairs", "times")}


def _summed(parts: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(parts).group_by("pair", use_threads=False).aggregate([("times", "sum")]).rename_columns(
        ["pair", "times"])


def _aligner(paths: tuple[str, str], block_bytes: int) -> Callable:
    """One row per text with its pairs, and at a block's end one row per distinct pair of the block."""
    def block_rows(block: int, parts: list[pa.Table], schema: pa.Schema) -> pa.RecordBatch:
        counts = _summed(parts).combine_chunks()
        n = len(counts)
        have = {
            "block": pa.array([block] * n, pa.int64()), "pair": counts["pair"].combine_chunks(),
            "links": counts["times"].combine_chunks().cast(pa.int64())}
        return pa.record_batch([have.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        a_of, b_of = _both(paths)
        # Blocks are numbered within the task; the rows are written with their number before anybody reads it.
        block = TaskContext.get().partitionId() << 32
        parts: list[pa.Table] = []
        held, schema = 0, None
        for batch in batches:
            schema = schema or pa.schema([
                ("doc_id", batch.schema.field("doc_id").type), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
                ("block", pa.int64()), ("pair", pa.int64()), ("links", pa.int64())])
            texts = batch["_text"].to_pylist()
            for start, end in pieces([t or "" for t in texts], PIECE_BYTES):
                columns, counted = _piece(texts[start:end], a_of, b_of)
                n = end - start
                lists = _per_text(counted.rename_columns(["text", "pairs", "times"]), n)
                have = {
                    "doc_id": batch["doc_id"].slice(start, n), **lists,
                    **{c: pa.array(v, pa.string() if c == "groups_sha256" else pa.int64()) for c, v in columns.items()},
                    "block": pa.array([block] * n, pa.int64())}
                yield pa.record_batch([have.get(f.name, pa.nulls(n, f.type)) for f in schema], schema=schema)
                parts.append(_summed([counted.select(["pair", "times"])]))
                held += sum(len(t or "") for t in texts[start:end]) + ROW_BYTES * n
                if held >= block_bytes:
                    yield block_rows(block, parts, schema)
                    parts, held, block = [], 0, block + 1
        if parts:
            yield block_rows(block, parts, schema)

    return align


def _totals(texts: pa.Table, replies: pa.Table) -> pa.Table:
    """Best links and summed counts of every text of a block, from the corpus counts of the block's pairs."""
    n = len(texts)
    lists = texts["pairs"].combine_chunks()
    asked = pa.table({
        "text": pc.list_parent_indices(lists).cast(pa.int64()), "pair": lists.flatten(),
        "times": texts["times"].combine_chunks().flatten()})
    found = asked.join(replies.select(["pair", "total", "best"]), "pair", join_type="inner", use_threads=False)
    weighed = pa.table({
        "text": found["text"], "sum": pc.multiply(found["times"], found["total"]),
        "best": pc.if_else(found["best"], found["times"], pa.scalar(0, pa.int64()))})
    per_text = weighed.group_by("text", use_threads=False).aggregate([("sum", "sum"), ("best", "sum")])
    n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
    place = per_text["text"].to_numpy()
    n_best[place], count_sum[place] = per_text["best_sum"].to_numpy(), per_text["sum_sum"].to_numpy()
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.table({
        **{c: texts[c] for c in names}, "n_best": pa.array(n_best), "count_sum": pa.array(count_sum),
        "groups_sha256": texts["groups_sha256"]})


def align(
    docs: DataFrame, vocabularies: tuple[str, str] | None = None, block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Tokens of two vocabularies aligned in every text of ``docs(doc_id, text, ...)``; the corpus counts of id pairs.

    First frame, one row per row of ``docs``: doc_id, n_a, n_b (tokens), n_groups (stretches between byte offsets
    where both vocabularies end a token), n_links (pairs of overlapping tokens), n_best (links whose pair is the most
    frequent of its B id in the corpus, ties included), count_sum (corpus counts over the links) and groups_sha256 of the
    spelled groups. Second frame: a_id, b_id, total (links of the pair in the corpus), best. Texts that are null or
    empty, or that a vocabulary does not spell as a space and the text, have no tokens: zeros and ''. Repeated rows
    count each; null ids are kept; other columns are ignored; an empty table gives two empty results.
    """
    if vocabularies is None:
        import public_tokenizers

        vocabularies = tuple(map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").alias("_text"))
    texts = written(rows.mapInArrow(_aligner(vocabularies, block_bytes), ALIGNED.format(id=id_type)), "aligned")
    asked = texts.where(F.col("pair").isNotNull()).select("block", "pair", "links")
    size_b = len(_both(vocabularies)[1].spelled)
    totals = asked.groupBy("pair").agg(F.sum("links").alias("total")).withColumn("b_id", F.col("pair") % size_b)
    highest = totals.groupBy("b_id").agg(F.max("total").alias("highest"))
    judged = written(
        totals.join(small(highest, BROADCAST_IDS), "b_id").select(
            "pair", F.floor(F.col("pair") / size_b).alias("a_id"), "b_id", "total",
            (F.col("total") == F.col("highest")).alias("best")), "pair-counts")
    replies = asked.select(F.col("block").alias("asker"), "pair").join(judged.select("pair", "total", "best"), "pair")
    own = texts.where(F.col("pair").isNull()).drop("pair", "links")
    result = own.groupBy("block").cogroup(replies.groupBy("asker")).applyInArrow(
        _totals, f"doc_id {id_type}, {PER_TEXT}, n_best long, count_sum long, groups_sha256 string")
    return result, judged.select("a_id", "b_id", "total", "best")
