"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates are dealt to shards of SHARD_ROWS, queries to blocks of QUERY_ROWS; every block meets every shard. A shard
keeps one sorted list per dimension. A query reads the lists of its positive components from the top and those of its
negative ones from the bottom, all to the same depth. A candidate's upper bound counts entries not read yet with the
last value read, its lower bound with the list's last value. Candidates whose upper bound is below the k-th best lower
bound cannot qualify; once few enough are left, or the lists are read, the scores of those left are resolved. All
arithmetic is on integers, ties go to the smaller id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clicktide.llm.exchange import written

SHARD_ROWS = 8192
QUERY_ROWS = 512
DEPTHS = (0.5, 0.75, 0.875, 1.0)
# Part of a shard that may be left when scores are resolved.
RESOLVED_PART = 0.1
SCALE = 64
_INTEGERS = "row_id long, vec_id long, dims int, query boolean, packed binary"
_FOUND = "query_row long, query_id long, vec_id long, score long"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(SCALE * x) of every component; vectors with a null or non-finite one take no part."""
    for batch in batches:
        keep, dims, packed = [], [], []
        for i, vector in enumerate(batch["vector"].to_pylist()):
            if vector is None or None in vector:
                continue
            scaled = np.floor(SCALE * np.array(vector, np.float64))
            if np.isfinite(scaled).all():
                keep.append(i)
                dims.append(len(vector))
                packed.append(scaled.tobytes())
        rows = pa.array(keep, pa.int64())
        yield pa.record_batch({
            "row_id": batch["row_id"].take(rows), "vec_id": batch["vec_id"].take(rows), "dims": pa.array(dims, pa.int32()),
            "query": batch["query"].take(rows), "packed": pa.array(packed, pa.binary())})


class SortedLists:
    """A shard's lists: values by rank, and every candidate's rank in each."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, order, axis=0)
        self.ranks = np.empty(order.shape, np.int32)
        np.put_along_axis(self.ranks, order, np.arange(len(vectors), dtype=np.int32)[:, None], axis=0)

    def bounds(self, signed: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds (queries, candidates) after ``depth`` entries of every list.

        ``signed`` holds the queries' positive parts and then their negative parts.
        """
        n = len(self.vectors)
        top, bottom = self.ranks >= n - depth, self.ranks < depth
        last_top, last_bottom = self.values[n - depth], self.values[depth - 1]
        x = self.vectors
        upper = np.hstack([np.where(top, x, last_top), np.where(bottom, x, last_bottom)])
        if depth == n:
            exact = signed @ upper.T
            return exact, exact
        lower = np.hstack([np.where(top, x, self.values[0]), np.where(bottom, x, self.values[-1])])
        return signed @ lower.T, signed @ upper.T


def _exact_type(vectors: np.ndarray, queries: np.ndarray) -> type:
    """A number type in which all sums of products are exact."""
    size = max(1, vectors.shape[1])
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * size
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


def top_of_shard(vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray,
                 k: int) -> list[tuple[int, np.ndarray, list[int]]]:
    """Per query: its number, the best candidates (k and ties that ids decide) and their scores."""
    kind = _exact_type(vectors, queries)
    n, dims = vectors.shape
    if kind is object:
        vectors, queries = (np.array([[int(v) for v in row] for row in m], object).reshape(m.shape) for m in (vectors, queries))
    else:
        vectors, queries = vectors.astype(kind), queries.astype(kind)
    own = {int(r): i for i, r in enumerate(rows)}
    mine = np.array([own.get(int(r), -1) for r in query_rows])
    left = np.ones((len(queries), n), bool)
    has_own = np.flatnonzero(mine >= 0)
    left[has_own, mine[has_own]] = False
    if n > 4 * k and dims and kind is not object:
        lists = SortedLists(vectors)
        signed = np.hstack([np.maximum(queries, 0), np.minimum(queries, 0)])
        for part in DEPTHS:
            lower, upper = lists.bounds(signed, max(1, math.ceil(n * part)))
            lower[has_own, mine[has_own]] = -np.inf
            best = np.partition(lower, n - k, axis=1)[:, n - k]
            left &= upper >= best[:, None]
            if left.sum() <= RESOLVED_PART * left.size:
                break
    out = []
    for q in range(len(queries)):
        found = np.flatnonzero(left[q])
        scores = (vectors[found] @ queries[q]) if dims else np.zeros(len(found))
        order = np.lexsort((ids[found], -scores.astype(np.float64) if kind is not object else [-int(s) for s in scores]))[:k]
        if kind is object:
            order = sorted(range(len(found)), key=lambda i: (-scores[i], ids[found[i]]))[:k]
        out.append((q, found[order], [int(scores[i]) for i in order]))
    return out


_NO_ID = np.iinfo(np.int64).max


def _searcher(k: int) -> Callable:
    def search(key: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], [], []]
        if len(candidates) and len(queries):
            dims = candidates["dims"][0].as_py()

            def matrix(table: pa.Table) -> np.ndarray:
                return np.frombuffer(b"".join(table["packed"].to_pylist()), np.float64).reshape(len(table), dims)

            known = candidates["vec_id"].to_pylist()
            ids = np.array([_NO_ID if i is None else i for i in known], np.int64)
            query_rows, query_ids = queries["row_id"].to_pylist(), queries["vec_id"].to_pylist()
            for q, found, scores in top_of_shard(
                    matrix(candidates), ids, candidates["row_id"].to_numpy(), matrix(queries), np.array(query_rows), k):
                for i, score in zip(found.tolist(), scores):
                    for column, value in zip(columns, (query_rows[q], query_ids[q], known[i], max(-_NO_ID, min(score, _NO_ID)))):
                        column.append(value)
        names = ("query_row", "query_id", "vec_id", "score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """The k best rows of ``vectors(vec_id, <vector>, ...)`` for each query row: query_id, rank, vec_id, score.

    Components count as floor(64 * x), scores are integer inner products, ties go to the smaller vec_id (null last).
    Every row but the query's own is a candidate, so repeated rows find each other. Vectors that are null or hold a
    null or non-finite component take no part; a query meets only vectors of its own length. Scores beyond 63 bits count as
    the largest such number. Null ``is_query`` is no
    query. Other columns are ignored; an empty table gives an empty result.
    """
    rows = written(vectors.select(
        F.monotonically_increasing_id().alias("row_id"), "vec_id", F.coalesce(is_query, F.lit(False)).alias("query"),
        F.col(vector).alias("vector")).mapInArrow(_packed, _INTEGERS), "vectors")
    n, n_queries = rows.agg(F.count("*"), F.count_if("query")).first()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(n_queries / QUERY_ROWS))

    def dealt(which: int, parts: int) -> Column:
        return F.pmod(F.xxhash64("row_id", F.lit(which)), F.lit(parts)).cast("int")

    def every(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    candidates = rows.select("*", dealt(1, shards).alias("shard"), every(blocks).alias("block"))
    queries = rows.where("query").select("*", dealt(2, blocks).alias("block"), every(shards).alias("shard"))
    keys = ["dims", "shard", "block"]
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(_searcher(k), _FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
