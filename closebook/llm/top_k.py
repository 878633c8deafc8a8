"""Exact top-k inner products over integer vectors, by KD-trees per shard.

Candidates are handled shard by shard, a shard being ``SHARD`` consecutive vectors of a task. A shard's tree splits at
the median of its widest dimension down to leaves of ``LEAF`` vectors, and every node keeps the tight box of its
vectors. The greatest score a box can give a query bounds all below it, so nodes are visited best first, by the
queries for which they may still matter, until none is left; ties at the bound are visited, so results are exact.
The k-th score that bounds the search is propagated: from a first look at ``PROBES`` vectors of the whole table, which
all tasks get, and from each leaf to the next.

Queries are the rows whose id is divisible by ``every``; they are dealt into blocks by hash, about ``BLOCK`` to a
block, and each block is sent to all tasks at once.

Defined cases: null ids and vectors that are null or hold null or non-finite values take no part; vectors of another
length than the query's do not meet it; rows with the query's own id are no candidates; ties go to the smaller id,
repeated rows are separate candidates; fewer candidates than k give fewer rows; empty vectors score 0; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from closebook.llm.common import prepared, store

SCALE = 1024
SHARD = 16_384
LEAF = 128
BLOCK = 8192
PROBES = 2048


def integers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a double; null for vectors that take no part."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.when(vector.isNotNull() & ~F.exists(vector, bad), whole)


class Tree:
    """A KD-tree over one shard: ``order`` puts the vectors of every node next to each other."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(vectors))
        self.nodes: list[tuple[int, int, int, int]] = []  # begin, end, left, right
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self._add(vectors, 0, len(vectors), leaf)
        self.vectors = vectors[self.order]

    def _add(self, vectors: np.ndarray, begin: int, end: int, leaf: int) -> int:
        place = len(self.nodes)
        inside = vectors[self.order[begin:end]]
        low, high = inside.min(0, initial=np.inf), inside.max(0, initial=-np.inf)
        self.nodes.append((begin, end, -1, -1))
        self.low.append(low)
        self.high.append(high)
        # Equal vectors cannot be told apart by a split, and need no bound of their own.
        if end - begin > leaf and inside.shape[1] and (high > low).any():
            wide, middle = int((high - low).argmax()), (end - begin) // 2
            self.order[begin:end] = self.order[begin:end][np.argpartition(inside[:, wide], middle)]
            left = self._add(vectors, begin, begin + middle, leaf)
            right = self._add(vectors, begin + middle, end, leaf)
            self.nodes[place] = (begin, end, left, right)
        return place

    def bound(self, node: int, queries: np.ndarray) -> np.ndarray:
        """The greatest inner product that a vector in the node's box can have with each query."""
        return np.maximum(queries, 0) @ self.high[node] + np.minimum(queries, 0) @ self.low[node]


class Best:
    """The k best candidates of every query so far, and the score that a new one must reach."""

    def __init__(self, query_ids: np.ndarray, k: int, floor: np.ndarray):
        self.query_ids, self.k, self.floor = query_ids, k, floor.copy()
        self.scores = np.full((len(query_ids), 0), -np.inf)
        self.ids = np.zeros((len(query_ids), 0), dtype=np.int64)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of the same candidates for some queries."""
        if self.scores.shape[1] < self.k:
            more = self.k - self.scores.shape[1]
            self.scores = np.hstack([self.scores, np.full((len(self.query_ids), more), -np.inf)])
            self.ids = np.hstack([self.ids, np.full((len(self.query_ids), more), np.iinfo(np.int64).max)])
        scores = np.where(ids[None, :] == self.query_ids[rows, None], -np.inf, scores)
        useful = (scores >= self.floor[rows, None]).any(1)
        rows, scores = rows[useful], scores[useful]
        if not len(rows):
            return
        all_scores = np.hstack([self.scores[rows], scores])
        all_ids = np.hstack([self.ids[rows], np.broadcast_to(ids, scores.shape)])
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.ids[rows] = np.take_along_axis(all_ids, order, 1)
        self.floor[rows] = np.maximum(self.floor[rows], self.scores[rows, -1])


def search(tree: Tree, ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """Best-first traversal for a block of queries."""
    ids = ids[tree.order]
    rows = np.arange(len(queries))
    bound = tree.bound(0, queries)
    heap = [(-float(bound.max(initial=-np.inf)), 0, rows, bound)]
    while heap:
        _, node, rows, bound = heapq.heappop(heap)
        live = bound >= best.floor[rows]
        rows = rows[live]
        if not len(rows):
            continue
        begin, end, left, right = tree.nodes[node]
        if left < 0:
            for at in range(begin, end, LEAF):
                some = slice(at, min(at + LEAF, end))
                best.offer(rows, queries[rows] @ tree.vectors[some].T, ids[some])
            continue
        for child in (left, right):
            reach = tree.bound(child, queries[rows])
            near = reach >= best.floor[rows]
            if near.any():
                lead = float((reach - np.maximum(best.floor[rows], -1e300))[near].max())
                heapq.heappush(heap, (-lead, child, rows[near], reach[near]))


def _matrix(lists: pa.ListArray, length: int) -> np.ndarray:
    """Rows of one length as floats, exact for the products as long as they stay below 2^53."""
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), length)


def _exact(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray | None:
    """The dtype in which sums of products are exact."""
    most = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(vectors.shape[1], 1)
    return np.float64 if most < 2**53 else np.longdouble


def top_k(df: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's ``k`` best candidates, ranks from 1."""
    spark = prepared(df.sparkSession)
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), integers(F.col(vector)).alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    asked = store(rows.where(F.col("vec_id") % every == 0).dropDuplicates(), "queries")
    shapes = asked.groupBy(F.size("vector").alias("length")).count().collect()
    found = None
    for shape in shapes:
        length, blocks = shape["length"], -(-shape["count"] // BLOCK)
        same = rows.where(F.size("vector") == length)
        probes = _probes(same, length)
        for block in range(blocks):
            mine = asked.where((F.size("vector") == length) & (F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block))
            part = _block(same, mine.toArrow(), length, k, probes)
            found = part if found is None else found.unionAll(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _probes(rows: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A few real candidates, by which every task can bound the search from the start."""
    few = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PROBES).toArrow()
    lists = few.column("vector").combine_chunks()
    return np.asarray(few.column("vec_id"), dtype=np.int64), _matrix(lists, length)


def _block(rows: DataFrame, asked: pa.Table, length: int, k: int, probes: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    query_ids = np.asarray(asked.column("vec_id"), dtype=np.int64)
    queries = _matrix(asked.column("vector").combine_chunks(), length)
    first = Best(query_ids, k, np.full(len(query_ids), -np.inf))
    dtype = _exact(probes[1], queries)
    for at in range(0, len(probes[0]), LEAF):
        some = probes[1][at : at + LEAF].astype(dtype)
        first.offer(np.arange(len(queries)), (queries.astype(dtype) @ some.T).astype(np.float64), probes[0][at : at + LEAF])
    held = rows.sparkSession.sparkContext.broadcast((query_ids, queries, first.floor))

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, asks, floor = held.value
        waiting, count = [], 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count >= SHARD:
                yield shard(waiting, ids_of, asks, floor)
                waiting, count = [], 0
        if count:
            yield shard(waiting, ids_of, asks, floor)

    def shard(batches: list, ids_of: np.ndarray, asks: np.ndarray, floor: np.ndarray) -> pa.RecordBatch:
        vectors = np.vstack([_matrix(b.column("vector"), length) for b in batches])
        ids = np.concatenate([np.asarray(b.column("vec_id"), dtype=np.int64) for b in batches])
        use = _exact(vectors, asks)
        best = Best(ids_of, k, floor)
        search(Tree(vectors.astype(use)), ids, asks.astype(use), best)
        row, column = np.nonzero(np.isfinite(best.scores))
        return pa.record_batch(
            [
                pa.array(ids_of[row]), pa.array(row.astype(np.int64)), pa.array(best.ids[row, column]),
                pa.array(best.scores[row, column].astype(np.int64)),
            ],
            names=["query_id", "query", "vec_id", "score"],
        )

    return rows.mapInArrow(look, "query_id long, query long, vec_id long, score long")
