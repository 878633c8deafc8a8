"""Centroid clustering of integer vectors by subvector dictionaries, exact in whole numbers.

1. Every component becomes ``floor(scale * x)``. Vectors are dealt into shards of ``SHARD`` as they lie in their tasks.
   A shard is dictionary encoded without loss: its dimensions are cut into blocks, and each block keeps its distinct
   subvectors once and a code per vector. Blocks start with one dimension; neighbours are merged while their common
   dictionary stays below a ``REUSE``-th of the shard's vectors, so that a subvector is always used several times.
   Shards are written to the shared folder once.
2. In each round a shard's task takes the squared distances of all dictionary entries to the centroids, once per entry,
   and adds them up by code. It counts how often a cluster uses each entry, which gives the clusters' sums without
   touching single components. Sums are combined per task and added by Spark; ``k`` times the dimensions whole
   numbers come to the driver, whatever the input.
3. After the last round every vector is assigned once more and written; sums of distances come from what was written.

All is whole numbers: where squares could pass 64 bits, a shard is computed with Python's unbounded ones. A distance or
sum of distances beyond 64 bits fails the job, as does a component beyond 62 bits.

Defined cases: vectors that are null, of another length than ``dims``, or hold a null or non-finite component are left
out; first centroids are the ``k`` vectors of least ``sha256("3:" + id)``, equal ids (and null ids, which come last) by
their components; repeated rows are vectors of their own; fewer than ``k`` vectors give fewer centroids; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from closebook.llm.common import ARROW_ROWS, prepared, settings, store

SCALE = 1024
SHARD = 8192
REUSE = 4
WIDEST = 16
MOST = 1 << 62
# A shard is one row of some megabytes: few of them in an Arrow batch.
SHARDS_TOGETHER = "4"

SHARDS = "ids array<long>, starts array<int>, entries array<array<long>>, codes array<array<int>>"
SUMS = "cluster int, dim int, total decimal(38,0), n long"


def usable(vector: Column, dims: int) -> Column:
    """Whether a vector has ``dims`` components, all of them numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    return F.coalesce((F.size(vector) == dims) & ~F.exists(vector, bad), F.lit(False))


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x); exact, as the scale is a power of two."""
    floors = np.floor(values * float(scale))
    if len(floors) and not np.abs(floors).max() < MOST:
        raise ArithmeticError("a component does not fit into 62 bits")
    return floors.astype(np.int64)


def dictionaries(vectors: np.ndarray, reuse: int = REUSE, widest: int = WIDEST) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of dimensions as ``(first dimension, distinct subvectors, code of every vector)``, without loss."""
    n, dims = vectors.shape
    blocks = []
    for at in range(dims):
        entries, codes = np.unique(vectors[:, at], return_inverse=True)
        blocks.append((at, entries[:, None], codes))
    merging = True
    while merging:
        merging, wider = False, []
        for block in blocks:
            if wider and (both := _merged(wider[-1], block, n // reuse, widest)):
                wider[-1], merging = both, True
            else:
                wider.append(block)
        blocks = wider
    return blocks


def _merged(left: tuple, right: tuple, most: int, widest: int) -> tuple | None:
    (at, a, codes_a), (_, b, codes_b) = left, right
    if a.shape[1] + b.shape[1] > widest or max(len(a), len(b)) > most:
        return None
    pairs, codes = np.unique(codes_a.astype(np.int64) * len(b) + codes_b, return_inverse=True)
    if len(pairs) > most:
        return None
    return at, np.hstack([a[pairs // len(b)], b[pairs % len(b)]]), codes


def encoded(vectors: DataFrame, scale: int, dims: int) -> DataFrame:
    """Shards of dictionary-encoded vectors from rows of ``vec_id, vector``."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                part = batch.slice(at, SHARD)
                waiting.append(part)
                count += part.num_rows
                if count >= SHARD:
                    yield shard(waiting)
                    waiting, count = [], 0
        if count:
            yield shard(waiting)

    def shard(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = pa.chunked_array([b.column("vec_id") for b in batches]).combine_chunks()
        values = np.concatenate([np.asarray(b.column("vector").flatten(), dtype=np.float64) for b in batches])
        blocks = dictionaries(whole_numbers(values, scale).reshape(len(ids), dims))
        whole, small = pa.list_(pa.int64()), pa.list_(pa.int32())
        return pa.record_batch(
            [
                pa.array([ids], whole),
                pa.array([[at for at, _, _ in blocks]], small),
                pa.array([[entries.ravel() for _, entries, _ in blocks]], pa.list_(whole)),
                pa.array([[codes.astype(np.int32) for _, _, codes in blocks]], pa.list_(small)),
            ],
            names=["ids", "starts", "entries", "codes"],
        )

    return vectors.mapInArrow(encode, SHARDS)


class Shard:
    """One shard read back: blocks of dimensions with their dictionaries and codes."""

    def __init__(self, row: dict, dims: int):
        self.ids = row["ids"].values
        starts = row["starts"].values.to_numpy()
        self.blocks = []
        for at, end, entries, codes in zip(starts, [*starts[1:], dims], row["entries"].values, row["codes"].values, strict=True):
            subvectors = entries.values.to_numpy().reshape(-1, int(end - at))
            self.blocks.append((int(at), int(end), subvectors, codes.values.to_numpy()))

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distances, vectors by centroids: one computation per dictionary entry, summed by code."""
        exact = self._exact(centroids)
        total = np.zeros((len(self.ids), len(centroids)), dtype=exact)
        for at, end, entries, codes in self.blocks:
            gaps = entries.astype(exact)[:, None, :] - centroids[:, at:end].astype(exact)[None, :, :]
            total += (gaps * gaps).sum(2)[codes]
        return total

    def sums(self, cluster: np.ndarray, k: int, dims: int) -> np.ndarray:
        """Componentwise sums of each cluster's vectors, from the number of uses of each dictionary entry."""
        most = max((int(np.abs(entries).max(initial=0)) for _, _, entries, _ in self.blocks), default=0)
        exact = np.int64 if most * max(len(self.ids), 1) < MOST else object
        out = np.zeros((k, dims), dtype=object)
        for at, end, entries, codes in self.blocks:
            uses = np.bincount(codes * k + cluster, minlength=len(entries) * k).reshape(len(entries), k)
            out[:, at:end] = uses.T.astype(exact) @ entries.astype(exact)
        return out

    def _exact(self, centroids: np.ndarray) -> type:
        most = max((int(np.abs(entries).max(initial=0)) for _, _, entries, _ in self.blocks), default=0)
        most += max((abs(int(x)) for x in centroids.ravel()), default=0)
        return np.int64 if most * most * max(centroids.shape[1], 1) < MOST else object


def shards_of(batches: Iterable[pa.RecordBatch], dims: int) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Shard({name: batch.column(name)[i] for name in batch.schema.names}, dims)


def next_centroids(shards: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign every vector, then move each non-empty centroid to floor(sum / count)."""
    k, dims = centroids.shape

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for shard in shards_of(batches, dims):
            cluster = nearest(shard.distances(centroids))[0]
            sums += shard.sums(cluster, k, dims)
            counts += np.bincount(cluster, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.record_batch(
            [
                pa.array(np.repeat(used, dims), pa.int32()),
                pa.array(np.tile(np.arange(dims), len(used)), pa.int32()),
                pa.array([Decimal(int(x)) for x in sums[used].ravel()], pa.decimal128(38, 0)),
                pa.array(np.repeat(counts[used], dims), pa.int64()),
            ],
            names=["cluster", "dim", "total", "n"],
        )

    parts = shards.mapInArrow(add, SUMS)
    rows = parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    moved = centroids.copy()
    for row in rows:
        moved[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]
    return moved


def nearest(distances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centroid of least distance, the least number of equal ones, and that distance."""
    cluster = np.argmin(distances, axis=1) if distances.size else np.zeros(len(distances), dtype=np.int64)
    return cluster, distances[np.arange(len(distances)), cluster]


def first_centroids(vectors: DataFrame, k: int, scale: int, dims: int) -> np.ndarray:
    """The ``k`` vectors of least hash of their id; ``k`` rows come to the driver."""
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    rows = vectors.orderBy(order, F.col("vector")).limit(k).collect()
    values = np.array([row["vector"] for row in rows], dtype=np.float64).reshape(len(rows), dims)
    return whole_numbers(values, scale)


def cluster_vectors(
    df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that takes part."""
    spark = prepared(df.sparkSession)
    vectors = df.where(usable(F.col(vector), dims)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    centroids = first_centroids(vectors, k, scale, dims)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards_of(batches, dims):
            cluster, distance = nearest(shard.distances(centroids))
            out = [shard.ids, pa.array(cluster, pa.int32()), pa.array(distance.tolist(), pa.int64())]
            yield pa.record_batch(out, names=["vec_id", "cluster", "distance"])

    shards = store(encoded(vectors, scale, dims), "shards")
    with settings(spark, {ARROW_ROWS: SHARDS_TOGETHER}):
        for _ in range(rounds):
            centroids = next_centroids(shards, centroids)
        assigned = store(shards.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    total = sum(row["cluster_inertia"] for row in sums)
    digests = [sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    facts = [(row["cluster"], row["cluster_inertia"], total, digests[row["cluster"]]) for row in sums]
    # One row per centroid: at most k.
    per_cluster = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = assigned.join(F.broadcast(per_cluster), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
