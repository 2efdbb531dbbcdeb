"""Centroid clustering with an incremental distance matrix.

Vectors are turned into integers, so that all arithmetic is exact. Per vector a table keeps its exact dot products
with all centroids. When centroids move, a round adds to each dot product only the products with the components
of that centroid that changed; squared distances |v|^2 - 2 v.c + |c|^2 and their smallest follow from it. The
first round is the same update, from centroids of zeros.

A round is one narrow pass over the vectors, written to the shared folder, and one pass that sums the members of
each cluster inside its tasks, so that what is shuffled is one row a cluster and task, however large a cluster is.
Only centroids and their sums (clusters x components numbers) come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import scratch
from threadloom.session import Scratch

SIZE = 64  # components
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
# Largest size of an integer component: distances and dot products then stay within 64 bits.
LARGEST = 1 << 26
STATE = "vec_id bigint, v array<int>, dots array<bigint>, cluster int, distance bigint"


def usable(embedding: Column, size: int = SIZE) -> Column:
    """Exactly ``size`` components, none null, NaN or infinite. NaN is larger than all numbers here."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(embedding) == size) & finite, F.lit(False))


def integer_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, v) of the usable rows: each component x, as a double, becomes floor(scale * x).

    Raises an error for a component beyond 2^26 after that, whose distances 64 bits could not hold.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("e")).filter(usable(F.col("e"), size))

    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * scale)
        return F.when(F.abs(y) <= LARGEST, y).otherwise(F.raise_error(F.lit("a vector component is too large"))).cast("int")

    return rows.select("vec_id", F.transform("e", whole).alias("v"))


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``seed:vec_id``; a null id counts as empty, equal hashes by vector."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["v"] for r in rows.orderBy(name, "v").limit(clusters).select("v").collect()]


@dataclass
class Move:
    """The change of the centroids in a round: new values, and per centroid the components that differ."""

    new: np.ndarray
    change: np.ndarray

    def apply(self, v: np.ndarray, dots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(dots, cluster, distance) after the move; ties go to the smaller number."""
        for k, change in enumerate(self.change):
            parts = np.flatnonzero(change)
            if len(parts):
                dots[:, k] += v[:, parts] @ change[parts]
        distance = (v * v).sum(axis=1)[:, None] - 2 * dots + (self.new * self.new).sum(axis=1)
        cluster = distance.argmin(axis=1)
        return dots, cluster, distance[np.arange(len(v)), cluster]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def as_lists(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), kind))


def moved(rows: DataFrame, move: Move, size: int) -> DataFrame:
    """The state after a move. ``rows``: (vec_id, v), or an earlier state."""
    clusters, fresh = len(move.new), "dots" not in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(1), size)
            dots = np.zeros((len(v), clusters), np.int64) if fresh else matrix(batch.column(2), clusters)
            dots, cluster, distance = move.apply(v, dots)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), as_lists(v, pa.int32()), as_lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)],
                names=["vec_id", "v", "dots", "cluster", "distance"],
            )

    return rows.select("vec_id", "v", *([] if fresh else ["dots"])).mapInArrow(run, STATE)


def cluster_sums(state: DataFrame, clusters: int, size: int) -> list[tuple[int, int, list[int]]]:
    """(cluster, count, sums of the components) of the non-empty clusters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(clusters, np.int64), np.zeros((clusters, size), np.int64)
        for batch in batches:
            cluster, v = batch.column(0).to_numpy(), matrix(batch.column(1), size)
            order = np.argsort(cluster, kind="stable")
            found, starts = np.unique(cluster[order], return_index=True)
            if len(found):
                sums[found] += np.add.reduceat(v[order], starts, axis=0)
                count += np.bincount(cluster, minlength=clusters)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(count[full]), as_lists(sums[full], pa.int64())],
                                         names=["cluster", "n", "sums"])

    parts = state.select("cluster", "v").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    # Decimals, as sums of very many rows may leave 64 bits.
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", j).cast("decimal(20,0)")) for j in range(size)]).alias("sums"))
    return [(r["cluster"], r["n"], [int(x) for x in r["sums"]]) for r in totals.collect()]  # one row a cluster


def cluster_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE,
    seed: int = SEED, store: Scratch | None = None,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row per usable row of ``vectors``.

    ``vectors`` has vec_id and embedding (an array of numbers); other columns play no part. Rows whose embedding
    is null or of another length, or holds a null, NaN or infinite component, are left out. Each round assigns
    every vector to its nearest centroid and replaces the centroid of a non-empty cluster by the floor of the mean
    of each component; then vectors are assigned once more. ``distance`` is squared and in units of the integer
    vectors, inertias are its sums over the cluster and over all. Rows with the same vec_id are vectors of their
    own; a null vec_id is kept. With fewer vectors than ``clusters`` all of them start a centroid. A table without
    usable rows gives an empty result.
    """
    spark = vectors.sparkSession
    store = store or scratch(spark, "centroids")
    state = store.table(integer_vectors(vectors, size, scale), "vectors")
    start = first_centroids(state, clusters, seed)
    none = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not start:
        return spark.createDataFrame([], none)
    old, new = np.zeros((len(start), size), np.int64), np.array(start, np.int64)
    for number in range(rounds + 1):
        before = state
        state = store.table(moved(before, Move(new, new - old), size), "state")
        store.release(before)
        if number < rounds:
            old = new.copy()
            for k, n, sums in cluster_sums(state, len(new), size):
                new[k] = [total // n for total in sums]

    per_cluster = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()
    inertia = {r["cluster"]: int(r["d"]) for r in per_cluster}  # one row a cluster
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in new.tolist()]
    table = spark.createDataFrame([(k, d, sum(inertia.values()), names[k]) for k, d in inertia.items()],
                                  "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
