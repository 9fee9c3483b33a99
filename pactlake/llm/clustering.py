"""Operator 11: clustering around centroids, with a matrix of dot products that is kept and updated.

Every vector is stored with its exact integer dot product with every centroid. Once a centroid has moved, its dot product
with a vector changes by the sum, over the components that moved, of how far they moved times the vector's component: only
those are read and multiplied. The squared distance is |x|^2 - 2 x.c + |c|^2, so the nearest centroid is the least of
|c|^2 - 2 x.c over a vector's row of the matrix. All of it is integer arithmetic, so no error builds up over the rounds.

The sums that the next centroids are made of are kept too: a round adds the vectors that joined a cluster and subtracts those
that left it, and reads no others. A round's state is a table in the shared folder, written before the state before it
is removed: what an executor loses is computed again from the last table. Only centroids, sums and counts come to the driver, a number
of integers that `clusters` and the width bound. Vectors are never shuffled, so it does not matter how alike they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactlake.llm.scratch import Scratch
from pactlake.llm.vectors import floor_means, integers, lists, matrix, products, sound

_STATE = "vec_id long, x array<int>, dots array<long>, cluster int, distance long, was int, moved boolean"
_ROWS = 4096


def kept_vectors(vectors: DataFrame, width: int, scale: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x): vectors of `width` finite components, as integers."""
    rows = vectors.where(sound(F.col(vector).cast("array<double>")) & (F.size(vector) == width))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), integers(rows, vector, scale).alias("x"))


def first_centroids(kept: DataFrame, clusters: int, seed: int, width: int) -> np.ndarray:
    """The vectors with the least hashes of their ids, in the order of the hashes."""
    number = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(number.alias("number"), "x").orderBy("number", "x").limit(clusters).collect()
    return np.array([r["x"] for r in rows], np.int64).reshape(len(rows), width)


def updated(state: DataFrame, centroids: np.ndarray, before: np.ndarray) -> DataFrame:
    """The state after the centroids went from `before` to `centroids`: dot products updated by the components that changed, and the
    nearest centroid, the first among equals."""
    width = centroids.shape[1]
    change = centroids - before
    changed = [(c, np.flatnonzero(change[c])) for c in np.flatnonzero(change.any(axis=1)).tolist()]
    lengths = (centroids * centroids).sum(axis=1)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(begin, _ROWS)
                x, dots = matrix(batch.column(1), width), matrix(batch.column(2), len(centroids)).copy()
                for c, components in changed:
                    dots[:, c] += products(x[:, components], change[c, components][None, :])[:, 0]
                length = lengths - 2 * dots
                cluster = length.argmin(axis=1)
                distance = (x * x).sum(axis=1) + length[np.arange(len(x)), cluster]
                was = batch.column(3).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance),
                        pa.array(was, pa.int32()), pa.array(was != cluster),
                    ],
                    ["vec_id", "x", "dots", "cluster", "distance", "was", "moved"],
                )

    return state.select("vec_id", "x", "dots", "cluster").mapInArrow(assign, _STATE)


def transfers(state: DataFrame, clusters: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """By how much the last round's moves change the count and the component sums of every cluster."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(clusters, np.int64), np.zeros((clusters, width), np.int64)
        for batch in batches:
            x = matrix(batch.column(0), width)
            for column, sign in ((batch.column(1), 1), (batch.column(2), -1)):
                member = column.to_numpy()
                for c in np.unique(member[member >= 0]).tolist():
                    mine = x[member == c]
                    counts[c] += sign * len(mine)
                    sums[c] += sign * mine.sum(axis=0)
        some = np.flatnonzero(counts.astype(bool) | sums.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some]), lists(sums[some], pa.int64())], ["cluster", "n", "sums"]
        )

    parts = state.where("moved").select("x", "cluster", "was").mapInArrow(total, "cluster int, n long, sums array<long>")
    added = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(j))) for j in range(width)]).alias("sums"))
    counts, sums = np.zeros(clusters, np.int64), np.zeros((clusters, width), np.int64)
    for row in added.collect():
        counts[row["cluster"]], sums[row["cluster"]] = row["n"], row["sums"]
    return counts, sums


def cluster(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(assignments, centroids): a row per kept vector with vec_id, cluster and distance (squared Euclidean, integer), and
    the final centroids, a row each.

    Kept are vectors of exactly `width` components, none null or non-finite, a component x becoming floor(scale * x) (saturating at
    `vectors.LARGEST`). Centroids start as the kept vectors with the least sha256 of ``seed:vec_id`` (a null id is empty there,
    equal hashes go by vector); with fewer vectors there are fewer centroids. Each round assigns every vector to the nearest
    centroid, ties to the smaller number, and replaces each centroid that has vectors by their floored means; then vectors
    are assigned once more. A round that moves no centroid is the last, since all others would repeat it. Repeated rows
    count as often as they come, other columns are not read, an empty table gives no rows and no centroids.
    """
    with Scratch(vectors.sparkSession, "clusters") as scratch:
        kept = scratch.table(kept_vectors(vectors, width, scale, vec_id, vector))
        centroids = first_centroids(kept, clusters, seed, width)
        k = len(centroids)
        if not k:
            return scratch.result(kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))), centroids
        zeros = F.array_repeat(F.lit(0).cast("long"), k)
        state = kept.select("vec_id", "x", zeros.alias("dots"), F.lit(-1).alias("cluster"))
        before = np.zeros_like(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for _ in range(rounds):
            state = scratch.state(updated(state, centroids, before))
            added = transfers(state, k, width)
            counts, sums = counts + added[0], sums + added[1]
            before, centroids = centroids, floor_means(sums, counts, centroids)
            if (before == centroids).all():
                break
        final = updated(state, centroids, before).select("vec_id", "cluster", "distance")
        return scratch.result(final), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    """The sha256 of the components as decimal integers, joined by commas, in lower-case hex."""
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def described(assignments: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assignments with cluster_inertia and inertia, the distances summed over the cluster and over all, and
    centroid_sha256. What is joined has a row per cluster."""
    spark = assignments.sparkSession
    sizes = {r["cluster"]: r["d"] for r in assignments.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(c, sizes.get(c, 0), sum(sizes.values()), centroid_digest(x)) for c, x in enumerate(centroids)]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assignments.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
