"""Clustering around centroids with a pivot table (LAESA).

Distances of all vectors to a few fixed pivots, the centroids of the start, are
computed once and stored with the vectors. In each round only the centroids'
distances to the pivots are new: their difference to a vector's is a lower bound
of the vector's distance to the centroid, and a centroid whose bound is too large
is ruled out without looking at the vector. The centroids left get exact integer
distances. Vectors have integer components, so sums, means and distances are
exact and the same on every cluster. How many centroids are ruled out depends on
the data alone: in the first round all but one, later few where all distances
are about equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import staged

# Components up to this size keep every squared distance below 2**63.
LARGEST = 1 << 27

# Vectors that a task compares at one time.
ROWS = 2_048


def quantised(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and ``q``, the components as floor(scale * x), of the vectors
    with exactly ``dims`` components, none NULL or not finite. Components beyond
    2**27 have no exact distance and fail the job."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # NaN sorts above infinity
    q = F.transform(x, lambda v: F.floor(v * scale))
    fits = F.forall("q", lambda v: (v >= -LARGEST) & (v <= LARGEST))
    too_large = F.raise_error(F.lit(f"components beyond {LARGEST} after scaling")).cast("array<int>")
    kept = vectors.where((F.size("embedding") == dims) & finite).select(F.col("vec_id").cast("long"), q.alias("q"))
    return kept.select("vec_id", F.when(fits, F.col("q").cast("array<int>")).otherwise(too_large).alias("q"))


def by_hash(table: DataFrame, seed: int, n: int) -> np.ndarray:
    """The ``n`` vectors with the least hash of seed and id, in that order; equal
    ids go by their components. A NULL id hashes as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = table.orderBy(F.sha2(text, 256), "q").select("q").limit(n).collect()
    return np.array([r["q"] for r in rows], np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of all rows to a few points, rounded to double."""
    return np.sqrt(np.stack([squared(rows, p).astype(float) for p in points], axis=1))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def pivot_table(table: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``table`` with ``p``, the distances to the pivots."""
    dims = pivots.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
                p = distances(matrix(part.column("q"), dims).astype(np.int64), pivots)
                offsets = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["vec_id", "q", "p"])

    return table.mapInArrow(measure, "vec_id long, q array<int>, p array<double>")


def nearest(q: np.ndarray, p: np.ndarray, centroids: np.ndarray, centroid_p: np.ndarray) -> tuple:
    """(cluster, squared distance, number of exact distances) of each row. Ties
    go to the smaller number.

    The centroid with the least bound is measured first; those whose bound lies
    above that distance can be neither nearer nor equal. Bounds are doubles, so a
    margin far above their rounding error is left.
    """
    bound = np.zeros((len(q), len(centroids)))
    for i in range(p.shape[1]):
        np.maximum(bound, np.abs(p[:, i : i + 1] - centroid_p[:, i]), out=bound)
    first = bound.argmin(axis=1)
    reach = np.sqrt(squared(q, centroids[first]).astype(float))
    margin = 1e-9 * (1 + reach + p.max(axis=1))
    left = bound <= (reach + margin)[:, None]
    best, least = np.zeros(len(q), np.int64), np.full(len(q), np.iinfo(np.int64).max)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(left[:, number])
        exact = squared(q[rows], centroid)
        nearer = exact < least[rows]  # not where equal: the smaller number stays
        best[rows[nearer]], least[rows[nearer]] = number, exact[nearer]
    return best, least, left.sum(axis=1)


def assigned(batch: pa.RecordBatch, centroids: np.ndarray, centroid_p: np.ndarray) -> Iterator[tuple]:
    """(rows of the batch, their vectors, clusters, distances, exact distances)."""
    for part in (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS)):
        q = matrix(part.column("q"), centroids.shape[1]).astype(np.int64)
        yield part, q, *nearest(q, matrix(part.column("p"), centroid_p.shape[1]), centroids, centroid_p)


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round. A task adds up its vectors by cluster, so
    at most one number for each cluster and component leaves it; those are added
    in Spark, and clusters times components reach the driver."""
    k, dims = centroids.shape
    centroid_p = distances(centroids, pivots)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, q, cluster, _, _ in assigned(batch, centroids, centroid_p):
                np.add.at(total, cluster, q)
                count += np.bincount(cluster, minlength=k)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(seen, dims)),
                pa.array(np.tile(np.arange(dims), len(seen))),
                pa.array(np.repeat(count[seen], dims)),
                pa.array(total[seen].ravel()),
            ],
            names=["cluster", "part", "n", "s"],
        )

    parts = table.mapInArrow(sums, "cluster long, part long, n long, s long").groupBy("cluster", "part")
    after = centroids.copy()
    for r in parts.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        after[r["cluster"], r["part"]] = int(r["s"]) // r["n"]
    return after


OUT = "vec_id long, cluster int, distance long, n_exact int"


def placed(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """Every vector's cluster and squared distance."""
    centroid_p = distances(centroids, pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, cluster, distance, exact in assigned(batch, centroids, centroid_p):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id"),
                        pa.array(cluster.astype(np.int32)),
                        pa.array(distance),
                        pa.array(exact.astype(np.int32)),
                    ],
                    names=["vec_id", "cluster", "distance", "n_exact"],
                )

    return table.mapInArrow(place, OUT)


def centroid_hash(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    vectors: DataFrame,
    *,
    k: int = 40,
    rounds: int = 5,
    dims: int = 64,
    scale: int = 256,
    seed: int = 2,
) -> DataFrame:
    """One row per kept vector (see :func:`quantised`): ``vec_id``, ``cluster``,
    ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``
    and ``n_exact``, the exact distances that the last round needed for it.

    Centroids start as the ``k`` vectors of least hash; each round moves the
    non-empty ones to the floor of their vectors' mean, empty ones stay. Ties go
    to the smaller number, repeated rows each count and each get a row. Fewer
    vectors than ``k`` give as many centroids, none give no rows. No other column
    is read.
    """
    spark = vectors.sparkSession
    table = quantised(vectors, dims, scale)
    start = by_hash(table, seed, k)
    if not len(start):
        empty = spark.createDataFrame([], OUT)
        return empty.selectExpr(
            "vec_id", "cluster", "distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256", "n_exact"
        )
    table, centroids = staged(pivot_table(table, start), "pivots"), start
    for _ in range(rounds):
        centroids = moved(table, centroids, start)
    out = staged(placed(table, centroids, start), "clusters")
    # One row per cluster, so it is bounded by k.
    sums = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r["s"]) for r in sums)
    known = spark.createDataFrame(
        [(r["cluster"], int(r["s"]), total, centroid_hash(centroids[r["cluster"]])) for r in sums],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return out.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "n_exact"
    )
