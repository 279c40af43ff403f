"""Centroid clustering of whole-number vectors with a table of distances to fixed pivots.

The distances of every vector to a few pivots are stored once. In each round the distances of the centroids to the pivots
are new, and by the triangle inequality the difference of two distances to a pivot is never above the distance of vector
and centroid: the largest difference over the pivots bounds each centroid from below. The centroid with the lowest bound
is measured first; the others are measured only if their bound does not exceed what it gave. Measured distances are exact
whole numbers, bounds are rounded down, so the clusters are those of a full search.

Vectors stay where they are: a round reads the stored table once, and each task sends the sums of its clusters. Centroids
and pivots are ``k`` vectors each, whatever the number of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import saved

#: Distances that are stored for each vector.
PIVOTS = 12
#: Pairs of a vector and a centroid that are measured at a time.
PAIRS = 16_384
#: Differences of components stay below this, so that a squared distance fits a long.
WIDEST = 2**28


def whole_vectors(vectors: DataFrame, scale: int, offset: int = 0, size: int | None = None) -> DataFrame:
    """``vec_id, x``: floor(scale * c) + offset of each component ``c``, as double, of ``embedding``.

    Left out are vectors that are null, hold a null or a number that isn't finite or, if ``size`` is given, have another
    number of components.
    """
    parts = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    good = F.col("embedding").isNotNull() & F.forall(parts, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    if size is not None:
        good = good & (F.size("embedding") == size)
    # A later filter on ``x`` may be tried before this one, so bad vectors are not computed there either.
    whole = F.when(good, F.transform(parts, lambda c: F.floor(c * scale).cast("long") + F.lit(offset).cast("long")))
    return vectors.where(F.coalesce(good, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column whose lists all have ``size`` elements as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to those of ``b``, pair by pair."""
    apart = a - b
    if apart.size and max(int(apart.max()), -int(apart.min())) >= WIDEST:
        raise ValueError(f"components {WIDEST} or more apart: their squared distance may not fit a long")
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(starts: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Up to ``count`` different rows of ``starts``, each the one with the largest sum of distances to those before."""
    starts = np.unique(starts, axis=0)
    far, chosen = np.zeros(len(starts)), []
    at = 0
    while len(chosen) < min(count, len(starts)):
        chosen.append(at)
        far += np.sqrt(_squared(starts, starts[at][None, :]))
        far[chosen] = -1
        at = int(far.argmax())
    return starts[chosen]


def nearest(x: np.ndarray, stored: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest centroid of each row, the exact squared distance, and how many distances were measured.

    ``stored`` has the rows' distances to the pivots. Of equally near centroids the first counts.
    """
    rows, k = len(x), len(centroids)
    to_pivots = np.sqrt(np.stack([_squared(centroids, p[None, :]) for p in pivots], axis=1).astype(np.float64))
    bound = np.zeros((rows, k))
    for j in range(len(pivots)):
        np.maximum(bound, np.abs(stored[:, j, None] - to_pivots[None, :, j]), out=bound)
    # What rounding may have added goes off.
    bound -= 1e-12 * (stored.max(axis=1, initial=0)[:, None] + to_pivots.max(initial=0))
    first = bound.argmin(axis=1)
    known = np.full((rows, k), np.iinfo(np.int64).max)
    every = np.arange(rows)
    known[every, first] = _squared(x, centroids[first])
    least = np.sqrt(known[every, first].astype(np.float64)) * (1 + 1e-12)
    open_ended = bound <= least[:, None]
    open_ended[every, first] = False
    at, of = np.nonzero(open_ended)
    for low in range(0, len(at), PAIRS):
        a, c = at[low:low + PAIRS], of[low:low + PAIRS]
        known[a, c] = _squared(x[a], centroids[c])
    cluster = known.argmin(axis=1)
    return cluster, known[every, cluster], rows + len(at)


def _measured(pivots: np.ndarray):
    """Adds ``d``, the distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), pivots.shape[1])
            d = np.sqrt(np.stack([_squared(x, p[None, :]) for p in pivots], axis=1).astype(np.float64))
            ends = pa.array(np.arange(0, d.size + 1, len(pivots), dtype=np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(d.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("x"), lists], ["vec_id", "x", "d"])

    return run


def _tables(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return matrix(batch.column("x"), centroids.shape[1]), matrix(batch.column("d"), len(pivots))


def _sums(centroids: np.ndarray, pivots: np.ndarray):
    """A task's ``cluster, place, total, n`` over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, stored = _tables(batch, centroids, pivots)
            cluster, _, _ = nearest(x, stored, centroids, pivots)
            order = np.argsort(cluster, kind="stable")
            met, begin = np.unique(cluster[order], return_index=True)
            total[met] += np.add.reduceat(x[order], begin, axis=0)
            n += np.bincount(cluster, minlength=len(n))
        met = np.flatnonzero(n)
        size = centroids.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(met, size).astype(np.int32)), pa.array(np.tile(np.arange(size, dtype=np.int32), len(met))),
             pa.array(total[met].reshape(-1)), pa.array(np.repeat(n[met], size))], ["cluster", "place", "total", "n"])

    return run


def _assigned(centroids: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, stored = _tables(batch, centroids, pivots)
            cluster, distance, _ = nearest(x, stored, centroids, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                ["vec_id", "cluster", "distance"])

    return run


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after a round: floor(sum / count) of their vectors; those of empty clusters stay."""
    parts = table.mapInArrow(_sums(centroids, pivots), "cluster int, place int, total long, n long")
    whole = F.sum(F.col("total").cast("decimal(38,0)"))
    out = centroids.copy()
    # A row for each component of each centroid.
    for r in parts.groupBy("cluster", "place").agg(whole.alias("total"), F.sum("n").alias("n")).collect():
        out[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return out


def seeded(seed: int, vec_id: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")), 256)


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """``vec_id, cluster, distance`` of every row of ``vectors``, and ``cluster, centroid`` of the centroids at the end.

    ``vectors`` has ``vec_id`` and ``x``, arrays of long without nulls that are all as long, as ``whole_vectors`` makes
    them. The first centroids are the ``k`` vectors whose ``seed:vec_id`` has the smallest SHA-256, in that order, ties by
    components. A distance is squared.

    Nulls: a vector with a null id is assigned and moves its centroid, but is never a first one. Repeated rows count each
    for itself; equal vectors may start several centroids, of which those that get no vector stay where they are. With
    fewer vectors than ``k`` there are as many centroids; without any (with an id), no rows. Components must be less than
    2**28 apart, beyond that a ``ValueError`` is raised. Other columns are left out, whatever their names.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("x").cast("array<long>").alias("x"))
    first = rows.where("vec_id IS NOT NULL").orderBy(seeded(seed, F.col("vec_id")), "x").limit(k).collect()
    ends = "cluster int, centroid array<long>"
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), spark.createDataFrame([], ends)
    centroids = np.array([r["x"] for r in first], np.int64).reshape(len(first), -1)
    fixed = choose_pivots(centroids, pivots)
    table = saved(rows.mapInArrow(_measured(fixed), "vec_id long, x array<long>, d array<double>"))
    for _ in range(rounds):
        centroids = _moved(table, centroids, fixed)
    assigned = table.mapInArrow(_assigned(centroids, fixed), "vec_id long, cluster int, distance long")
    return saved(assigned), spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centroids)], ends)


def with_inertia(assigned: DataFrame, centroids: DataFrame) -> DataFrame:
    """``assigned`` with its cluster's and the whole ``inertia``, and the SHA-256 of its centroid's decimal components."""
    spark = assigned.sparkSession
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    told = [(r["cluster"], sums[r["cluster"]], sum(sums.values()),
             hashlib.sha256(",".join(map(str, r["centroid"])).encode()).hexdigest())
            for r in centroids.collect() if r["cluster"] in sums]
    few = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(few), "cluster").select("vec_id", *few.columns[:1], "distance", *few.columns[1:])
