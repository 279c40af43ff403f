"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

For the matrix X of centred rows the two recurrences ``a u = X v - b u'`` and ``b v = X^T u - a v'`` give orthonormal
vectors and an upper bidiagonal matrix with X's singular values. Each product runs over all rows where they lie and
returns sums as long as a vector. Every new ``u`` is made orthogonal to all before it, and so is every new ``v``.

A ``u`` has an element for each row, so it is never stored: it is X times a short vector ``c`` that the recurrence gives,
and a task that needs its rows of all ``u`` so far multiplies its rows by the ``c`` so far. The driver holds matrices of
side ``d``, the length of a vector, as the covariance is. All ``d`` steps are taken, so that equal eigenvalues come with
all their components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.centroid_clustering import matrix
from tidewater.llm.common import saved

COMPONENTS = 32
#: Against the largest singular value, what counts as zero.
NOTHING = 1e-11

OUT = "vec_id long, component int, deviation decimal(38,0), whitened double, explained double"


class Centred:
    """Rows and their exact mean: ``sums / n``."""

    def __init__(self, rows: DataFrame, n: int, sums: list[int]):
        self.rows, self.n, self.sums = rows, n, np.array(sums, np.int64)

    def exact(self):
        """A function from a batch to the whole numbers ``n * x - sums``; divided by ``n`` they are the centred rows."""
        n, sums = self.n, self.sums
        return lambda batch: n * matrix(batch.column("x"), len(sums)) - sums

    def total(self, part: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum over all rows of ``part``, which turns some centred rows into ``size`` numbers."""
        exact, n = self.exact(), self.n

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(size)
            for batch in batches:
                out += part(exact(batch) / n)
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.list_(pa.float64()))], ["part"])

        # One row from each task; the sums are combined in tasks and only ``size`` numbers reach the driver.
        parts = self.rows.mapInArrow(run, "part array<double>")
        if size <= 200:
            found = parts.agg(F.array(*[F.sum(F.col("part")[i]) for i in range(size)]).alias("s")).first()["s"]
            return np.array([0.0 if s is None else s for s in found])
        out = np.zeros(size)
        for at, s in parts.select(F.posexplode("part")).groupBy("pos").agg(F.sum("col")).collect():
            out[at] = s
        return out


def centred(vectors: DataFrame) -> Centred | None:
    """The vectors of the commonest length (of equally common ones, the longest) with their sums; None without any."""
    sized = vectors.where("x IS NOT NULL AND size(x) > 0").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("x").cast("array<long>").alias("x"))
    common = sized.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    rows = saved(sized.where(F.size("x") == common["d"]))
    whole = [F.sum(F.element_at("x", i + 1).cast("decimal(38,0)")) for i in range(common["d"])]
    sums = rows.agg(F.array(*whole).alias("s")).first()["s"]
    return Centred(rows, common["count"], [int(s) for s in sums])


def _fresh(basis: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """A unit vector orthogonal to the columns of ``basis``, which are fewer than their length."""
    v = random.standard_normal(len(basis))
    for _ in range(3):
        v -= basis @ (basis.T @ v)
        v /= np.linalg.norm(v)
    return v


def bidiagonalise(data: Centred) -> tuple[np.ndarray, np.ndarray]:
    """``V`` and the upper bidiagonal ``B`` with ``X V = U B``; both have the side ``d``."""
    d = len(data.sums)
    random = np.random.default_rng(7)
    v_all, c_all, b = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, d))
    v, beta, largest = _fresh(v_all, random), 0.0, 0.0
    for j in range(d):
        v_all = np.column_stack([v_all, v])
        c = v - beta * c_all[:, j - 1] if j else v
        if j:
            def against(x, c=c, c_all=c_all):
                return (x @ c_all).T @ (x @ c)

            c = c - c_all @ data.total(against, j)

        def both(x, c=c):
            w = x @ c
            return np.concatenate([[w @ w], w @ x])

        found = data.total(both, d + 1)
        alpha = float(np.sqrt(max(0.0, found[0])))
        largest = max(largest, alpha, beta)
        if alpha > NOTHING * largest:
            b[j, j], c, z = alpha, c / alpha, found[1:] / alpha - alpha * v
        else:  # X v lies in the span of the earlier u
            c, z = np.zeros(d), np.zeros(d)
        c_all = np.column_stack([c_all, c])
        if j + 1 == d:
            break
        for _ in range(2):
            z = z - v_all @ (v_all.T @ z)
        beta = float(np.linalg.norm(z))
        if beta > NOTHING * largest:
            b[j, j + 1], v = beta, z / beta
        else:  # the span is invariant: go on outside
            beta, v = 0.0, _fresh(v_all, random)
    return v_all, b


def _exact_squares(apart: np.ndarray) -> pa.Array:
    """The sum of squares of each row of whole numbers, exact."""
    most = max(int(apart.max(initial=0)), -int(apart.min(initial=0)))
    if most * most * max(1, apart.shape[1]) < 2**63:
        return pa.array(np.einsum("ij,ij->i", apart, apart)).cast(pa.decimal128(38, 0))
    wide = apart.astype(object)
    return pa.array([int(s) for s in (wide * wide).sum(axis=1)], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for each vector and component.

    ``vectors`` has ``vec_id`` and ``x`` (arrays of long without nulls); ``n`` is their number, ``deviation`` the exact sum
    over the components of ``(n * x - sum of x) ** 2``, ``whitened`` the centred vector along the unit eigenvector
    ``component`` of the covariance, over the root of its eigenvalue, and ``explained`` that eigenvalue's share of all.
    Eigenvectors come by falling eigenvalue from 1 on, with their largest element positive. ``identity_error`` is the
    largest difference between the covariance of ``whitened`` and the identity.

    Nulls: a null id stays null; a null or empty vector gives no rows. Vectors of another length than the commonest are
    left out. Repeated rows count each for itself. Components without variance can't be whitened and have no rows, so
    equal vectors only, or no vectors, give none. Other columns are left out, whatever their names.
    """
    spark = vectors.sparkSession
    nothing = spark.createDataFrame([], OUT).withColumn("n", F.lit(0).cast("long")).withColumn(
        "identity_error", F.lit(0.0))
    order = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    data = centred(vectors)
    if data is None:
        return nothing.select(*order)
    v, b = bidiagonalise(data)
    _, sigma, turned = np.linalg.svd(b)
    axes = v @ turned.T
    keep = min(components, int((sigma > NOTHING * max(sigma.max(), 1e-300)).sum()))
    if not keep or not sigma.max():
        return nothing.select(*order)
    axes, values = axes[:, :keep], sigma[:keep] ** 2 / data.n
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(keep)])
    spread = float((sigma**2).sum() / data.n)
    scaled, shares = axes / np.sqrt(values), values / spread

    def moments(x):
        w = x @ scaled
        return np.concatenate([(w.T @ w).reshape(-1), w.sum(axis=0)])

    sums = data.total(moments, keep * keep + keep) / data.n
    mean = sums[keep * keep:]
    error = float(np.abs(sums[:keep * keep].reshape(keep, keep) - np.outer(mean, mean) - np.eye(keep)).max())
    exact, n = data.exact(), data.n

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, share = np.arange(1, keep + 1, dtype=np.int32), shares
        for batch in batches:
            apart = exact(batch)
            own = pa.array(np.repeat(np.arange(batch.num_rows), keep))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(own), pa.array(np.tile(number, batch.num_rows)),
                 _exact_squares(apart).take(own), pa.array((apart / n @ scaled).reshape(-1)),
                 pa.array(np.tile(share, batch.num_rows))],
                ["vec_id", "component", "deviation", "whitened", "explained"])

    return data.rows.mapInArrow(rows, OUT).withColumn("n", F.lit(n).cast("long")).withColumn(
        "identity_error", F.lit(error)).select(*order)
