"""Exact top-k search by inner product: three phases with a uniform threshold.

Every vector is cut into ``slices`` of its components. A slice has, for each query, the list of its partial scores over
all vectors; the lists are spread over blocks of vectors.

1. Each block and slice gives the ``k`` best partial scores of each query. The vectors seen are scored in full; the
   query's ``k``-th best full score ``t`` is a safe cutoff: the result has no lower score.
2. A vector that reaches ``t`` reaches ``t / slices`` in some slice. Each block gives all vectors that do; the known
   partial scores and ``t / slices`` for the others bound the total, and entries that can't reach ``t`` go.
3. What remains is scored in full, and the best ``k`` are the result.

The stated query set meets all rows, in blocks: queries are packed into blocks, and each block of vectors is sent once
for each block of queries. A task holds two blocks and one matrix of their scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import saved

SCALE = 256
#: Vectors and queries of a block; a matrix of scores has so many cells.
BLOCK_VECTORS, BLOCK_QUERIES = 4096, 1024


def whole_numbers(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(256 * x) of each component; rows with a null or a component that isn't finite are left out."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    good = F.col(vector).isNotNull() & F.forall(parts, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return vectors.where(good).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(parts, lambda x: F.floor(x * SCALE).cast("long")).alias("v"))


def _packed(rows: DataFrame, size: int, prefix: str) -> DataFrame:
    """``dim, {prefix}block, {prefix}ids, {prefix}vs``: blocks of about ``size`` rows with as many components."""
    counted = rows.groupBy(F.size("v").alias("dim")).agg(F.ceil(F.count("*") / size).alias("blocks"))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks"))
    # Few rows: as many as there are numbers of components.
    keyed = rows.withColumn("dim", F.size("v")).join(counted, "dim").withColumn(f"{prefix}block", block)
    return keyed.groupBy("dim", f"{prefix}block").agg(
        F.collect_list(F.struct("vec_id", "v")).alias(f"{prefix}rows"))


def _matrix(rows: list, dim: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.fromiter((r["vec_id"] for r in rows), np.int64, len(rows))
    return ids, np.array([r["v"] for r in rows], np.int64).reshape(len(rows), dim)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point while all sums are below 2**53, else by integers."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _edges(dim: int, slices: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, dim, min(slices, max(1, dim)) + 1).astype(int)
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _found(q_ids, ids, rows, columns, total) -> pd.DataFrame:
    return pd.DataFrame({"query_id": q_ids[rows], "vec_id": ids[columns], "score": total[rows, columns]})


def _first_phase(k: int, slices: int):
    """The full scores of every vector that is among a slice's best ``k`` of its block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                (q_ids, q), (ids, v) = _matrix(r.q_rows, r.dim), _matrix(r.v_rows, r.dim)
                seen = np.zeros((len(q_ids), len(ids)), bool)
                own = q_ids[:, None] == ids[None, :]
                for low, high in _edges(r.dim, slices):
                    part = _scores(q[:, low:high], v[:, low:high])
                    part[own] = np.iinfo(np.int64).min
                    best = np.argpartition(part, -k, axis=1)[:, -k:] if len(ids) > k else np.arange(len(ids))[None, :]
                    np.put_along_axis(seen, np.broadcast_to(best, (len(q_ids), best.shape[1])), True, axis=1)
                rows, columns = np.nonzero(seen & ~own)
                total = np.einsum("ij,ij->i", q[rows], v[columns])
                out = pd.DataFrame({"query_id": q_ids[rows], "vec_id": ids[columns], "score": total})
                yield out.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby(
                    "query_id").head(k)

    return run


def _second_phase(slices: int):
    """Entries of the slices' lists at or above the uniform threshold whose bound reaches the cutoff, scored in full."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                (q_ids, q), (ids, v) = _matrix(r.q_rows, r.dim), _matrix(r.v_rows, r.dim)
                known = {c["query_id"]: c["cutoff"] for c in r.cutoffs}
                least = np.iinfo(np.int64).min // 4
                cutoff = np.array([known.get(i, least) for i in q_ids.tolist()], np.int64)
                edges = _edges(r.dim, slices)
                share = cutoff // len(edges)  # rounded down: never above the exact share
                bound, entered = np.zeros((len(q_ids), len(ids)), np.int64), np.zeros((len(q_ids), len(ids)), bool)
                for low, high in edges:
                    part = _scores(q[:, low:high], v[:, low:high])
                    listed = part >= share[:, None]
                    entered |= listed
                    bound += np.where(listed, part, share[:, None] + 1)
                open_ended = (cutoff == least)[:, None]
                rows, columns = np.nonzero(
                    (entered & (bound >= cutoff[:, None]) | open_ended) & (q_ids[:, None] != ids[None, :]))
                total = np.einsum("ij,ij->i", q[rows], v[columns])
                enough = total >= cutoff[rows]
                yield pd.DataFrame({"query_id": q_ids[rows[enough]], "vec_id": ids[columns[enough]],
                                    "score": total[enough]})

    return run


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, slices: int = 2,
    block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best of ``vectors`` but those with its own id.

    Both inputs have ``vec_id`` and ``v`` (array of long), as ``whole_numbers`` makes them. Ties go to the smaller id.

    Scores must fit a long. Nulls: rows with a null id or vector take no part. Vectors meet queries with as many components. Rows that repeat an
    id count once if they are equal; an id with several vectors keeps them all as candidates and as queries, and ranks
    their scores together. Fewer candidates than ``k`` are all returned; empty tables give no rows.
    """
    usable = "vec_id IS NOT NULL AND v IS NOT NULL"
    rows = vectors.where(usable).select("vec_id", "v").distinct()
    asked = queries.where(usable).select("vec_id", "v").distinct()
    v_blocks, q_blocks = saved(_packed(rows, block_vectors, "v_")), saved(_packed(asked, block_queries, "q_"))
    # Which blocks meet is a list of numbers; rows are dealt out by the pair of blocks, a number of tasks that Spark keeps.
    key = ["dim", "v_block", "q_block"]
    which = saved(v_blocks.select("dim", "v_block").join(q_blocks.select("dim", "q_block"), "dim"))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = v_blocks.join(which, ["dim", "v_block"]).repartition(tasks, *key).join(
        q_blocks.join(which, ["dim", "q_block"]), key)
    schema = "query_id long, vec_id long, score long"
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # An id may stand for several vectors, so the cutoff counts ids, not rows.
    first = pairs.select("dim", "q_rows", "v_rows").mapInPandas(_first_phase(k, slices), schema).groupBy(
        "query_id", "vec_id").agg(F.max("score").alias("score"))
    cutoffs = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select(
        "query_id", F.col("score").alias("cutoff"))
    of_block = q_blocks.select("dim", "q_block", F.explode("q_rows.vec_id").alias("query_id")).join(
        cutoffs, "query_id").groupBy("dim", "q_block").agg(F.collect_list(F.struct("query_id", "cutoff")).alias("c"))
    empty = F.array().cast("array<struct<query_id:bigint,cutoff:bigint>>")
    known = pairs.join(of_block, ["dim", "q_block"], "left").select(
        "dim", "q_rows", "v_rows", F.coalesce("c", empty).alias("cutoffs"))
    last = known.mapInPandas(_second_phase(slices), schema).groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"))
    return last.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
