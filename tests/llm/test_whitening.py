"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from tests.conftest import SMALL
from tidewater.llm import queries
from tidewater.llm.centroid_clustering import whole_vectors
from tidewater.llm.whitening import whiten


def dense(rows, components):
    x = np.array([v for _, v in rows], np.float64)
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    order = np.argsort(-values)[:components]
    return centred @ axes[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def compare(rows, got, components):
    whitened, explained = dense(rows, components)
    n, sums = len(rows), [sum(c) for c in zip(*(v for _, v in rows), strict=True)]
    deviation = {i: sum((n * x - s) ** 2 for x, s in zip(v, sums, strict=True)) for i, v in rows}
    at = {i: k for k, (i, _) in enumerate(rows)}
    assert len(got) == n * components and {g["n"] for g in got} == {n}
    turned = {}
    for g in got:
        c = g["component"] - 1
        expected = whitened[at[g["vec_id"]], c]
        if abs(expected) > 1e-3:
            turned.setdefault(c, set()).add(np.sign(expected * g["whitened"]))
        assert abs(abs(expected) - abs(g["whitened"])) < 1e-8
        assert g["deviation"] == deviation[g["vec_id"]] and g["identity_error"] < 1e-9
        assert abs(g["explained"] / explained[c] - 1) < 1e-9
    assert all(len(signs) == 1 for signs in turned.values())


@pytest.mark.parametrize("far", [0, 10**6, 10**9])
def test_against_dense(spark, far):
    r = np.random.default_rng(3)
    x = (r.normal(size=(300, 9)) * 100 / np.arange(1, 10)).astype(int) + far
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame([(*v, "q", 1) for v in rows], "vec_id long, x array<long>, d string, part int")
    compare(rows, whiten(df.repartition(5), 9).collect(), 9)


def test_equal_eigenvalues_and_constant_entries(spark):
    rows = []
    for axis in range(4):
        for sign in (1, -1):
            rows.append((len(rows), [7, *[10 * sign * (k == axis) for k in range(4)], 3]))
    rows += [(len(rows), [7, 0, 0, 0, 0, 3])]
    df = spark.createDataFrame(rows, "vec_id long, x array<long>")
    got = whiten(df).collect()
    assert len(got) == 4 * len(rows) and all(abs(g["explained"] - 0.25) < 1e-12 for g in got)
    assert max(g["identity_error"] for g in got) < 1e-12
    by = {}
    for g in got:
        by.setdefault(g["vec_id"], []).append(g["whitened"])
    # Any basis of equal eigenvalues leaves the lengths as they are.
    assert all(abs(sum(w * w for w in ws) - (4.5 if i < 8 else 0)) < 1e-9 for i, ws in by.items())


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, -3.0]), (3, None), (4, [nan, 0.0]), (5, [inf, 0.0]), (6, [None, 1.0]),
            (7, [1.0]), (8, []), (None, [0.0, 1.0])]
    df = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, n int")
    whole = whole_vectors(df, 64, 1_000_000)
    got = whiten(whole).collect()
    assert len(got) == 8 and {g["n"] for g in got} == {4} and sum(g["vec_id"] is None for g in got) == 2
    assert whiten(whole.limit(0)).collect() == [] and whiten(whole.where("vec_id = 1")).collect() == []


def test_query(spark):
    got = queries.REGISTERED["op12_embedding_whitening"][0](spark, SMALL).collect()
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], [int(np.floor(64 * float(c))) + 1_000_000 for c in r["embedding"]]) for r in table.collect()]
    compare(rows, got, 32)
