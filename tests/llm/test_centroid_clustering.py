"""Clusters against a full search in plain integers."""

import hashlib
import random

import numpy as np
import pytest

from tests.oracle import connect, differences
from tidewater.llm import oracles, queries
from tidewater.llm.centroid_clustering import choose_pivots, cluster, nearest, whole_vectors, with_inertia
from tests.conftest import SMALL


def brute(rows, k, rounds, seed):
    def first(row):
        return hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest(), row[1]

    centroids = [r[1] for r in sorted((r for r in rows if r[0] is not None), key=first)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids)) for _, v in rows]

    for _ in range(rounds):
        near = assign()
        for i in range(len(centroids)):
            own = [rows[n][1] for n, (_, c) in enumerate(near) if c == i]
            if own:
                centroids[i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return sorted(((r[0], c, d) for r, (d, c) in zip(rows, assign(), strict=True)), key=repr), centroids


@pytest.mark.parametrize("spread", [3, 400])
def test_against_full_search(spark, spread):
    r = random.Random(spread)
    rows = [(i, [r.randint(-spread, spread) + 900 * (i % 4) for _ in range(5)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [rows[3], rows[3], (None, rows[5][1]), (None, [0] * 5)]
    df = spark.createDataFrame([(*x, "q", 1) for x in rows], "vec_id long, x array<long>, d string, cluster int")
    got, ends = cluster(df.repartition(7), k=12, rounds=3)
    expected, centroids = brute(rows, 12, 3, 2)
    assert sorted(map(tuple, got.collect()), key=repr) == expected
    assert [c["centroid"] for c in sorted(ends.collect())] == centroids
    told = with_inertia(got, ends).collect()
    assert {t["inertia"] for t in told} == {sum(d for _, _, d in expected)} and len(told) == len(rows)
    for t in told:
        assert t["cluster_inertia"] == sum(d for _, c, d in expected if c == t["cluster"])


def test_bounds_spare_measurements():
    r = np.random.default_rng(1)
    centres = r.integers(-5000, 5000, (20, 8))
    x = (centres[r.integers(0, 20, 3000)] + r.integers(-50, 50, (3000, 8))).astype(np.int64)
    pivots = choose_pivots(centres)
    stored = np.sqrt(((x[:, None, :] - pivots[None]) ** 2).sum(axis=2))
    cluster_of, distance, measured = nearest(x, stored, centres, pivots)
    full = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (cluster_of == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert measured < 0.2 * full.size


def test_few_and_odd_rows(spark):
    nan = float("nan")
    rows = [(1, [0.5, 0.5]), (2, None), (3, [nan, 1.0]), (4, [None, 1.0]), (5, [1.0]), (6, []), (None, [0.25, -0.001])]
    df = spark.createDataFrame([(*x, 1) for x in rows], "vec_id long, embedding array<double>, x int")
    whole = whole_vectors(df, 256, size=2)
    assert sorted(map(tuple, whole.collect()), key=repr) == [(1, [128, 128]), (None, [64, -1])]
    got, ends = cluster(whole, k=40, rounds=2)
    assert {r["vec_id"]: r["cluster"] for r in got.collect()} == {1: 0, None: 0}
    assert [r["centroid"] for r in ends.collect()] == [[96, 63]]
    none, ends = cluster(whole.limit(0))
    assert with_inertia(none, ends).collect() == [] and ends.collect() == []


def test_query(spark):
    df = queries.REGISTERED["op11_centroid_clustering"][0](spark, SMALL)
    assert differences(df, connect(SMALL), oracles.CLUSTERS) == ""
