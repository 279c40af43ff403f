"""Top-k search against all inner products."""

import random

import pytest

from tidewater.llm.topk_search import top_k, whole_numbers


def brute(rows, queries, k):
    out = []
    for q, a in {(i, tuple(v)) for i, v in queries}:
        out += [(q, i, sum(x * y for x, y in zip(a, v, strict=True))) for i, v in rows if i != q and len(v) == len(a)]
    best = {}
    for q, i, s in out:
        best[q, i] = max(s, best.get((q, i), s))
    found = []
    for q in {q for q, _ in best}:
        own = sorted((-s, i) for (p, i), s in best.items() if p == q)[:k]
        found += [(q, n, i, -s) for n, (s, i) in enumerate(own, 1)]
    return sorted(found)


@pytest.mark.parametrize("big", [1, 10**7, 10**8])
def test_against_brute_force(spark, big):
    r = random.Random(5)
    rows = [(i, [r.randint(-9, 9) * big for _ in range(r.choice([7, 7, 7, 3]))]) for i in range(300)]
    rows += [(i + 1000, rows[4][1]) for i in range(40)] + [rows[3], rows[3], (5, rows[6][1])]
    df = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = top_k(df, df.where("vec_id % 20 = 0"), k=5, slices=3, block_vectors=64, block_queries=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, [x for x in rows if x[0] % 20 == 0], 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.5, -0.001]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]), (5, [])]
    df = spark.createDataFrame([(*x, "q") for x in rows], "vec_id long, embedding array<double>, v string")
    whole = whole_numbers(df)
    assert sorted(map(tuple, whole.where("vec_id IS NOT NULL").collect())) == [(0, [256, 512]), (1, [128, -1]), (5, [])]
    assert list(map(tuple, top_k(whole, whole.where("vec_id = 0")).collect())) == [(0, 1, 1, 256 * 128 - 512)]
    assert top_k(whole.limit(0), whole.limit(0)).collect() == []
