"""MaxScore search against all products."""

import math
import random

import pytest

from millrace.llm import topk


def brute(queries, rows, k):
    def ints(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    vectors = [(i, ints(v)) for i, v in rows if i is not None and ints(v) is not None]
    own = {}
    for i, v in queries:
        if i is not None and ints(v) is not None:
            own[i] = min(own.get(i, ints(v)), ints(v))
    out = []
    for q, x in own.items():
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q)[:k]
        out += [(q, rank + 1, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, queries, rows, **options):
    schema = "vec_id long, embedding array<double>"
    a = spark.createDataFrame(queries, schema).selectExpr("*", "1 as id", "2 as v", "3 as score")
    b = spark.createDataFrame(rows, schema).selectExpr("*", "1 as id", "2 as v", "3 as score")
    return sorted(tuple(r) for r in topk.top_k(a, b, **options).collect())


def vectors(seed, n, width):
    pick = random.Random(seed)
    return [(i, [round(pick.gauss(0, 0.2), 3) if pick.random() < 0.8 else 0.0 for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("shard,tile,block", [(8192, 256, 4096), (64, 3, 4)])
def test_same_as_all_products(spark, monkeypatch, shard, tile, block):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "_TILE", tile)
    rows = vectors(1, 400, 24)
    queries = rows[::20] + [(1000, [0.5] * 24)]
    assert found(spark, queries, rows, k=7, block=block) == brute(queries, rows, 7)


def test_ties_and_copies(spark):
    rows = [(i, [0.1, 0.2, -0.3]) for i in range(150)] + [(200 + i, [0.1, 0.2, -0.3]) for i in range(3)] + [(200, [1.0, 1.0, 1.0])]
    queries = [rows[0], rows[5], (200, [0.1, 0.2, -0.3]), (200, [1.0, 1.0, 1.0]), (300, [0.0, 0.0, 0.0])]
    assert found(spark, queries, rows) == brute(queries, rows, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, []), (6, [1.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, [-1.0, -2.0])]
    assert found(spark, rows, rows, k=3) == brute(rows, rows, 3)


def test_fewer_than_k_and_negative_scores(spark):
    rows = [(i, [-float(i), 1.0]) for i in range(5)]
    queries = [(2, [5.0, -1.0])]
    assert found(spark, queries, rows) == brute(queries, rows, 10)


def test_values_beyond_exact_floats(spark):
    rows = [(i, [2.0**40 + i, 2.0**41, 1.0]) for i in range(30)] + [(99, [2.0**62, 0.0, 0.0])]
    rows = [(i, [x / 1024 for x in v]) for i, v in rows]
    queries = [(0, [1.0, 1e-3, 3.0]), (500, [2.0**20 / 1024, 7.0, 0.1])]
    assert found(spark, queries, rows) == brute(queries, rows, 10)


def test_empty_tables(spark):
    rows = vectors(2, 5, 3)
    assert found(spark, [], rows) == [] and found(spark, rows, []) == []
