import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.llm import topk


def brute(rows, k=10):
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    width = max(len(v) for _, v in fine)
    x = np.array([v + [0] * (width - len(v)) for _, v in fine], dtype=np.int64)
    assert (np.abs(x).astype(float) ** 2).sum(axis=1).max() < 2.0**62
    found = {}
    for i, q in zip((i for i, _ in fine), x, strict=True):
        if i % 100 == 0:
            found.setdefault(i, []).extend((-int(s), j) for s, (j, _) in zip(x @ q, fine, strict=True) if j != i)
    return sorted((i, r + 1, j, -s) for i, best in found.items() for r, (s, j) in enumerate(sorted(best)[:k]))


@pytest.fixture
def small(monkeypatch):
    """Blocks so small that a few hundred rows make several passes, parts and lanes."""
    for name, value in {"BLOCK": 16, "RANGE": 8, "QUERY_BYTES": 1024, "LEAST": 2, "MEETS": 8, "THIN": 2}.items():
        monkeypatch.setattr(topk, name, value)


def search(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    return topk.exact_top_k(df, F.col("vec_id") % 100 == 0)


def test_queries_are_not_broadcast(spark, small):
    """Copies of the queries for each block of vectors once were, which took the driver's memory."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.1, 8).tolist()) for i in range(3000)]
    found = search(spark, rows)
    assert sorted(map(tuple, found.collect())) == brute(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_lengths_repeats_and_equal_vectors(spark, small):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(0, 1, 6) * 0.99**i).tolist()) for i in range(900)]
    rows += [(2000 + i, [0.25] * 6) for i in range(700)] + [(100, [0.5] * 4), (100, [-2.0, 1.0]), (300, []), (777, [0.0] * 6), (777, [9.0] * 3)]
    assert sorted(map(tuple, search(spark, rows).collect())) == brute(rows)


def test_sums_beyond_floating_point(spark, small):
    """Long vectors, whose products only whole numbers hold, among short ones."""
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 5) * 10.0 ** rng.integers(-2, 6)).tolist()) for i in range(1200)]
    assert sorted(map(tuple, search(spark, rows).collect())) == brute(rows)
    kinds = [topk.exact_kind(a, b) for a, b in ((4000, 4000), (4100, 4100), (1e9, 0.0), (1e7, 1e10))]
    assert kinds == [np.float32, np.float64, np.float64, np.int64]


def test_searcher_equals_sorting():
    rng = np.random.default_rng(6)
    rows, turn = rng.integers(-40, 40, (640, 20)), np.linalg.qr(rng.normal(0, 1, (20, 20)))[0]
    rows[:, 3:] //= 20  # the leading dimensions tell most
    ids = rng.permutation(640)
    s = topk.Searcher(ids[:50], rows[:50], turn, 7)
    for at in range(0, 640, 64):
        s.feed(topk.Rows(ids[at : at + 64], rows[at : at + 64], turn))
    want = sorted((3, int(q), int(v), int(x)) for q, scores in zip(ids[:50], rows[:50] @ rows.T, strict=True) for x, v in sorted(((x, v) for x, v in zip(scores, ids, strict=True) if v != q), key=lambda p: (-p[0], p[1]))[:7])
    assert sorted(zip(*(c.to_pylist() for c in s.found(3).columns), strict=True)) == want
