"""Exact top-k against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, row string, cell int, score int"


def brute(rows, k, scale):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in good if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, k=4, scale=64.0, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k, scale=scale, **how).collect())


def clustered(seed, n=400, centres=6, dim=5, noise=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim)) * 3
    return [(i, (middle[i % centres] + noise * rng.normal(size=dim)).tolist(), 0, "", 0, 0) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"pivots": 1}, {"pivots": 9, "block_rows": 200, "block_queries": 10}, {"sample": 3}])
def test_against_all_pairs(spark, how):
    rows = clustered(1)
    assert found(spark, rows, **how) == brute(rows, 4, 64.0)


def test_bounds_leave_rows_out_without_losing_any(spark, monkeypatch):
    """Opposite far groups: a group of queries must not get the rows of the other ones."""
    rows = [(i, [(100.0 if i % 2 else -100.0) + random.Random(i).random(), 1.0], 0, "", 0, 0) for i in range(300)]
    centres = np.array([[6400.0, 64.0], [-6400.0, 64.0]])
    near = [np.linspace(0, 5, 5)] * 2
    enough = topk.reached(centres, np.array([70.0, 70.0]), near, 4)
    far = centres[1] @ centres[0] + 70 * np.linalg.norm(centres[1])
    assert (enough > far).all()
    assert found(spark, rows, pivots=2) == brute(rows, 4, 64.0)


def test_one_vector_is_a_third_of_all_rows(spark):
    rows = clustered(2, n=300) + [(1000 + i, [3.0, 3.0, 3.0, 3.0, 3.0], 0, "", 0, 0) for i in range(150)]
    assert found(spark, rows, k=20, block_rows=300, block_queries=20) == brute(rows, 20, 64.0)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (20, [1.0, 2.0], 0, "", 0, 0), (40, [1.0], 0, "", 0, 0), (60, [], 0, "", 0, 0), (80, None, 0, "", 0, 0), (100, [1.0, None], 0, "", 0, 0),
        (120, [nan, 1.0], 0, "", 0, 0), (140, [1.0, -inf], 0, "", 0, 0), (None, [9.0, 9.0], 0, "", 0, 0),
        (1, [0.0, 0.0], 0, "", 0, 0), (2, [-0.5, 0.01], 0, "", 0, 0), (3, [-0.5, 0.01], 0, "", 0, 0), (-20, [5.0, -5.0], 0, "", 0, 0),
    ]
    assert found(spark, rows) == brute([(i, v and v + [0.0] * (2 - len(v)) if v is not None and None not in v else v) for i, v, *_ in rows if v != []] + [(60, [0.0, 0.0])], 4, 64.0)


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = [(0, [1.0], 0, "", 0, 0), (1, [2.0], 0, "", 0, 0)]
    assert found(spark, rows) == [(0, 1, 1, 64 * 128)]
    assert found(spark, rows[:1]) == []
    assert found(spark, []) == []


def test_repeated_rows(spark):
    rows = [(20, [1.0], 0, "", 0, 0)] * 2 + [(7, [3.0], 0, "", 0, 0)] * 3
    assert found(spark, rows) == sorted([(20, n, 7, 64 * 192) for n in (1, 2, 3)] * 2)


def test_numbers_too_large_for_doubles(spark):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(-(2**52), 2**52) / 64 * 64, rng.random() * 2.0**rng.randrange(1, 70)], 0, "", 0, 0) for i in range(60)]
    assert found(spark, rows) == brute(rows, 4, 64.0)
