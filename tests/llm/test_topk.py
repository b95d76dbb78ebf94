import math
import random

import pytest
from pyspark.sql import functions as F

from rivalry.llm import topk

SCHEMA = "vec_id long, embedding array<double>, row long, vec string, score int"


def made(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k, step):
    """Sorted results by scoring all pairs in whole numbers."""
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, q) in enumerate(usable):
        if i is None or i % step:
            continue
        found = [
            (-sum(x * y for x, y in zip(q, c)), j is None, j)
            for b, (j, c) in enumerate(usable)
            if b != a
        ]
        out += [(i, n + 1, j, -s) for n, (s, _, j) in enumerate(sorted(found, key=str_key)[:k])]
    return sorted(out, key=str)


def str_key(item):
    score, missing, j = item
    return score, missing, j or 0


def got(df, k, step, **more):
    found = topk.top_k(df, F.col("vec_id") % step == 0, k, **more)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("bins", [2, 512])
def test_all_pairs(spark, monkeypatch, bins):
    pick = random.Random(5)
    rows = [(i, [pick.gauss(0, 0.3) for _ in range(8)]) for i in range(700)]
    # a third of all rows are one vector, so that many scores tie at the kth value
    rows += [(1000 + i, rows[3][1]) for i in range(350)]
    pick.shuffle(rows)
    monkeypatch.setattr(topk, "LEAST", 100)
    assert got(made(spark, rows), 5, 10, bins=bins) == brute(rows, 5, 10)


def test_blocks_of_queries(spark, monkeypatch):
    pick = random.Random(6)
    rows = [(i, [pick.choice([-1.0, 0.0, 0.5]) for _ in range(6)]) for i in range(300)]
    monkeypatch.setattr(topk, "LEAST", 50)
    monkeypatch.setattr(topk, "QUERIES", 20)
    monkeypatch.setattr(topk, "SCORES", 600)
    monkeypatch.setattr(topk, "ROWS", 90)
    assert got(made(spark, rows), 3, 2) == brute(rows, 3, 2)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.5]),
        (0, [1.0, 0.5]),
        (None, [0.3, 0.1]),
        (None, [0.3, 0.1]),
        (50, None),
        (100, [float("nan"), 1.0]),
        (150, [None, 1.0]),
        (200, [float("inf"), 1.0]),
        (250, []),
        (300, [0.25]),
        (7, [0.1, 0.2, 0.3]),
    ]
    assert got(made(spark, rows), 5, 50) == brute(rows, 5, 50)
    assert got(made(spark, [(0, [1.0])]), 5, 50) == []
    assert got(made(spark, []), 5, 50) == []
    assert got(made(spark, [(0, [1.0]), (1, [2.0])]), 5, 50) == [(0, 1, 1, 256 * 512)]


def test_large_numbers(spark):
    rows = [(i, [1e5 * (i + 1), -7e4 * i, 1e5 / (i + 1)]) for i in range(60)]
    assert got(made(spark, rows), 4, 10) == brute(rows, 4, 10)
    # beyond a long: the nearest long
    rows = [(0, [1e18]), (1, [1e17]), (2, [-1e18]), (3, [1e300])]
    assert [(r[1], r[3]) for r in got(made(spark, rows), 3, 50)] == [
        (1, 2**63 - 1),
        (2, 2**63 - 1),
        (3, -(2**63)),
    ]
