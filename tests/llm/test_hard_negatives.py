"""Operator 11 against a brute-force ranking."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import as_rows
from refillscope.llm import hard_negatives as hn

SCHEMA = "vec_id long, label int, embedding array<float>"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute_force(rows, step=100):
    whole = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        own = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        whole[i] = min(whole.get(i, own), own)
    out = []
    for a, (label, v) in whole.items():
        if a % step:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other != label) for i, (other, w) in whole.items() if i != a)
        for s, p, _ in [x for x in scored if not x[2]][:5]:
            inside = [(t, n) for t, n, differs in scored if differs and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, k, n, -s, -t) for k, (t, n) in enumerate(inside, 1)]
    return sorted(out, key=repr)


def mined(spark, rows, step=100, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return as_rows(hn.mine_hard_negatives(df, F.expr(f"vec_id % {step} = 0"), **options), *COLUMNS)


def vectors(seed, count, dims, labels=3, near=0.5):
    """Random vectors, some of them close to an earlier one, with ties."""
    rng, rows = random.Random(seed), []
    for i in range(count):
        if rows and rng.random() < near:
            v = [x + rng.choice([0, 0, 0.05, -0.05]) for x in rng.choice(rows)[2]]
        else:
            v = [rng.uniform(-1, 1) for _ in range(dims)]
        rows.append((i, rng.randrange(labels), v))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = vectors(seed, 400, 6)
    want = brute_force(rows, 10)
    assert want and mined(spark, rows, 10) == want


def test_many_blocks_of_anchors_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_BYTES", 16)  # 16 anchors a block
    monkeypatch.setattr(hn, "MAX_PIVOTS", 3)
    rows = vectors(3, 300, 4)
    assert mined(spark, rows, 3) == brute_force(rows, 3)


def test_a_third_of_rows_with_one_vector(spark):
    rows = vectors(4, 200, 5) + [(i, i % 2, [0.5, 0.25, 0.0, 0.0, 1.0]) for i in range(200, 300)]
    assert mined(spark, rows, 20) == brute_force(rows, 20)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [0.9, 0.1]), (2, 2, [0.8, 0.0]), (3, 2, [0.85, 0.0]), (4, None, [1.0, 0.0]), (5, 2, None),
        (6, 2, [None, 1.0]), (7, 2, [nan, 1.0]), (8, 2, [inf, 0.0]), (None, 2, [0.85, 0.0]), (9, 2, []), (10, 2, [0.84]),
        (2, 2, [0.8, 0.0]), (3, 3, [9.0, 0.0]), (100, 7, [1e30, 0.0]), (200, 8, [-1.0, 0.0]), (11, 8, [1.0, 0.0]),
    ]
    kept = [r for r in rows if r[0] != 100]  # too large for a score in 64 bits
    want = brute_force(kept)
    assert [r[3] for r in want if r[0] == 0] == [3, 10, 2] and mined(spark, rows) == want
    assert mined(spark, []) == [] and mined(spark, [(0, 1, [1.0])]) == [] and mined(spark, [(1, 1, [1.0]), (2, 1, [1.0])]) == []
    large = [(i, i % 2, [float(2**21 + 3 * i), 1.0]) for i in range(30)]  # products beyond 2**53
    assert mined(spark, large, 10) == brute_force(large, 10)
    clash = spark.createDataFrame(kept, SCHEMA).selectExpr("*", "1 as block", "2 as kind", "3 as anchor", "4 as tree", "5 as vector")
    assert as_rows(hn.mine_hard_negatives(clash, F.expr("vec_id % 100 = 0")), *COLUMNS) == want


def test_spanning_tree_is_minimal():
    points = np.random.default_rng(5).integers(-50, 50, (40, 3))
    order, parent, edge = hn.spanning_tree(points)
    away = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    left, total = {0}, 0.0
    while len(left) < 40:
        i, j = min(((i, j) for i in left for j in set(range(40)) - left), key=lambda p: away[p])
        left.add(j)
        total += away[i, j]
    assert math.isclose(edge.sum(), total) and sorted(order) == list(range(40))
    seen = set()
    for a in order:
        assert parent[a] < 0 or parent[a] in seen
        seen.add(a)
