import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op11_negatives as hn

SCHEMA = "vec_id long, vector array<long>, label int, uid string, `a.b c` int"


def brute(rows, positives=5, negatives=5):
    own = [(k, i, v, y) for k, (i, v, y) in enumerate(rows)
           if v is not None and y is not None and None not in v]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda i: (i is None, i or 0)
    out = []
    for k, i, v, y in own:
        if i is None or i % 100:
            continue
        scored = sorted(((dot(v, w), j, z) for m, j, w, z in own if m != k), key=lambda x: (-x[0], last(x[1])))
        for p, j, _ in [x for x in scored if x[2] == y][:positives]:
            fit = [x for x in scored if x[2] != y and 80 * p <= 100 * x[0] <= 100 * p][:negatives]
            out += [(i, j, r, n, p, s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, y, "u", 1) for i, v, y in rows], SCHEMA)
    return sorted(map(tuple, hn.mine(hn.build_index(df, F.col("vec_id") % 100 == 0), **kw).collect()), key=str)


def vectors(seed, n, dims, labels=3, spread=60):
    rnd = random.Random(seed)
    middle = [[rnd.randint(-spread, spread) for _ in range(dims)] for _ in range(6)]
    return [(k * 10, [x + rnd.randint(-20, 20) for x in rnd.choice(middle)], rnd.randrange(labels)) for k in range(n)]


@pytest.mark.parametrize("dims", [1, 7, 64])
def test_equals_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 40)
    monkeypatch.setattr(hn, "ANCHORS", 6)
    rows = vectors(dims, 150, dims)
    found = run(spark, rows)
    assert found == brute(rows) and (dims == 1 or found)


def test_nulls_ties_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(hn, "ROWS", 16)
    rows = vectors(5, 60, 8)
    rows += [(None, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2] + 1), (5, None, 1), (6, [1, None], 1),
             (7, [1, 2], None), (8, [], 0), (9, [3], 1), (200, [0] * 8, 0), rows[0], rows[0], rows[10], rows[10]]
    rows += [(1000 + k, rows[0][1], k % 2) for k in range(30)]  # one vector many times
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, positives=2, negatives=1) == brute(rows, 2, 1)


def test_large_components_are_exact(spark):
    rnd = random.Random(1)
    big = [(k * 50, [hn.LARGEST - rnd.randrange(9) for _ in range(16)], k % 2) for k in range(20)]
    assert run(spark, big) == brute(big)


def test_empty(spark):
    assert run(spark, []) == []


def test_integer_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, [float("nan")]), (3, [float("inf")]), (4, [None]), (5, None), (6, [])],
                               "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["vector"] for r in hn.integer_vectors(df).collect()}
    assert got == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_bounds_hold_and_rule_rows_out():
    rnd = np.random.default_rng(0)
    x, y = rnd.integers(-300, 300, (50, 64)).astype(float), rnd.integers(-300, 300, (70, 64)).astype(float)
    exact, width = x @ y.T, []
    for a, b in zip(hn.summaries(x), hn.summaries(y)):
        low, high = hn.bounds(a, b)
        assert (low <= exact).all() and (exact <= high).all()
        width.append((high - low).mean())
    assert width == sorted(width, reverse=True)  # finer segments bound more closely
