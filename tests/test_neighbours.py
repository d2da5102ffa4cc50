import math
import random

import numpy as np
import pytest

from gridpulse.operators.analysis import selected_features
from gridpulse.operators.neighbours import GRID, neighbour_information


def digamma(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def brute(xs, ys, k):
    pairs = [(x, y) for x, y in zip(xs, ys, strict=True) if x is not None and y is not None and x == x and y == y]
    n = len(pairs)
    if n <= k:
        return None

    def on_grid(values, every):
        every = [v for v in every if v is not None]
        scale = np.std(every)
        return np.array([math.floor(v / scale * GRID + 0.5) if scale else 0 for v in values], np.int64)

    x, y = on_grid([p[0] for p in pairs], xs), on_grid([p[1] for p in pairs], ys)
    total = 0.0
    for i in range(n):
        d = np.maximum(abs(x - x[i]), abs(y - y[i]))
        others = np.sort(np.delete(d, i))
        eps = others[k - 1]
        kth = k if eps else int((others == 0).sum())
        near = [int((abs(v - v[i]) < max(eps, 1)).sum()) for v in (x, y)]
        total += digamma(kth) - digamma(near[0]) - digamma(near[1])
    return max(0.0, digamma(n) + total / n)


def columns(seed, n):
    rng = random.Random(seed)
    y = [round(rng.gauss(50, 9), 2) for _ in range(n)]
    return {
        "same": list(y),
        "noisy": [v + rng.gauss(0, 2) for v in y],
        "apart": [rng.gauss(0, 1) for _ in range(n)],
        "two": [float(v > 50) for v in y],
        "hour": [float(i % 24) for i in range(n)],
        "flat": [3.0] * n,
        "far": [rng.gauss(0, 1) * (1e4 if rng.random() < 0.02 else 1) for _ in range(n)],
        "nulls": [None if rng.random() < 0.3 else v for v in y],
        "y": y,
    }


@pytest.mark.parametrize("slab_rows, max_slabs, k", [(4096, 2048, 3), (17, 2048, 3), (1, 9, 1), (50, 2048, 5)])
def test_equals_brute_force(spark, slab_rows, max_slabs, k):
    data = columns(slab_rows, 260)
    names = [c for c in data if c != "y"]
    df = spark.createDataFrame(list(zip(*data.values(), strict=True)), ", ".join(f"`{c}` DOUBLE" for c in data)).repartition(3)
    got = {r["feature"]: r["mi"] for r in neighbour_information(df, names, "y", k, slab_rows, max_slabs).collect()}
    assert set(got) == set(names)
    for name in names:
        assert got[name] == pytest.approx(brute(data[name], data["y"], k), abs=1e-9), name
    assert got["same"] > got["noisy"] > got["apart"] and got["flat"] < 0.1


def test_a_third_of_all_rows_at_one_point(spark):
    rng = random.Random(4)
    rows = [(5.0, 7.0)] * 150 + [(5.0, rng.random()) for _ in range(100)] + [(rng.random(), rng.random()) for _ in range(150)]
    df = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE")
    (got,) = neighbour_information(df, ["x"], "y", 3, slab_rows=20).collect()
    assert got["mi"] == pytest.approx(brute([r[0] for r in rows], [r[1] for r in rows], 3), abs=1e-9)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, 4.0), (3.0, None, 1.0), (4.0, float("nan"), 1.0)], "a DOUBLE, b DOUBLE, y DOUBLE")
    assert neighbour_information(df, ["a", "b"], "y", 3).collect() == []
    assert neighbour_information(df.limit(0), ["a", "b"], "y", 3).collect() == []


def test_scores_choose_features(spark):
    data = columns(8, 200)
    df = spark.createDataFrame(list(zip(*data.values(), strict=True)), ", ".join(f"`{c}` DOUBLE" for c in data))
    scores = neighbour_information(df, ["same", "noisy", "apart", "flat"], "y")
    assert {r["feature"] for r in selected_features(scores, 0.7).collect()} == {"same", "noisy"}
