import math
import random
from dataclasses import replace

import numpy as np
import pytest
from panel_helpers import panel

from gridpulse.operators import analysis
from gridpulse.sources.panels import PANEL


def yule_walker_pacf(values, nlags):
    x = np.asarray(values, float) - np.mean(values)
    r = [float((x[: len(x) - k] * x[k:]).sum() / len(x)) for k in range(nlags + 1)]
    out = [1.0]
    for k in range(1, nlags + 1):
        matrix = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        out.append(float(np.linalg.solve(matrix, np.array(r[1 : k + 1]))[-1]))
    return out


def by_lag(df, value):
    out = {}
    for r in df.collect():
        out.setdefault(r["series"], {})[r["lag"]] = r[value]
    return out


def test_pacf_golden(spark):
    df = panel(spark, [("a", i, v) for i, v in enumerate([1, 3, 2, 5, 4, 6, 5, 8])])
    got = by_lag(analysis.partial_autocorrelation(df, PANEL, nlags=3), "pacf")["a"]
    assert [got[k] for k in range(4)] == pytest.approx([1, 0.244718, 0.374513, -0.415771], abs=1e-6)


@pytest.mark.parametrize("block_rows,gap_free", [(16, False), (40, True)])
def test_pacf_equals_direct_solution(spark, block_rows, gap_free):
    rng = random.Random(3)
    series = {}
    for name, weight in (("a", 0.8), ("b", -0.5)):
        values = [1000.0]
        for _ in range(199):
            values.append(1000 + weight * (values[-1] - 1000) + rng.gauss(0, 5))
        series[name] = values
    rows = [(s, h, v) for s, values in series.items() for h, v in enumerate(values)]
    spec = replace(PANEL, block_rows=block_rows)
    got = by_lag(
        analysis.partial_autocorrelation(panel(spark, rows), spec, 30, gap_free), "pacf"
    )
    for name, values in series.items():
        assert [got[name][k] for k in range(31)] == pytest.approx(
            yule_walker_pacf(values, 30), abs=1e-9
        )


def test_constant_series_has_no_correlation(spark):
    df = panel(spark, [("a", h, 5) for h in range(40)] + [("b", h, h % 2) for h in range(40)])
    acf = by_lag(analysis.autocorrelation(df, PANEL, 4), "acf")
    assert set(acf["a"].values()) == {None}
    assert acf["b"][0] == 1.0
    assert analysis.suggested_max_lag(df, replace(PANEL, step=1), 4).first()["max_lag"] >= 1


@pytest.mark.parametrize("lag,expected", [(30, 32), (26, 24), (10, 8), (6, 8), (2, 0)])
def test_rounding_of_the_suggested_lag(spark, monkeypatch, lag, expected):
    strong = spark.createDataFrame([("a", lag, 0.5), ("a", lag + 1, 0.01)], "series STRING, lag INT, pacf DOUBLE")
    monkeypatch.setattr(analysis, "partial_autocorrelation", lambda *args: strong)
    assert analysis.suggested_max_lag(strong, PANEL).first()["max_lag"] == expected


def test_mutual_information_and_selection(spark):
    rng = random.Random(1)
    rows = []
    for _ in range(400):
        y = rng.random()
        rows.append((y, y * 3 + rng.random() * 0.1, rng.random(), y > 0.5, 1.0))
    names = ["close", "noise", "flag", "constant"]
    frame = spark.createDataFrame(
        rows, "y DOUBLE, close DOUBLE, noise DOUBLE, flag BOOLEAN, constant DOUBLE"
    ).repartition(6)
    bins = 8

    def cut(values):
        lo, hi = min(values), max(values)
        return [
            0 if hi == lo else min(bins - 1, math.floor((v - lo) / (hi - lo) * bins)) for v in values
        ]

    def direct(xs, ys):
        n, total = len(xs), 0.0
        for a in set(xs):
            for b in set(ys):
                c = sum(1 for x, y in zip(xs, ys, strict=True) if (x, y) == (a, b))
                if c:
                    total += c / n * math.log(c * n / (xs.count(a) * ys.count(b)))
        return total

    y_bins = cut([r[0] for r in rows])
    expected = {
        name: direct(cut([float(r[i]) for r in rows]), y_bins) for i, name in enumerate(names, 1)
    }
    scores = analysis.mutual_information(frame, names, "y", bins)
    got = {r["feature"]: r for r in scores.collect()}
    for name in names:
        assert got[name]["mi"] == pytest.approx(expected[name], abs=1e-9)
    assert got["close"]["score"] == 1.0 and got["constant"]["score"] == 0.0
    assert analysis.select_features(frame, names, "y", 0.5, bins) == ["close", "flag"]
    assert analysis.select_features(frame, names, "y", 0.0, bins) == names
