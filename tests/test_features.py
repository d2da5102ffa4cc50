import math
import random
from dataclasses import replace
from datetime import datetime

import pytest
from panel_helpers import as_dict, hours, panel

from gridpulse.functions.calendar import aliased, calendar_features
from gridpulse.operators import features, forecast
from gridpulse.operators.prepare import densify
from gridpulse.sources.panels import PANEL
from pyspark.sql import functions as F

SMALL = replace(PANEL, max_lag=6, step=2)

# Hour in UTC-5 -> (sine, cosine).
HOUR_TABLE = {
    0: (0, 1), 1: (0.2588, 0.9659), 2: (0.5, 0.866), 3: (0.7071, 0.7071), 4: (0.866, 0.5),
    5: (0.9659, 0.2588), 6: (1, 0), 7: (0.9659, -0.2588), 8: (0.866, -0.5), 9: (0.7071, -0.7071),
    10: (0.5, -0.866), 11: (0.2588, -0.9659), 12: (0, -1), 13: (-0.2588, -0.9659),
    14: (-0.5, -0.866), 15: (-0.7071, -0.7071), 16: (-0.866, -0.5), 17: (-0.9659, -0.2588),
    18: (-1, 0), 19: (-0.9659, 0.2588), 20: (-0.866, 0.5), 21: (-0.7071, 0.7071),
    22: (-0.5, 0.866), 23: (-0.2588, 0.9659),
}


def brute_lags(rows, n):
    out = {}
    for series in {s for s, _, _ in rows}:
        own = sorted((h, v) for s, h, v in rows if s == series)
        for i, (h, _) in enumerate(own):
            lags = [own[i - k][1] if i >= k else None for k in range(n, 0, -1)]
            if None not in lags:
                out[(series, hours(h))] = [float(v) for v in lags]
    return out


def holey_rows(seed, null=0.0):
    rng = random.Random(seed)
    return [
        (f"s{s}", h, None if rng.random() < null else rng.randrange(1000))
        for s in range(3)
        for h in range(150)
        if rng.random() < (0.15 if 40 < h < 100 else 0.9)
    ]


@pytest.mark.parametrize("block_rows", [1, 10, 4096])
@pytest.mark.parametrize("null", [0.05])
def test_lags_are_by_row_across_holes_and_blocks(spark, block_rows, null):
    rows = holey_rows(block_rows, null)
    spec = replace(SMALL, block_rows=block_rows)
    lagged = features.lag_features(panel(spark, rows).repartition(7), spec).collect()
    got = {(r["series"], r["ts"]): [r[name] for name in spec.lag_names] for r in lagged}
    assert len(lagged) == len(got)
    assert got == brute_lags(rows, spec.max_lag)


@pytest.mark.parametrize("block_rows", [4, 10])
def test_gap_free_path_equals_general_path(spark, block_rows):
    spec = replace(SMALL, block_rows=block_rows)
    dense = densify(panel(spark, holey_rows(5)), spec, fill=True).cache()
    general = features.feature_frame(dense, spec)
    direct = features.feature_frame(dense, spec, gap_free=True)
    assert general.count() == direct.count() == dense.count() - 3 * spec.max_lag
    assert general.exceptAll(direct).isEmpty()


def test_column_order_and_trailing_means(spark):
    rows = [("a", h, (h * 37) % 101) for h in range(60)]
    frame = features.feature_frame(panel(spark, rows), PANEL)
    assert len(frame.columns) == 49
    assert frame.columns[:8] == [
        "series", "ts", "sine_hour", "cosine_hour", "is_morning", "is_afternoon", "is_evening",
        "is_night",
    ]
    assert frame.columns[8:16] == [f"avg_{k}_lags" for k in range(32, 0, -4)]
    assert frame.columns[16:] == [*[f"lag_{k}" for k in range(32, 0, -1)], "y"]
    for row in frame.collect():
        for k in PANEL.mean_sizes:
            expected = sum(row[f"lag_{i}"] for i in range(1, k + 1)) / k
            assert math.isclose(row[f"avg_{k}_lags"], expected, rel_tol=1e-12)


@pytest.mark.parametrize("n,expected", [(1, 0), (32, 0), (33, 1)])
def test_short_series(spark, n, expected):
    rows = [("a", h, h) for h in range(n)]
    assert features.feature_frame(panel(spark, rows), PANEL).count() == expected


def test_null_label_is_kept_null_lag_is_not(spark):
    rows = [("a", h, None if h == 6 else h) for h in range(14)]
    frame = as_dict(features.feature_frame(panel(spark, rows), SMALL))
    assert frame == {("a", hours(6)): None, ("a", hours(13)): 13.0}


def test_calendar(spark):
    df = spark.range(24).select(
        F.expr("timestampadd(HOUR, cast(id as int) + 5, timestamp_ntz'2025-07-01')").alias("ts"), "id"
    )
    for row in df.selectExpr("*", *aliased(calendar_features("ts", "EST"))).collect():
        hour = row["id"]
        assert (row["sine_hour"], row["cosine_hour"]) == HOUR_TABLE[hour]
        flags = [row[c] for c in ("is_morning", "is_afternoon", "is_evening", "is_night")]
        part = 0 if 5 <= hour < 12 else 1 if 12 <= hour < 17 else 2 if 17 <= hour < 21 else 3
        assert flags == [i == part for i in range(4)]


def test_unknown_hour_is_night(spark):
    row = (
        spark.sql("select cast(null as timestamp_ntz) as ts")
        .selectExpr(*aliased(calendar_features("ts", "EST")))
        .first()
    )
    assert row["is_night"] and not (row["is_morning"] or row["is_afternoon"] or row["is_evening"])


def test_no_daylight_saving(spark):
    df = spark.createDataFrame([(datetime(2025, 7, 1, 3),)], "ts TIMESTAMP_NTZ")
    row = features.with_hour_encoding(df, PANEL).first()
    assert (row["sine_hour"], row["cosine_hour"]) == HOUR_TABLE[22]


def test_next_step_features_equal_the_next_feature_row(spark):
    rows = [(f"s{s}", h, (h * 31 + s * 17) % 89) for s in range(2) for h in range(70)]
    frame = features.feature_frame(panel(spark, rows), PANEL).cache()
    shifted = forecast.next_step_features(frame, PANEL)
    matched = shifted.alias("n").join(frame.alias("f"), PANEL.key)
    assert matched.count() == 2 * (70 - 32 - 1)
    for row in matched.select("n.*", F.struct("f.*").alias("f")).collect():
        for name in PANEL.feature_names:
            assert row[name] == pytest.approx(row["f"][name], abs=1e-9), name


@pytest.mark.parametrize("n", [1, 5])
def test_recent_feature_rows(spark, n):
    rows = [(f"s{s}", h, (h * 31 + s * 17) % 89) for s in range(2) for h in range(40 + s)]
    spec = replace(SMALL, block_rows=7)
    whole = features.feature_frame(panel(spark, rows), spec)
    recent = features.recent_feature_rows(panel(spark, rows), spec, n)
    assert recent.count() == 2 * n
    assert recent.exceptAll(features.latest_per_series(whole, spec, n)).isEmpty()


def test_features_need_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "dense")
    panel(spark, [("a", h, h) for h in range(50)]).write.parquet(path)
    frame = features.feature_frame(spark.read.parquet(path), PANEL, gap_free=True)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "Python" not in plan
