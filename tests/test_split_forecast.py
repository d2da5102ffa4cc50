from dataclasses import replace
from datetime import timedelta

import pytest
from panel_helpers import as_dict, hours, panel
from pyspark.sql import functions as F

from gridpulse.operators import evaluate, features, forecast, quality, split
from gridpulse.sources.panels import PANEL

SMALL = replace(PANEL, max_lag=6, step=2, block_rows=10)

# Number of distinct hours -> indexes of train ends and fold ends, k = 5.
FOLDS = {
    305: ([87, 129, 170, 212, 254], [104, 154, 204, 254, 304]),
    689: ([194, 289, 384, 479, 574], [232, 346, 460, 574, 688]),
    12: ([3, 5, 6, 8, 10], [3, 5, 7, 9, 11]),
    4: ([3] * 5, [3] * 5),
}


@pytest.mark.parametrize("n", FOLDS)
def test_fold_boundaries(spark, n):
    rows = [(s, h, 1) for s in ("a", "b") for h in range(n)]
    folds = split.fold_boundaries(panel(spark, rows), replace(PANEL, block_rows=50), 5)
    got = folds.orderBy("fold").collect()
    train, ends = FOLDS[n]
    assert [r["fold"] for r in got] == [1, 2, 3, 4, 5]
    assert [r["train_end"] for r in got] == [hours(i) for i in train]
    assert [r["fold_end"] for r in got] == [hours(i) for i in ends]


def test_fold_membership(spark):
    df = panel(spark, [("a", h, h) for h in range(60)])
    folds = split.fold_boundaries(df, PANEL, 5)
    members = split.fold_membership(df, folds, PANEL).collect()
    for f in folds.collect():
        own = [r for r in members if r["fold"] == f["fold"]]
        train = {r["ts"] for r in own if r["role"] == "train"}
        validation = {r["ts"] for r in own if r["role"] == "validation"}
        assert max(train) == f["train_end"] < min(validation)
        assert max(validation) == f["fold_end"]
        assert len(own) == len(train | validation)
    one = split.fold_membership_one_series(
        df.unionByName(panel(spark, [("b", 500, 1)])), PANEL, "a", 5
    )
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, members))


def test_trailing_window_is_inclusive_and_per_series(spark):
    rows = [("a", h, h) for h in range(400)] + [("old", h, h) for h in range(-900, -880)]
    result = split.trailing_window(panel(spark, rows), replace(PANEL, block_rows=24))
    counts = {r["series"]: r["count"] for r in result.groupBy("series").count().collect()}
    assert counts == {"a": 337, "old": 20}


def test_holdout_split(spark):
    rows = [(s, h, h) for s, n in (("a", 10), ("b", 4)) for h in range(n)]
    train, test = split.holdout_split(panel(spark, rows), SMALL, 3)
    assert {k[1] for k in as_dict(test) if k[0] == "a"} == {hours(h) for h in (7, 8, 9)}
    assert {k[1] for k in as_dict(train) if k[0] == "b"} == {hours(0)}
    assert train.count() + test.count() == len(rows)


def mean_of_last_4(df):
    return df.withColumn("yhat", F.expr("(lag_1 + lag_2 + lag_3 + lag_4) / 4"))


def test_recursion_golden(spark):
    frame = panel(spark, [("a", 6, 6)]).withColumns(
        {f"lag_{k}": F.lit(float(6 - k)) for k in range(1, 7)}
    )
    steps = forecast.multi_step_forecast(frame, mean_of_last_4, SMALL, 3).orderBy("ts").collect()
    assert [r["forecast"] for r in steps] == [4.5, 4.875, 5.0938]
    assert [r["ts"] for r in steps] == [hours(7), hours(8), hours(9)]
    assert [steps[2][f"lag_{k}"] for k in range(6, 0, -1)] == [3.0, 4.0, 5.0, 6.0, 4.5, 4.875]
    one = forecast.one_step_forecast(frame, mean_of_last_4, SMALL).collect()
    zero = forecast.multi_step_forecast(frame, mean_of_last_4, SMALL, 0).collect()
    assert one == zero == steps[:1]


def test_long_horizon_passes_through_checkpoints(spark):
    rows = [(s, h, (h * 7) % 13) for s in ("a", "b") for h in range(20)]
    frame = features.feature_frame(panel(spark, rows), SMALL).cache()
    horizon = forecast.STEPS_PER_PLAN + 3
    steps = forecast.multi_step_forecast(frame, mean_of_last_4, SMALL, horizon)
    assert steps.count() == 2 * horizon
    values = [float((h * 7) % 13) for h in range(20)]
    for _ in range(horizon):
        values.append(sum(values[-4:]) / 4)
    got = as_dict(steps, "forecast")
    for i in range(horizon):
        assert got[("a", hours(20 + i))] == pytest.approx(values[20 + i], abs=1e-3)


def test_forecast_is_floored_and_null_stays_null(spark):
    rows = [("a", h, h) for h in range(7)]
    frame = features.feature_frame(panel(spark, rows), SMALL)
    below = forecast.one_step_forecast(frame, lambda d: d.withColumn("yhat", F.lit(-3.0)), SMALL)
    assert below.first()["forecast"] == 0.0
    none = forecast.expression_predictor(F.lit(None).cast("double"))
    assert forecast.one_step_forecast(frame, none, SMALL).first()["forecast"] is None


def test_latest_rank_is_pushed_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "rows")
    panel(spark, [("a", h, h) for h in range(9)]).write.parquet(path)
    latest = features.latest_per_series(spark.read.parquet(path), PANEL)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.first()["y"] == 8.0


def test_persistence(spark):
    rows = [("a", h, h) for h in range(10)] + [("b", h, 2 * h) for h in range(5)]
    train, test = split.holdout_split(panel(spark, rows), SMALL, 2)
    naive = as_dict(forecast.persistence_forecast(train, test, SMALL), "naive_forecast")
    assert naive == {
        ("a", hours(8)): 7.0, ("a", hours(9)): 7.0, ("b", hours(3)): 4.0, ("b", hours(4)): 4.0,
    }


@pytest.mark.parametrize(
    "y,f,r2,rmse",
    [
        ([10, 20, 30, 40], [12, 18, 33, 39], 0.964, 2.1213),
        ([10, 20, 30, 40], [40] * 4, -1.8, 18.7083),
        ([1, 2, 3], [2, 4, 5], -3.5, 1.7321),
        ([5, 5], [4, 6], None, 1.0),
    ],
)
def test_metrics(spark, y, f, r2, rmse):
    df = spark.createDataFrame(
        [(float(a), float(b)) for a, b in zip(y, f, strict=True)], "y DOUBLE, f DOUBLE"
    )
    row = evaluate.evaluation_metrics(df, "y", "f").first()
    assert (row["r2"], row["rmse"]) == (r2, rmse)


@pytest.mark.parametrize("holes", [False, True])
def test_stacked_backtest_equals_separate_ones(spark, holes):
    rows = [
        (s, h, (h * k) % 23 + h / 10)
        for s, k in (("a", 7), ("b", 5), ("c", 3))
        for h in range(40)
        if not (holes and s == "b" and h in (31, 34, 35))
    ]
    frame = features.feature_frame(panel(spark, rows), SMALL).cache()
    got = {
        r["horizon"]: r for r in evaluate.backtest_report(frame, mean_of_last_4, SMALL, 5).collect()
    }
    assert sorted(got) == [1, 2, 3, 4, 5]
    for n in range(1, 6):
        train, test = split.holdout_split(frame, SMALL, n)
        model = forecast.multi_step_forecast(train, mean_of_last_4, SMALL, n)
        naive = forecast.persistence_forecast(train, test, SMALL)
        joined = naive.join(model.select(*SMALL.key, "forecast"), SMALL.key)
        expected = evaluate.evaluation_metrics(joined, "y", "forecast").first()
        expected_naive = evaluate.evaluation_metrics(joined, "y", "naive_forecast").first()
        assert (got[n]["r2"], got[n]["rmse"]) == (expected["r2"], expected["rmse"])
        assert got[n]["naive_r2"] == expected_naive["r2"]


@pytest.mark.parametrize(
    "rows,passed",
    [
        ([(0.9, 0.5), (0.85, 0.4)], True),
        ([(0.9, 0.5), (0.8, 0.4)], False),
        ([(0.9, 0.95), (0.9, 0.95)], False),
        ([(0.9, 0.1), (None, 0.1)], False),
    ],
)
def test_gate(spark, rows, passed):
    report = spark.createDataFrame(rows, "r2 DOUBLE, naive_r2 DOUBLE")
    assert evaluate.backtest_gate(report).first()["passed"] is passed


def test_quality_report_counts(spark):
    rows = [("a", 0, 1), ("a", 0, 1), ("a", 0, 2), ("a", 3, None), ("b", 0, float("nan"))]
    report = quality.quality_report(panel(spark, rows), PANEL).first().asDict()
    assert report == {
        "rows": 5, "null_series": 0, "null_times": 0, "null_targets": 1, "nan_targets": 1,
        "duplicate_rows": 2, "duplicate_keys": 3, "missing_slots": 2,
    }


def test_assert_quality(spark):
    good = panel(spark, [("a", 0, 1), ("a", 1, float("nan"))])
    assert quality.assert_quality(good, PANEL, PANEL.series_schema) is good
    with pytest.raises(quality.QualityError, match="duplicate"):
        quality.assert_quality(panel(spark, [("a", 0, 1), ("a", 0, 1)]), PANEL)
    with pytest.raises(quality.QualityError, match="null"):
        quality.assert_quality(panel(spark, [("a", 0, None)]), PANEL)
    with pytest.raises(quality.QualityError, match="schema"):
        other = good.withColumn("y", F.col("y").cast("float"))
        quality.assert_quality(other, PANEL, PANEL.series_schema)


def test_empty_panel_report(spark):
    report = quality.quality_report(panel(spark, []), PANEL).first()
    assert set(report.asDict().values()) == {0}


def test_spec_checks():
    with pytest.raises(ValueError):
        replace(PANEL, every=timedelta(0))
    assert replace(PANEL, max_lag=10, step=4).mean_sizes == [8, 4]
