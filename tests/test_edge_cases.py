"""Inputs at the edge of an operator's promise: null and NaN cells, holes, off-grid rows, redelivery."""

import math
from dataclasses import replace
from datetime import timedelta

import pytest
from panel_helpers import HOUR, T0, as_dict, hours, panel
from pyspark import StorageLevel
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from gridpulse.operators import analysis, backfill, evaluate, features, modeling, quality
from gridpulse.operators.upsert import high_watermarks
from gridpulse.plans import jobs
from gridpulse.plans.queries import REGISTRY
from gridpulse.sources.panels import PANEL
from gridpulse.sources.tables import append_series, read_table
from gridpulse.streaming.ingest import append_above_watermark

SMALL = replace(PANEL, max_lag=6, step=2, lookback=timedelta(hours=48))


def last_value(df):
    return df.withColumn("yhat", F.col("lag_1"))


@pytest.fixture
def tables(tmp_path):
    return jobs.Tables(*[str(tmp_path / n) for n in ("raw", "processed", "forecasts", "model", "lineage")])


def test_a_missing_forecast_leaves_no_score(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None), (100.0, None)], "y DOUBLE, f DOUBLE")
    assert tuple(evaluate.evaluation_metrics(rows, "y", "f").first()) == (None, None)
    unlabelled = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (None, 5.0)], "y DOUBLE, f DOUBLE")
    assert tuple(evaluate.evaluation_metrics(unlabelled, "y", "f").first()) == (1.0, 0.0)
    report = spark.createDataFrame([(1, None, 0.1), (2, 0.9, 0.1)], "horizon INT, r2 DOUBLE, naive_r2 DOUBLE")
    assert evaluate.backtest_gate(report).first()["passed"] is False


def test_off_grid_rows_fill_no_slot(spark):
    assert quality.quality_report(panel(spark, [("a", 0, 1), ("a", 0.5, 1), ("a", 2, 1)]), PANEL).first()["missing_slots"] == 1


def test_nulls_are_no_bin(spark):
    pairs = [(float(i % 4), float(i % 4)) for i in range(40)]
    with_nulls = [*pairs, *[(float(i % 4), None) for i in range(30)]]
    for rows in (pairs, with_nulls):
        frame = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE")
        assert math.isclose(analysis.mutual_information(frame, ["x"], "y").first()["mi"], math.log(4), rel_tol=1e-9)


def test_recent_rows_across_holes(spark):
    spec = replace(SMALL, block_rows=8)
    df = panel(spark, [("a", h, h) for h in range(60) if h not in (37, 38, 39, 47, 48, 50)])
    whole = features.feature_frame(df, spec).orderBy(F.desc("ts")).limit(12).collect()
    recent = features.recent_feature_rows(df, spec, 12).orderBy(F.desc("ts")).collect()
    assert recent == whole and len(recent) == 12


def test_backfill_of_a_key_ignores_other_keys(spark):
    observed = [("a", h, h) for h in range(16)] + [("a", h, h) for h in range(200, 210)]
    forecasts = panel(spark, [("a", 0, 1), ("a", 300, 1)]).withColumnRenamed("y", "forecast")

    def filled(keys):
        missing = panel(spark, [("a", h, None) for h in keys]).select("series", "ts")
        return as_dict(backfill.backfilled_rows(panel(spark, observed), missing, last_value, SMALL), "forecast")

    alone, together = filled([205]), filled([15, 205, 208])
    assert alone == {} and set(together) == {("a", hours(15)), ("a", hours(208))}
    assert backfill.backfill_forecasts(panel(spark, observed), forecasts, last_value, SMALL).count() >= 2


def test_an_empty_stored_table_is_a_first_load(spark, tables):
    panel(spark, [("a", h, h) for h in range(51)]).write.parquet(tables.raw)
    jobs.feature_job(spark, tables, SMALL, T0 - HOUR)
    assert jobs.read_processed(spark, tables, SMALL).isEmpty()
    for new_series in ("drop", "admit"):
        jobs.feature_job(spark, tables, SMALL, T0 + 40 * HOUR, new_series=new_series)
        assert jobs.read_processed(spark, tables, SMALL).count() == 41


def test_a_redelivered_batch_adds_what_is_missing(spark, tmp_path):
    path = str(tmp_path / "out")
    body = append_above_watermark(path, SMALL)
    body(panel(spark, [("a", 0, 1)]), 0)
    batch = panel(spark, [(s, h, h) for s in ("a", "new") for h in range(1, 48)])
    stored = read_table(spark, path, SMALL.series_schema, SMALL.time_col)
    # A crash after the watermarks and the later of two dates were written.
    high_watermarks(stored, SMALL).write.parquet(f"{path}/_watermarks/batch-1")
    append_series(batch.where(F.col("ts") >= F.lit(hours(24)).cast("timestamp_ntz")), path, SMALL)
    for _ in range(2):
        body(batch, 1)
        now = read_table(spark, path, SMALL.series_schema, SMALL.time_col)
        assert now.count() == 1 + 2 * 47 and len(as_dict(now)) == 1 + 2 * 47


def test_nan_stops_the_check_and_not_the_training(spark):
    rows = [("a", h, float("nan") if h == 30 else 10 + h % 7) for h in range(120)]
    df = panel(spark, rows)
    with pytest.raises(quality.QualityError, match="nan_targets"):
        quality.assert_quality(df, SMALL, allow_nan=False)
    frame = features.feature_frame(df, SMALL)
    kept = modeling.training_columns(frame, SMALL)
    assert kept.where(F.isnan("y") | F.isnan("lag_1") | F.isnan("lag_6")).isEmpty() and kept.count() == 120 - 6 - 7
    assert modeling.walk_forward(frame, tiny(), SMALL, k=2).rmse is not None


def tiny(trees=3):
    return modeling.Candidate("GBTRegressor", GBTRegressor, {"maxIter": trees, "maxDepth": 2, "seed": 1}, {}, True)


def test_refit_uses_the_last_rows(spark):
    frame = features.feature_frame(panel(spark, [("a", h, h % 5 if h < 100 else 50 + h) for h in range(120)]), SMALL)
    once = modeling.walk_forward(frame, tiny(), SMALL, k=2)
    again = modeling.walk_forward(frame, tiny(), SMALL, k=2, refit_all=True)
    assert once.model.stages[-1].toDebugString != again.model.stages[-1].toDebugString


def test_training_leaves_its_callers_cache(spark, tables):
    frame = features.feature_frame(panel(spark, [("a", h, h % 5) for h in range(80)]), SMALL).persist()
    try:
        modeling.train_and_record(frame, SMALL, tables.model, tables.lineage, "p", candidates=[tiny(1)], k=2, n_trials=1)
        assert frame.storageLevel != StorageLevel.NONE
    finally:
        frame.unpersist()


def test_forecasts_are_stored_once_and_resolved(spark, tables):
    new = panel(spark, [("a", 1, 5), ("a", 1, 5), ("a", 2, None)]).withColumnRenamed("y", "forecast")
    jobs.append_forecasts(spark, new, tables, SMALL)
    assert jobs.stored_forecasts(spark, tables, SMALL).count() == 2
    append_series(panel(spark, [("a", 2, 7)]).withColumnRenamed("y", "forecast"), tables.forecasts, SMALL)
    assert as_dict(jobs.read_forecasts(spark, tables, SMALL), "forecast") == {("a", hours(1)): 5.0, ("a", hours(2)): 7.0}


@pytest.mark.parametrize(
    "name,most",
    [("densify_hourly", 3), ("holdout_split", 6), ("persistence_forecast", 12), ("preprocess", 18), ("missing_forecasts", 17)],
)
def test_scans_in_a_plan(spark, name, most):
    plan = REGISTRY[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= most
