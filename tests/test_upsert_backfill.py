from dataclasses import replace
from datetime import timedelta

import pytest
from panel_helpers import HOUR, as_dict, hours, panel
from pyspark.sql import functions as F

from gridpulse.operators import backfill, features, forecast, upsert
from gridpulse.sources.panels import PANEL

SMALL = replace(PANEL, max_lag=6, step=2, block_rows=10, lookback=timedelta(hours=48))


def predictor(df):
    return df.withColumn("yhat", F.expr("0.7 * lag_1 + 0.3 * avg_4_lags"))


def forecasts_of(spark, rows):
    return panel(spark, rows).withColumnRenamed("y", "forecast")


def test_watermark(spark):
    stored = panel(spark, [("a", h, 0) for h in range(5)] + [("b", 2, 0)])
    batch = panel(spark, [(s, h, 1) for s in ("a", "b", "new") for h in range(7)])
    marks = upsert.high_watermarks(stored, SMALL)
    dropped = as_dict(upsert.new_rows_above_watermark(batch, marks, SMALL, "drop"))
    assert set(dropped) == {("a", hours(h)) for h in (5, 6)} | {("b", hours(h)) for h in range(3, 7)}
    admitted = as_dict(upsert.new_rows_above_watermark(batch, marks, SMALL, "admit"))
    assert set(admitted) - set(dropped) == {("new", hours(h)) for h in range(7)}
    with pytest.raises(ValueError):
        upsert.new_rows_above_watermark(batch, marks, SMALL, "maybe")


def test_append_twice_adds_nothing(spark):
    stored = panel(spark, [("a", 0, 0)])
    batch = panel(spark, [("a", h, 1) for h in range(4)])
    once = upsert.append_processed(stored, batch, SMALL)
    twice = upsert.append_processed(once, batch, SMALL)
    assert once.count() == twice.count() == 4
    assert as_dict(twice)[("a", hours(0))] == 0.0


def test_stored_forecast_wins(spark):
    stored = forecasts_of(spark, [("a", 0, 1), ("a", 1, 2)])
    new = forecasts_of(spark, [("a", 1, 9), ("a", 2, 8), ("a", 2, 7), ("b", 0, 5)])
    merged = upsert.insert_if_absent(new, stored, SMALL)
    assert merged.count() == 4
    assert as_dict(merged, "forecast") == {
        ("a", hours(0)): 1.0, ("a", hours(1)): 2.0, ("a", hours(2)): 7.0, ("b", hours(0)): 5.0,
    }
    assert upsert.insert_if_absent(new, merged, SMALL).count() == 4
    assert upsert.absent_rows(new.limit(0), stored, SMALL).isEmpty()


def history(spark):
    return panel(spark, [(s, h, (h * k) % 19) for s, k in (("a", 3), ("b", 7)) for h in range(60)])


def test_missing_forecasts(spark):
    rows = [("a", h, 1) for h in range(20, 58) if h not in (30, 31, 45)]
    rows += [("a", 45, None), ("b", 5, 1), ("b", 59, 1)]
    missing = backfill.missing_forecasts(history(spark), forecasts_of(spark, rows), SMALL)
    keys = {(r["series"], r["ts"]) for r in missing.collect()}
    assert keys == {("a", hours(h)) for h in (30, 31, 45)} | {
        ("b", hours(h)) for h in range(11, 59)
    }
    everything = backfill.missing_forecasts(
        history(spark), forecasts_of(spark, rows), SMALL, all_history=True
    )
    assert everything.count() == len(keys) + 5


def test_backfill_equals_hour_by_hour(spark):
    processed = history(spark).cache()
    stored = forecasts_of(
        spark, [("a", 4, 1), ("a", 59, 1), ("b", 12, 1), ("b", 59, 1)]
    )
    spec = replace(SMALL, lookback=timedelta(hours=50))
    missing = backfill.missing_forecasts(processed, stored, spec).cache()
    wanted = {(r["series"], r["ts"]) for r in missing.collect()}
    got = as_dict(backfill.backfilled_rows(processed, missing, predictor, spec), "forecast")
    for h in (12, 13, 30, 58):
        end = hours(h) - HOUR
        window = processed.where(F.col("ts").between(F.lit(end - spec.lookback), F.lit(end)))
        frame = features.feature_frame(window, spec)
        expected = as_dict(forecast.one_step_forecast(frame, predictor, spec), "forecast")
        for key, value in expected.items():
            if key in wanted:
                assert got[key] == value
    # The look-back starts at hour 9, the first feature row is at hour 6.
    assert set(got) == wanted
    filled = backfill.backfill_forecasts(processed, stored, predictor, spec)
    assert filled.count() == 4 + len(wanted)
    assert backfill.missing_forecasts(processed, filled, spec).isEmpty()


def test_short_history_stays_missing(spark):
    processed = panel(spark, [("a", h, h) for h in range(12)])
    stored = forecasts_of(spark, [("a", 2, 1), ("a", 11, 1)])
    result = as_dict(backfill.backfill_forecasts(processed, stored, predictor, SMALL), "forecast")
    assert {k[1] for k in result} == {hours(h) for h in (2, 7, 8, 9, 10, 11)}


def test_repaired_null_row_is_resolved_on_read(spark):
    rows = forecasts_of(spark, [("a", 0, None), ("a", 0, 4), ("a", 1, 2)])
    assert as_dict(backfill.resolved_forecasts(rows, SMALL), "forecast") == {
        ("a", hours(0)): 4.0, ("a", hours(1)): 2.0,
    }
