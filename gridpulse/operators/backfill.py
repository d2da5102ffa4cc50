"""Find observed steps without a forecast and forecast them after the fact."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.timegrid import shift
from gridpulse.operators.blocks import attach_per_series
from gridpulse.operators.features import feature_frame
from gridpulse.operators.forecast import Predictor, forecast_next
from gridpulse.operators.split import trailing_window
from gridpulse.spec import SeriesSpec


def forecast_coverage(forecasts: DataFrame, spec: SeriesSpec) -> DataFrame:
    """First and last forecast time of every series."""
    return forecasts.groupBy(spec.series_col).agg(
        F.min(spec.time_col).alias("first_forecast"), F.max(spec.time_col).alias("last_forecast")
    )


def missing_forecasts(
    processed: DataFrame,
    forecasts: DataFrame,
    spec: SeriesSpec,
    lookback: timedelta | None = None,
    all_history: bool = False,
    coverage: DataFrame | None = None,
) -> DataFrame:
    """Keys observed in the trailing look-back, inside forecast coverage, without a known forecast.

    A stored forecast that is null counts as missing. ``all_history`` drops the look-back bound. With a
    known ``coverage`` (as :func:`forecast_coverage`), ``forecasts`` may be only those of the look-back.
    """
    ts = F.col(spec.time_col)
    observed = processed.select(*spec.key)
    if not all_history:
        observed = trailing_window(observed, spec, lookback)
    coverage = forecast_coverage(forecasts, spec) if coverage is None else coverage
    covered = attach_per_series(observed, coverage, spec).where(
        ts.between(F.col("first_forecast"), F.col("last_forecast"))
    )
    known = forecasts.where(F.col("forecast").isNotNull()).select(*spec.key)
    return covered.select(*spec.key).join(known, spec.key, "left_anti")


def backfilled_rows(
    processed: DataFrame,
    missing: DataFrame,
    predictor: Predictor,
    spec: SeriesSpec,
    gap_free: bool = False,
) -> DataFrame:
    """One-step forecasts for all missing keys at once.

    A missing step is forecast from the feature row one step earlier, whose lags must lie in that
    step's own look-back; so a key's forecast does not depend on which other keys are missing. Only
    stored rows that can feed such a feature row are read. A step without enough history stays missing.
    """
    first_needed = missing.agg(shift(F.min(spec.time_col), -spec.every - spec.lookback)).scalar()
    frame = feature_frame(
        processed.where(F.col(spec.time_col) >= first_needed), spec, gap_free, oldest="_oldest"
    ).where(F.col("_oldest") >= shift(F.col(spec.time_col), -spec.lookback)).drop("_oldest")
    origins = missing.select(
        spec.series_col, shift(F.col(spec.time_col), -spec.every).alias(spec.time_col)
    )
    wanted = frame.join(origins, spec.key, "left_semi")
    return forecast_next(wanted, predictor, spec).select(*spec.key, "forecast")


def backfill_forecasts(
    processed: DataFrame,
    forecasts: DataFrame,
    predictor: Predictor,
    spec: SeriesSpec,
    lookback: timedelta | None = None,
    gap_free: bool = False,
) -> DataFrame:
    """The forecast table as it is after the missing forecasts were added."""
    missing = missing_forecasts(processed, forecasts, spec, lookback)
    repaired = backfilled_rows(processed, missing, predictor, spec, gap_free)
    return forecasts.select(*spec.key, "forecast").unionByName(repaired)


def resolved_forecasts(forecasts: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One forecast per key: the known one where a null row was repaired later."""
    return forecasts.groupBy(*spec.key).agg(F.max("forecast").alias("forecast"))
