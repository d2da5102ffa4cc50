"""The four batch jobs over stored tables: ingest, forecast, monitor and backfill."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.operators.backfill import backfilled_rows, missing_forecasts, resolved_forecasts
from gridpulse.operators.evaluate import backtest_gate, backtest_report
from gridpulse.operators.features import feature_frame, latest_per_series
from gridpulse.operators.forecast import Predictor, one_step_forecast
from gridpulse.operators.modeling import get_or_build_model, train_and_record
from gridpulse.operators.prepare import dedup_keep_first, preprocess
from gridpulse.operators.quality import assert_quality
from gridpulse.operators.split import trailing_window
from gridpulse.operators.upsert import absent_rows, high_watermarks, new_rows_above_watermark
from gridpulse.sources.tables import append_series, read_table, table_exists
from gridpulse.spec import SeriesSpec


@dataclass(frozen=True)
class Tables:
    """Locations of the stored tables and the model."""

    raw: str
    processed: str
    forecasts: str
    model: str
    lineage: str


def read_processed(spark: SparkSession, tables: Tables, spec: SeriesSpec) -> DataFrame:
    return read_table(spark, tables.processed, spec.series_schema, spec.time_col)


def stored_forecasts(spark: SparkSession, tables: Tables, spec: SeriesSpec) -> DataFrame:
    """All stored rows; a null forecast may stand beside its later repair."""
    return read_table(spark, tables.forecasts, spec.forecast_schema, spec.time_col)


def read_forecasts(spark: SparkSession, tables: Tables, spec: SeriesSpec) -> DataFrame:
    """One forecast a key."""
    return resolved_forecasts(stored_forecasts(spark, tables, spec), spec)


def recent_features(spark: SparkSession, tables: Tables, spec: SeriesSpec) -> DataFrame:
    """Feature frame of the trailing look-back of the processed table."""
    return feature_frame(trailing_window(read_processed(spark, tables, spec), spec), spec)


def stored_model(
    spark: SparkSession, tables: Tables, spec: SeriesSpec, **training: Any
) -> Predictor:
    """The stored model, trained on the trailing look-back first if there is none."""
    model = get_or_build_model(
        recent_features(spark, tables, spec),
        spec,
        tables.model,
        lineage_path=tables.lineage,
        data_location=tables.processed,
        **training,
    )
    return model.transform


def feature_job(
    spark: SparkSession,
    tables: Tables,
    spec: SeriesSpec,
    as_of: datetime,
    new_series: str = "admit",
) -> None:
    """Preprocess the raw table as of ``as_of``, check it, and append what is new.

    Without stored rows everything is stored, also if an empty table is there. A series that is not
    stored yet is admitted, unless ``new_series`` is ``"drop"``. A failed check raises before any write.
    """
    raw = spark.read.schema(spec.series_schema).parquet(tables.raw)
    data = preprocess(raw, spec, as_of).persist()
    try:
        exists = table_exists(spark, tables.processed)
        stored = read_processed(spark, tables, spec) if exists else None
        assert_quality(data, spec, stored.schema if exists else None)
        fresh = (
            new_rows_above_watermark(data, high_watermarks(stored, spec), spec, new_series)
            if exists and not stored.isEmpty()
            else data
        )
        append_series(fresh, tables.processed, spec)
    finally:
        data.unpersist()


def append_forecasts(
    spark: SparkSession, new: DataFrame, tables: Tables, spec: SeriesSpec
) -> None:
    """Store forecasts whose key is not stored yet, one a key."""
    new = new.persist()
    try:
        if table_exists(spark, tables.forecasts):
            fresh = absent_rows(new, stored_forecasts(spark, tables, spec), spec)
        else:
            fresh = dedup_keep_first(new, spec, order=["forecast"])
        append_series(fresh, tables.forecasts, spec)
    finally:
        new.unpersist()


def inference_job(
    spark: SparkSession,
    tables: Tables,
    spec: SeriesSpec,
    predictor: Predictor | None = None,
    **training: Any,
) -> None:
    """Forecast one step after the last stored row of every series.

    Without a ``predictor`` the stored model is used, or trained first if there is none. A processed
    table holds no nulls, so the last ``max_lag + 1`` rows of a series are all that is needed.
    """
    predictor = predictor or stored_model(spark, tables, spec, **training)
    recent = trailing_window(read_processed(spark, tables, spec), spec)
    last_rows = latest_per_series(recent, spec, spec.max_lag + 1)
    frame = feature_frame(last_rows, spec)
    new = one_step_forecast(frame, predictor, spec).select(*spec.key, "forecast")
    append_forecasts(spark, new, tables, spec)


def monitor_job(
    spark: SparkSession,
    tables: Tables,
    spec: SeriesSpec,
    predictor: Predictor | None = None,
    threshold: float = 0.8,
    horizons: int = 12,
    **training: Any,
) -> bool:
    """Back-test the current model; train, store and record a new one if it fails.

    Returns whether the current model passed.
    """
    frame = recent_features(spark, tables, spec).persist()
    try:
        predictor = predictor or stored_model(spark, tables, spec, **training)
        report = backtest_report(frame, predictor, spec, horizons)
        passed = backtest_gate(report, threshold).first()["passed"]
        if not passed:
            train_and_record(
                frame, spec, tables.model, tables.lineage, tables.processed, **training
            )
        return passed
    finally:
        frame.unpersist()


def backfill_job(
    spark: SparkSession,
    tables: Tables,
    spec: SeriesSpec,
    predictor: Predictor | None = None,
    lookback: timedelta | None = None,
    **training: Any,
) -> bool:
    """Add forecasts that should have been made. Returns False, and writes nothing, if none is missing."""
    processed = read_processed(spark, tables, spec)
    missing = missing_forecasts(
        processed, stored_forecasts(spark, tables, spec), spec, lookback
    ).persist()
    try:
        if missing.isEmpty():
            return False
        predictor = predictor or stored_model(spark, tables, spec, **training)
        rows = backfilled_rows(processed, missing, predictor, spec)
        append_series(rows.where(F.col("forecast").isNotNull()), tables.forecasts, spec)
        return True
    finally:
        missing.unpersist()
