"""The batch jobs over versioned tables: each adds one commit, and reads what its result can depend on.

Watermarks, forecast coverage and the start of the trailing look-back come from the tables' marks, so no
job reads the stored history: scans are pruned to the dates of the look-back by literal bounds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridpulse.operators.backfill import backfilled_rows, missing_forecasts
from gridpulse.operators.features import feature_frame, latest_per_series
from gridpulse.operators.forecast import Predictor, one_step_forecast
from gridpulse.operators.prepare import dedup_keep_first, preprocess
from gridpulse.operators.split import trailing_window
from gridpulse.operators.upsert import absent_rows, new_rows_above_watermark
from gridpulse.sources.versioned import Snapshot, VersionedTable, append_batches
from gridpulse.spec import SeriesSpec


@dataclass(frozen=True)
class StoredTables:
    """The processed panel and its forecasts, below one folder."""

    processed: VersionedTable
    forecasts: VersionedTable

    @classmethod
    def at(cls, spark: SparkSession, path: str, spec: SeriesSpec) -> StoredTables:
        return cls(
            VersionedTable(spark, f"{path}/processed", spec),
            VersionedTable(spark, f"{path}/forecasts", spec, spec.forecast_schema),
        )


def ingest(raw: DataFrame, tables: StoredTables, spec: SeriesSpec, as_of: datetime, new_series: str = "admit") -> Snapshot:
    """Preprocess raw readings as of ``as_of`` and append what is later than each series' last stored row.

    The rows are computed once: they are checked in the pass that writes them.
    """
    table = tables.processed
    base = table.snapshot()
    data = preprocess(raw, spec, as_of)
    if base.rows:
        data = new_rows_above_watermark(data, table.watermarks(base), spec, new_series)
    return table.append(data, base=base)


def recent_rows(table: VersionedTable, spec: SeriesSpec, snapshot: Snapshot | None = None) -> DataFrame:
    """Rows of each series' trailing look-back; only its dates are read."""
    snapshot = snapshot or table.snapshot()
    return trailing_window(table.read(snapshot, since=table.trailing_start(snapshot)), spec)


def forecast_next_step(tables: StoredTables, spec: SeriesSpec, predictor: Predictor) -> Snapshot:
    """Store a forecast one step after the last row of every series, unless there is one."""
    last_rows = latest_per_series(recent_rows(tables.processed, spec), spec, spec.max_lag + 1)
    new = one_step_forecast(feature_frame(last_rows, spec), predictor, spec).select(*spec.key, "forecast")
    base = tables.forecasts.snapshot()
    known = tables.forecasts.read(base, since=tables.processed.trailing_start())
    return tables.forecasts.append(absent_rows(new, known, spec), base=base)


def backfill(
    tables: StoredTables, spec: SeriesSpec, predictor: Predictor, lookback: timedelta | None = None
) -> Snapshot:
    """Store the forecasts of the look-back that should have been made; no commit if none is missing."""
    processed, forecasts = tables.processed.snapshot(), tables.forecasts.snapshot()
    since = tables.processed.trailing_start(processed, lookback)
    if since is None or not forecasts.rows:
        return forecasts
    coverage = tables.forecasts.marks(forecasts).withColumnsRenamed({"_first": "first_forecast", "_last": "last_forecast"})
    known = tables.forecasts.read(forecasts, since=since)
    observed = tables.processed.read(processed, since=since)
    missing = missing_forecasts(observed, known, spec, lookback, coverage=coverage)
    # A forecast uses lags of its own look-back, one step before it.
    feeding = tables.processed.read(processed, since=since - spec.every - spec.lookback)
    rows = backfilled_rows(feeding, missing, predictor, spec).where(F.col("forecast").isNotNull())
    return tables.forecasts.append(rows, base=forecasts)


def start_stored_ingest(
    spark: SparkSession,
    source: str,
    table: VersionedTable,
    checkpoint: str,
    query: str,
    new_series: str = "admit",
    max_files: int | None = None,
) -> StreamingQuery:
    """Append what has arrived in ``source`` above each series' watermark, a commit a micro-batch, and stop."""
    spec = table.spec

    def fresh(batch: DataFrame, watermarks: DataFrame) -> DataFrame:
        unique = dedup_keep_first(batch.select(*spec.columns), spec)
        return new_rows_above_watermark(unique, watermarks, spec, new_series)

    reader = spark.readStream.schema(spec.series_schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(append_batches(table, query, fresh))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
