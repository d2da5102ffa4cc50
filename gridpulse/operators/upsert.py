"""Which rows of a new batch may be added to a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators.blocks import attach_per_series
from gridpulse.operators.prepare import dedup_keep_first
from gridpulse.spec import SeriesSpec


def high_watermarks(stored: DataFrame, spec: SeriesSpec) -> DataFrame:
    return stored.groupBy(spec.series_col).agg(F.max(spec.time_col).alias("_watermark"))


def new_rows_above_watermark(
    batch: DataFrame,
    watermarks: DataFrame,
    spec: SeriesSpec,
    new_series: str = "admit",
) -> DataFrame:
    """Batch rows later than the last stored row of their own series.

    Late rows are never admitted. A series without stored rows is admitted, unless ``new_series`` is
    ``"drop"``. ``watermarks`` is the result of :func:`high_watermarks`.
    """
    if new_series not in ("drop", "admit"):
        raise ValueError("new_series must be 'drop' or 'admit'")
    later = F.col(spec.time_col) > F.col("_watermark")
    if new_series == "admit":
        marked = attach_per_series(batch, watermarks, spec, how="left")
        later = F.col("_watermark").isNull() | later
    else:
        marked = attach_per_series(batch, watermarks, spec)
    return marked.where(later).select(*batch.columns)


def append_processed(
    stored: DataFrame, batch: DataFrame, spec: SeriesSpec, new_series: str = "admit"
) -> DataFrame:
    """The stored table as it is after the batch was appended."""
    fresh = new_rows_above_watermark(batch, high_watermarks(stored, spec), spec, new_series)
    return stored.unionByName(fresh)


def absent_rows(new: DataFrame, stored: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per key of ``new`` whose key is not stored yet: a stored row wins.

    Stored rows before the oldest new key cannot match; that bound reaches the stored scan.
    """
    unique = dedup_keep_first(new, spec, order=[c for c in new.columns if c not in spec.key])
    oldest = new.agg(F.min(spec.time_col)).scalar()
    recent = stored.where(F.col(spec.time_col) >= oldest).select(*spec.key)
    return unique.join(recent, spec.key, "left_anti").select(*new.columns)


def insert_if_absent(new: DataFrame, stored: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The stored table as it is after the absent rows were added."""
    return stored.unionByName(absent_rows(new, stored, spec))
