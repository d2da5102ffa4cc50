"""Lag, trailing-mean and calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpulse.functions.calendar import aliased, daypart_flags, hour_encoding, local_hour
from gridpulse.functions.lagstate import features_from_lags, trailing_mean
from gridpulse.operators.blocks import BLOCK, HALO, with_preceding_rows
from gridpulse.spec import SeriesSpec, lag_name


def lag_features(
    df: DataFrame,
    spec: SeriesSpec,
    gap_free: bool = False,
    complete: bool = True,
    oldest: str | None = None,
) -> DataFrame:
    """``lag_n .. lag_1`` of the target, by row within the series.

    With ``complete`` a row is kept only if none of its lags is null or NaN. ``oldest`` names a column
    for the time of ``lag_n``. See ``with_preceding_rows`` for ``gap_free``.
    """
    dated = [f"lag(`{spec.time_col}`, {spec.max_lag}) OVER ({{over}}) AS `{oldest}`"] if oldest else []
    over = f"PARTITION BY `{spec.series_col}`, {BLOCK} ORDER BY `{spec.time_col}`"
    lagged = (
        with_preceding_rows(df.select(*spec.columns), spec, spec.max_lag, gap_free)
        .selectExpr(
            *[f"`{name}`" for name in spec.columns],
            HALO,
            *[f"lag(`{spec.target_col}`, {k}) OVER ({over}) AS {lag_name(k)}" for k in spec.lags],
            *[column.format(over=over) for column in dated],
        )
        .where(~F.col(HALO))
    )
    if complete:
        lagged = lagged.dropna("any", subset=spec.lag_names)
    return lagged.select(*spec.key, *spec.lag_names, spec.target_col, *([oldest] if oldest else []))


def window_mean_features(df: DataFrame, spec: SeriesSpec, gap_free: bool = False) -> DataFrame:
    """Trailing means over the last ``step, 2*step, .. max_lag`` rows, the row itself excluded."""
    return lag_features(df, spec, gap_free).selectExpr(
        *[f"`{name}`" for name in spec.key], *[trailing_mean(k) for k in spec.mean_sizes]
    )


def with_hour_encoding(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.selectExpr("*", *aliased(hour_encoding(local_hour(spec.time_col, spec.zone))))


def with_daypart_flags(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.selectExpr("*", *aliased(daypart_flags(local_hour(spec.time_col, spec.zone))))


def feature_frame(
    df: DataFrame, spec: SeriesSpec, gap_free: bool = False, oldest: str | None = None
) -> DataFrame:
    """Key, features and label, in the model's column order; one shuffle, one sort."""
    lagged = lag_features(df, spec, gap_free, oldest=oldest)
    extra = [oldest] if oldest else []
    columns = [*spec.key, *spec.feature_names, spec.target_col, *extra]
    return features_from_lags(lagged, spec, [*spec.columns, *extra]).select(*columns)


def recent_feature_rows(df: DataFrame, spec: SeriesSpec, n: int = 1) -> DataFrame:
    """The last ``n`` feature rows of every series, from its last ``n + max_lag`` rows.

    Exact on holes of any length; the panel must be without nulls, as a checked processed table is.
    Rows that cannot matter are ranked away before the first shuffle.
    """
    tail = latest_per_series(df.select(*spec.columns), spec, n + spec.max_lag)
    return feature_frame(tail, spec)


def latest_per_series(df: DataFrame, spec: SeriesSpec, n: int = 1) -> DataFrame:
    """The last ``n`` rows of every series; ranked before the shuffle, so a long series is cheap."""
    newest_first = Window.partitionBy(spec.series_col).orderBy(F.col(spec.time_col).desc())
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )
