"""Trailing windows, hold-out splits and expanding-window folds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.timegrid import shift
from gridpulse.operators.blocks import attach_per_series, attach_series_aggregates, global_row_index
from gridpulse.spec import SeriesSpec


def trailing_window(
    df: DataFrame, spec: SeriesSpec, lookback: timedelta | None = None
) -> DataFrame:
    """Rows no older than ``lookback`` before the last row of their own series (inclusive).

    The oldest bound of all series is a scalar subquery that reaches the scan as a filter.
    """
    lookback = spec.lookback if lookback is None else lookback
    ts = F.col(spec.time_col)
    starts = df.groupBy(spec.series_col).agg(shift(F.max(ts), -lookback).alias("_earliest"))
    oldest = starts.agg(F.min("_earliest")).scalar()
    return (
        attach_per_series(df.where(ts >= oldest), starts, spec)
        .where(ts >= F.col("_earliest"))
        .select(*df.columns)
    )


def holdout_flag(df: DataFrame, spec: SeriesSpec, test_size: int) -> DataFrame:
    """Add ``is_test``: later than ``test_size`` grid steps before the series' last row."""
    last = attach_series_aggregates(df, spec, _last=("max", spec.time_col))
    split = shift(F.col("_last"), -test_size * spec.every)
    return last.select(*df.columns, (F.col(spec.time_col) > split).alias("is_test"))


def holdout_split(
    df: DataFrame, spec: SeriesSpec, test_size: int
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, split per series."""
    flagged = holdout_flag(df, spec, test_size)
    return (
        flagged.where(~F.col("is_test")).drop("is_test"),
        flagged.where("is_test").drop("is_test"),
    )


def fold_boundaries(df: DataFrame, spec: SeriesSpec, k: int) -> DataFrame:
    """Bounds of ``k`` expanding-window folds over the distinct timestamps of the whole table.

    With ``n`` timestamps numbered from 0 and ``step = n div (k + 1)``, fold ``i`` ends at index
    ``n - 1 - step * (k - i)`` and its train part at that index less a ``k + 1``-th of it. All ``k``
    folds are kept, also where short data makes them overlap.
    """
    indexed = global_row_index(df.select(spec.time_col).distinct(), spec)
    step = f"(_total div {k + 1})"
    ends = ", ".join(
        f"named_struct('fold', {i}, 'end', _total - 1 - {step} * {k - i})" for i in range(1, k + 1)
    )
    marked = indexed.withColumn("_fold", F.explode(F.expr(f"array({ends})"))).select(
        spec.time_col,
        "_index",
        F.col("_fold.fold").alias("fold"),
        F.col("_fold.end").alias("_end"),
        F.expr(f"_fold.end - _fold.end div {k + 1}").alias("_train"),
    )
    ts = F.col(spec.time_col)
    return (
        marked.where((F.col("_index") == F.col("_end")) | (F.col("_index") == F.col("_train")))
        .groupBy("fold")
        .agg(
            F.max(F.when(F.col("_index") == F.col("_train"), ts)).alias("train_end"),
            F.max(F.when(F.col("_index") == F.col("_end"), ts)).alias("fold_end"),
        )
    )


def fold_membership(df: DataFrame, folds: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Each row once per fold it belongs to, with ``fold`` and ``role`` (train or validation).

    The ``k`` bounds enter as one array from a scalar subquery, so no join is needed.
    """
    bounds = folds.agg(F.collect_list(F.struct("fold", "train_end", "fold_end"))).scalar()
    ts = F.col(spec.time_col)
    return (
        df.withColumn("_bounds", bounds)
        .withColumn("_fold", F.explode(F.filter("_bounds", lambda b: ts <= b["fold_end"])))
        .select(
            *df.columns,
            F.col("_fold.fold").alias("fold"),
            F.when(ts <= F.col("_fold.train_end"), "train").otherwise("validation").alias("role"),
        )
    )


def fold_membership_one_series(
    df: DataFrame, spec: SeriesSpec, series: str, k: int
) -> DataFrame:
    """Fold membership of one series, with folds cut on that series' own timestamps."""
    one = df.where(F.col(spec.series_col) == series)
    return fold_membership(one, fold_boundaries(one, spec, k), spec)
