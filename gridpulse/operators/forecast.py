"""One-step and recursive forecasts.

A predictor is any function from a DataFrame with the feature columns to the same DataFrame with a
``yhat`` column added: ``PipelineModel.transform`` or a plain column expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.lagstate import features_from_lags, features_of_state
from gridpulse.functions.timegrid import shift
from gridpulse.operators.blocks import attach_per_series
from gridpulse.operators.features import latest_per_series
from gridpulse.sources.tables import cut_lineage
from gridpulse.spec import SeriesSpec, lag_name

Predictor = Callable[[DataFrame], DataFrame]

# A plan of this many recursive steps is still compiled quickly; longer horizons are cut.
STEPS_PER_PLAN = 24


def expression_predictor(expression: Column) -> Predictor:
    return lambda df: df.withColumn("yhat", expression)


def clean_forecast(yhat: Column) -> Column:
    """Four places, not below zero; no prediction stays no forecast."""
    return F.when(yhat.isNotNull(), F.greatest(F.lit(0.0), F.round(yhat, 4)))


def next_step_state(rows: DataFrame, spec: SeriesSpec, keep: list[str]) -> DataFrame:
    """Key of the following step and its lags as one array ``_lags``; one row per input row."""
    return rows.select(
        *keep,
        shift(F.col(spec.time_col), spec.every).alias(spec.time_col),
        F.array(*spec.lag_names[1:], spec.target_col).alias("_lags"),
    )


def next_step_features(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The feature row one step after each given feature row: lags shifted, target as ``lag_1``."""
    shifted = rows.select(
        spec.series_col,
        shift(F.col(spec.time_col), spec.every).alias(spec.time_col),
        *[F.col(lag_name(k - 1)).alias(lag_name(k)) for k in spec.lags if k > 1],
        F.col(spec.target_col).alias(lag_name(1)),
    )
    return features_from_lags(shifted, spec, spec.key)


def forecast_next(rows: DataFrame, predictor: Predictor, spec: SeriesSpec) -> DataFrame:
    """Features and forecast of the step after each given feature row."""
    predicted = predictor(next_step_features(rows, spec))
    return predicted.select(
        *spec.key, *spec.feature_names, clean_forecast(F.col("yhat")).alias("forecast")
    )


def one_step_forecast(frame: DataFrame, predictor: Predictor, spec: SeriesSpec) -> DataFrame:
    """Forecast of the step after the last row of every series."""
    return forecast_next(latest_per_series(frame, spec), predictor, spec)


def forecast_path(
    state: DataFrame, predictor: Predictor, spec: SeriesSpec, horizon: int
) -> DataFrame:
    """Advance every state row ``horizon`` steps, each forecast becoming the next step's ``lag_1``.

    Forecasts are appended to the array of lags, whose end is all that a step reads. So a row grows by
    one number a step, the plan is linear in the horizon and nothing is shuffled. Returns one row per
    state row and step, with the columns of ``state``, ``step``, and ``forecast``; ``_lags`` are the
    lags that step was predicted from.
    """
    ids = [c for c in state.columns if c not in (spec.time_col, "_lags")]
    ts, values = F.col(spec.time_col), F.col("_lags")
    current = state
    for step in range(1, horizon + 1):
        features = features_of_state(current, spec, [*ids, spec.time_col, "_lags"])
        current = predictor(features).select(
            *ids,
            shift(ts, spec.every).alias(spec.time_col),
            F.concat(values, F.array(clean_forecast(F.col("yhat")))).alias("_lags"),
        )
        if step % STEPS_PER_PLAN == 0 and step < horizon:
            current = cut_lineage(current)
    times = F.sequence(shift(ts, -horizon * spec.every), shift(ts, -spec.every), F.lit(spec.every))
    # Outer, because a plain explode adds a non-empty test that the optimizer pushes through every step.
    steps = current.select(*ids, values, F.posexplode_outer(times).alias("_place", spec.time_col))
    place = F.col("_place")
    return steps.select(
        *ids,
        ts,
        F.slice(values, place + 1, spec.max_lag).alias("_lags"),
        (place + 1).alias("step"),
        F.get(values, place + spec.max_lag).alias("forecast"),
    )


def multi_step_forecast(
    frame: DataFrame, predictor: Predictor, spec: SeriesSpec, horizon: int
) -> DataFrame:
    """Recursive forecast of the next ``horizon`` steps of every series (at least one)."""
    state = next_step_state(latest_per_series(frame, spec), spec, [spec.series_col])
    path = forecast_path(state, predictor, spec, max(1, horizon))
    columns = [*spec.key, *spec.feature_names, "forecast"]
    return features_of_state(path, spec, [*spec.key, "forecast"]).select(*columns)


def persistence_forecast(train: DataFrame, test: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Carry the last train target of every series to all of its test rows."""
    last = train.groupBy(spec.series_col).agg(
        F.max_by(spec.target_col, spec.time_col).alias("naive_forecast")
    )
    return attach_per_series(test.select(*spec.columns), last, spec)


def persistence_of_flagged(flagged: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The same for rows that ``holdout_flag`` marked: one table, not two halves of a plan."""
    train = ~F.col("is_test")
    last = flagged.groupBy(spec.series_col).agg(
        F.max_by(F.when(train, F.col(spec.target_col)), F.when(train, F.col(spec.time_col))).alias("naive_forecast"),
        F.bool_or(train).alias("_trained"),
    )
    # As with two halves, a series without a train row has no forecast and no row.
    known = last.where("_trained").drop("_trained")
    return attach_per_series(flagged.where("is_test").select(*spec.columns), known, spec)
