"""Lag state kept as one array per row, oldest value first: it ends with ``lag_n, ..., lag_1``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridpulse.functions.calendar import aliased, calendar_features
from gridpulse.spec import SeriesSpec, lag_name, mean_name


def trailing_mean(k: int) -> str:
    """SQL for the mean of the columns ``lag_1 .. lag_k``."""
    total = " + ".join(lag_name(i) for i in range(1, k + 1))
    return f"({total}) / {k} AS {mean_name(k)}"


def features_from_lags(df: DataFrame, spec: SeriesSpec, keep: list[str]) -> DataFrame:
    """``keep``, then the full feature list in order, from the time and lag columns of ``df``."""
    return df.selectExpr(
        *[f"`{name}`" for name in keep],
        *aliased(calendar_features(spec.time_col, spec.zone)),
        *[trailing_mean(k) for k in spec.mean_sizes],
        *spec.lag_names,
    )


def features_of_state(
    df: DataFrame, spec: SeriesSpec, keep: list[str], lags: str = "_lags"
) -> DataFrame:
    """``keep`` and the feature list of rows whose lags are the last values of the array column ``lags``."""
    spread = df.selectExpr(
        *[f"`{name}`" for name in dict.fromkeys([*keep, spec.time_col])],
        *[f"element_at({lags}, {-k}) AS {lag_name(k)}" for k in spec.lags],
    )
    return features_from_lags(spread, spec, keep)
