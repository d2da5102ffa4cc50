"""Forecast scores, the stacked back-test and its acceptance gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpulse.functions.timegrid import shift
from gridpulse.operators.features import latest_per_series
from gridpulse.operators.forecast import Predictor, forecast_path, next_step_state
from gridpulse.spec import SeriesSpec


def answered(y: str, yhat: str) -> Column:
    """Whether every known label has a forecast; a score over some of them would flatter the model."""
    return F.count_if(F.col(y).isNotNull() & F.col(yhat).isNull()) == 0


def r2_of(y: str, yhat: str) -> Column:
    """``1 - SSE / SST`` to four places; null when the label does not vary or a forecast is missing."""
    sse = F.sum(F.pow(F.col(y) - F.col(yhat), F.lit(2)))
    score = F.round(1 - sse / F.nullif(F.regr_syy(y, F.col(y)), F.lit(0.0)), 4)
    return F.when(answered(y, yhat), score)


def rmse_of(y: str, yhat: str) -> Column:
    """Root of the mean squared error to four places; null when a forecast is missing."""
    score = F.round(F.sqrt(F.avg(F.pow(F.col(y) - F.col(yhat), F.lit(2)))), 4)
    return F.when(answered(y, yhat), score)


def evaluation_metrics(
    df: DataFrame, y: str, yhat: str, by: list[str] | None = None
) -> DataFrame:
    """R² and RMSE, pooled over all rows or per group of ``by``."""
    return df.groupBy(*(by or [])).agg(r2_of(y, yhat).alias("r2"), rmse_of(y, yhat).alias("rmse"))


def backtest_forecasts(
    frame: DataFrame, predictor: Predictor, spec: SeriesSpec, horizons: int = 12
) -> DataFrame:
    """Held-out rows of every hold-out size ``n = 1 .. horizons`` with model and naive forecast.

    All hold-outs run as one recursion over states keyed ``(series, n)``. A series' origin for ``n``
    is its last row at or before ``n`` steps from its end, hence among its last ``horizons + 1`` rows;
    only those rows are shuffled.
    """
    ts = F.col(spec.time_col)
    per_series = Window.partitionBy(spec.series_col)
    recent = latest_per_series(frame, spec, horizons + 1)
    ranged = recent.select(
        "*",
        F.max(ts).over(per_series).alias("_end"),
        F.lead(ts).over(per_series.orderBy(spec.time_col)).alias("_next"),
    )
    sizes = F.array(*[
        F.struct(F.lit(n).alias("n"), shift(F.col("_end"), -n * spec.every).alias("split"))
        for n in range(1, horizons + 1)
    ])
    origins = ranged.withColumn(
        "_holdout",
        F.explode(F.filter(sizes, lambda h: (ts <= h["split"]) & (F.col("_next") > h["split"]))),
    ).select(
        "*",
        F.col("_holdout.n").alias("horizon"),
        F.col("_holdout.split").alias("_split"),
        F.col(spec.target_col).alias("naive_forecast"),
    )
    state = next_step_state(
        origins, spec, [spec.series_col, "horizon", "_split", "naive_forecast"]
    )
    path = forecast_path(state, predictor, spec, horizons).where(
        (F.col("step") <= F.col("horizon")) & (ts > F.col("_split"))
    )
    return (
        path.select(*spec.key, "horizon", "forecast", "naive_forecast")
        .join(recent.select(*spec.columns), spec.key)
        .select(*spec.columns, "horizon", "forecast", "naive_forecast")
    )


def backtest_report(
    frame: DataFrame, predictor: Predictor, spec: SeriesSpec, horizons: int = 12
) -> DataFrame:
    """R² and RMSE of model and naive forecast for every hold-out size."""
    y = spec.target_col
    return (
        backtest_forecasts(frame, predictor, spec, horizons)
        .groupBy("horizon")
        .agg(
            r2_of(y, "forecast").alias("r2"),
            rmse_of(y, "forecast").alias("rmse"),
            r2_of(y, "naive_forecast").alias("naive_r2"),
            rmse_of(y, "naive_forecast").alias("naive_rmse"),
        )
    )


def backtest_gate(report: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row: is the model still good enough?

    It is when its mean R² exceeds both the threshold and the naive mean, and every single R² exceeds
    the threshold. An undefined R² fails.
    """
    each = F.bool_and(F.coalesce(F.col("r2") > threshold, F.lit(False)))
    mean = F.avg("r2") > F.greatest(F.lit(threshold), F.avg("naive_r2"))
    return report.agg(
        F.avg("r2").alias("mean_r2"),
        F.avg("naive_r2").alias("mean_naive_r2"),
        F.coalesce(each & mean, F.lit(False)).alias("passed"),
    )
