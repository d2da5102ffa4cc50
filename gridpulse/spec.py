"""Description of a panel of regular series: column names, grid, look-back and feature layout."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import types as T

CALENDAR_FEATURES = (
    "sine_hour",
    "cosine_hour",
    "is_morning",
    "is_afternoon",
    "is_evening",
    "is_night",
)


@dataclass(frozen=True)
class SeriesSpec:
    """Everything an operator needs to know about a panel.

    ``block_rows`` is the number of grid slots in one time block. Order-dependent operators work on
    ``(series, block)`` instead of whole series, so that one long series spreads over many tasks.
    """

    series_col: str = "company_id"
    time_col: str = "timestamp_utc"
    target_col: str = "energy_demand_mw"
    every: timedelta = timedelta(hours=1)
    lookback: timedelta = timedelta(days=14)
    anchor: datetime = datetime(2025, 1, 1)
    max_lag: int = 32
    step: int = 4
    zone: str = "EST"
    block_rows: int = 4096

    def __post_init__(self) -> None:
        if self.every <= timedelta(0):
            raise ValueError("every must be positive")
        if self.max_lag < 1 or self.step < 1:
            raise ValueError("max_lag and step must be positive")
        if self.block_rows < 1:
            raise ValueError("block_rows must be positive")

    @property
    def key(self) -> list[str]:
        return [self.series_col, self.time_col]

    @property
    def columns(self) -> list[str]:
        return [self.series_col, self.time_col, self.target_col]

    @property
    def lags(self) -> list[int]:
        """Lag numbers, oldest first, which is also their column order."""
        return list(range(self.max_lag, 0, -1))

    @property
    def mean_sizes(self) -> list[int]:
        """Trailing-mean lengths, longest first: the multiples of ``step`` up to ``max_lag``."""
        return list(range(self.step, self.max_lag + 1, self.step))[::-1]

    @property
    def lag_names(self) -> list[str]:
        return [lag_name(k) for k in self.lags]

    @property
    def mean_names(self) -> list[str]:
        return [mean_name(k) for k in self.mean_sizes]

    @property
    def feature_names(self) -> list[str]:
        return [*CALENDAR_FEATURES, *self.mean_names, *self.lag_names]

    @property
    def every_us(self) -> int:
        return self.every // timedelta(microseconds=1)

    @property
    def block_us(self) -> int:
        return self.every_us * self.block_rows

    @property
    def series_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.series_col, T.StringType()),
                T.StructField(self.time_col, T.TimestampNTZType()),
                T.StructField(self.target_col, T.DoubleType()),
            ]
        )

    @property
    def forecast_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.series_col, T.StringType()),
                T.StructField(self.time_col, T.TimestampNTZType()),
                T.StructField("forecast", T.DoubleType()),
            ]
        )


LINEAGE_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("data_location", T.StringType()),
        T.StructField("data_start", T.TimestampNTZType()),
        T.StructField("data_end", T.TimestampNTZType()),
        T.StructField("data_max", T.TimestampNTZType()),
        T.StructField("when_trained", T.TimestampType()),
        T.StructField("params", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("untuned_rmse", T.DoubleType()),
    ]
)


def lag_name(k: int) -> str:
    return f"lag_{k}"


def mean_name(k: int) -> str:
    return f"avg_{k}_lags"
