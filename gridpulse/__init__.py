"""Feature, forecast and monitoring operators for panels of regular time series, on Spark DataFrames."""

from gridpulse.spec import SeriesSpec

__all__ = ["SeriesSpec"]
