"""Panels derived from general event and order tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.functions.timegrid import floor_time
from gridpulse.spec import SeriesSpec

PANEL = SeriesSpec(series_col="series", time_col="ts", target_col="y")
DAILY = SeriesSpec(
    series_col="series", time_col="ts", target_col="y", every=timedelta(days=1),
    lookback=timedelta(days=365),
)

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
ORDERS_SCHEMA = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def _exact_sum(column: str):
    """Sum of two-decimal amounts, exact and so independent of the order of addition."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a reading of its type's series at its own time."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("series"), "ts", F.col("value").alias("y")
    )


def hourly_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a reading at its full hour: many readings share a key."""
    return event_readings(spark, sf_dir).withColumn("ts", floor_time(F.col("ts"), PANEL.every))


def hourly_group_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``hourly_readings``, with one series per event type and group of users."""
    group = F.concat_ws("-", "event_type", F.pmod("user_id", F.lit(10)).cast("string"))
    return events(spark, sf_dir).select(
        group.alias("series"),
        floor_time(F.col("ts"), PANEL.every).alias("ts"),
        F.col("value").alias("y"),
    )


def hourly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly value per event type."""
    return hourly_readings(spark, sf_dir).groupBy("series", "ts").agg(_exact_sum("y").alias("y"))


def hourly_group_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly value per event type and group of users: more series, with gaps at every scale."""
    return (
        hourly_group_readings(spark, sf_dir)
        .groupBy("series", "ts")
        .agg(_exact_sum("y").alias("y"))
    )


def daily_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily order value per priority."""
    orders = spark.read.schema(ORDERS_SCHEMA).parquet(f"{sf_dir}/orders.parquet")
    return (
        orders.select(
            F.col("o_orderpriority").alias("series"),
            floor_time(F.col("o_orderdate"), DAILY.every).alias("ts"),
            F.col("o_totalprice").alias("y"),
        )
        .groupBy("series", "ts")
        .agg(_exact_sum("y").alias("y"))
    )
