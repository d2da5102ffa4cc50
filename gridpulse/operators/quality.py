"""Quality checks of a panel before it is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.functions.timegrid import micros, phase_of
from gridpulse.spec import SeriesSpec


class QualityError(ValueError):
    """A panel failed its checks and must not be written."""


def quality_report(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row of counts: rows, nulls, NaNs, duplicated rows, duplicated keys, missing grid slots.

    ``duplicate_rows`` counts every copy of a row that occurs more than once, ``duplicate_keys`` every
    row whose ``(series, time)`` is shared. ``missing_slots`` counts the grid slots from a series' first
    to its last row that hold no row; a row off that grid fills none.
    All levels are aggregates, so duplicates are combined before they are shuffled.
    """
    series, time, target = spec.columns
    rows = df.select(*spec.columns).groupBy(*spec.columns).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    per_key = rows.groupBy(series, time).agg(
        F.sum(n).alias("n"),
        counted(n > 1).alias("copies"),
        counted(F.col(target).isNull()).alias("null_targets"),
        counted(F.isnan(target)).alias("nan_targets"),
    )
    per_phase = per_key.groupBy(series, phase_of(F.col(time), spec).alias("_phase")).agg(
        F.sum(n).alias("rows"),
        counted(F.col(time).isNull()).alias("null_times"),
        F.sum("null_targets").alias("null_targets"),
        F.sum("nan_targets").alias("nan_targets"),
        F.sum("copies").alias("copies"),
        counted(n > 1).alias("shared"),
        F.count(time).alias("slots"),
        F.min(time).alias("first"),
        F.max(time).alias("last"),
    )
    # The grid is that of the series' first row.
    per_series = per_phase.groupBy(series).agg(
        *[F.sum(c).alias(c) for c in ("rows", "null_times", "null_targets", "nan_targets", "copies", "shared")],
        F.min_by("slots", "first").alias("slots"),
        (micros(F.max("last")) - micros(F.min("first"))).alias("range_us"),
    )
    expected = F.call_function("div", F.col("range_us"), F.lit(spec.every_us)) + 1

    def total(column: Column | str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    return per_series.agg(
        total("rows").alias("rows"),
        total(F.when(F.col(series).isNull(), F.col("rows"))).alias("null_series"),
        total("null_times").alias("null_times"),
        total("null_targets").alias("null_targets"),
        total("nan_targets").alias("nan_targets"),
        total("copies").alias("duplicate_rows"),
        total("shared").alias("duplicate_keys"),
        total(F.greatest(F.lit(0), expected - F.col("slots"))).alias("missing_slots"),
    )


def schema_matches(df: DataFrame, stored: T.StructType) -> bool:
    """Same column names, order and types; nullability is not compared."""

    def shape(schema: T.StructType) -> list[tuple[str, T.DataType]]:
        return [(field.name, field.dataType) for field in schema.fields]

    return shape(df.schema) == shape(stored)


def assert_quality(
    df: DataFrame, spec: SeriesSpec, stored: T.StructType | None = None, allow_nan: bool = True
) -> DataFrame:
    """Raise ``QualityError`` on a schema change, a fully duplicated row or a null; else return ``df``.

    A NaN target passes unless ``allow_nan`` is off; feature frames and training leave it out.
    """
    if stored is not None and not schema_matches(df, stored):
        raise QualityError(f"schema differs from the stored table: {df.schema.simpleString()}")
    report = quality_report(df, spec).first()
    if report["duplicate_rows"]:
        raise QualityError(f"{report['duplicate_rows']} duplicate rows")
    checked = ["null_series", "null_times", "null_targets", *([] if allow_nan else ["nan_targets"])]
    empty = {c: report[c] for c in checked if report[c]}
    if empty:
        raise QualityError(f"cells without a value: {empty}")
    return df
