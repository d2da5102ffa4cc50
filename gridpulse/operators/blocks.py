"""Order-dependent work on time blocks instead of whole series.

A window over a whole series runs in one task per series. The helpers here cut a series into time
blocks of ``spec.block_rows`` grid slots, so the unit of work is ``(series, block)``, and bring in
from outside a block only what it needs: a per-series value, or the rows just before it. A block bounds
grid slots, so it bounds rows once keys are unique. What is gathered per series is one row per block,
and up to ``n`` rows per block where preceding rows are carried over holes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpulse.functions.timegrid import block_of, micros
from gridpulse.spec import SeriesSpec

BLOCK = "_block"
HALO = "_halo"


def with_block(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.withColumn(BLOCK, block_of(F.col(spec.time_col), spec))


def attach_per_series(
    rows: DataFrame, per_series: DataFrame, spec: SeriesSpec, how: str = "inner"
) -> DataFrame:
    """Join a one-row-per-series table to ``rows``, which are read once.

    No broadcast is forced: Spark takes it if the measured size of the table allows. Otherwise the rows
    of a hot series are split by adaptive execution's skew join, however many fall into one block.
    """
    return rows.join(per_series, spec.series_col, how)


def attach_series_aggregates(
    rows: DataFrame, spec: SeriesSpec, **aggregates: tuple[str, str]
) -> DataFrame:
    """Attach per-series ``min`` or ``max`` values, given as ``name=("max", column)``.

    The aggregate is combined before its shuffle, so a hot series sends one row from each task.
    """
    functions = {"min": F.min, "max": F.max}
    per_series = rows.groupBy(spec.series_col).agg(
        *[functions[fn](column).alias(name) for name, (fn, column) in aggregates.items()]
    )
    return attach_per_series(rows, per_series, spec)


def with_preceding_rows(
    df: DataFrame, spec: SeriesSpec, n: int, gap_free: bool = False
) -> DataFrame:
    """Give every block its own rows and the ``n`` rows of the series just before them.

    Adds ``_block`` and ``_halo``; copied rows have ``_halo`` set. The result is partitioned by
    ``(series, block)``, so row frames that reach back at most ``n`` rows are exact over
    ``PARTITION BY series, _block ORDER BY time``, once ``_halo`` rows are dropped. Keys
    ``(series, time)`` must be unique.

    With ``gap_free`` the caller states that no series has a hole or an off-grid row, as after
    ``densify``. Then the preceding rows are exactly the last ``n`` slots of the block before, and
    each row knows by itself whether it must be copied. Otherwise the last rows of each block are
    found first (ranked before the shuffle), which is exact for holes of any length.
    """
    key = [spec.series_col, BLOCK]
    columns = df.columns
    if gap_free and n <= spec.block_rows:
        block = block_of(F.col(spec.time_col), spec)
        next_start = (F.col("_own") + 1) * spec.block_us
        in_tail = micros(F.col(spec.time_col)) >= next_start - n * spec.every_us
        targets = F.when(in_tail, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(
            F.array(F.col("_own"))
        )
        return (
            df.withColumn("_own", block)
            .withColumn(BLOCK, F.explode(targets))
            .withColumn(HALO, F.col(BLOCK) != F.col("_own"))
            .select(*columns, BLOCK, HALO)
            .repartition(*key)
        )
    blocked = with_block(df, spec)
    newest_first = Window.partitionBy(*key).orderBy(F.col(spec.time_col).desc())
    payload = F.struct(spec.time_col, *[c for c in columns if c not in spec.key])
    tails = (
        blocked.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= n)
        .groupBy(*key)
        .agg(F.collect_list(payload).alias("_tail"))
    )
    # Every earlier block holds at least one row, so the n blocks before suffice.
    earlier = Window.partitionBy(spec.series_col).orderBy(BLOCK).rowsBetween(-n, -1)
    newest = F.sort_array(F.flatten(F.collect_list("_tail").over(earlier)), asc=False)
    carried = (
        tails.select(*key, F.slice(newest, 1, n).alias("_carry"))
        .select(*key, F.explode("_carry").alias("_row"))
        .select(*key, "_row.*", F.lit(True).alias(HALO))
    )
    return blocked.withColumn(HALO, F.lit(False)).unionByName(carried).repartition(*key)


def global_row_index(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Number the rows of a table of distinct timestamps from 0, adding ``_index`` and ``_total``.

    Rows are numbered inside their block and shifted by the rows of earlier blocks, so only the
    table of block counts is ever gathered in one place.
    """
    blocked = with_block(df, spec)
    counts = blocked.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(BLOCK).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = counts.select(
        BLOCK,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(everything).alias("_total"),
    )
    inside: Column = F.row_number().over(Window.partitionBy(BLOCK).orderBy(spec.time_col)) - 1
    return (
        blocked.join(offsets, BLOCK)
        .withColumn("_index", inside + F.col("_offset"))
        .drop(BLOCK, "_offset")
    )
