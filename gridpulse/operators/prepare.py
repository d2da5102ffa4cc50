"""From raw readings to a regular panel: align, clip, de-duplicate, densify, fill."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridpulse.functions.timegrid import (
    block_of,
    floor_time,
    from_micros,
    micros,
    ntz,
    phase_of,
    shift,
)
from gridpulse.operators.blocks import (
    BLOCK,
    attach_per_series,
    attach_series_aggregates,
    with_block,
)
from gridpulse.spec import SeriesSpec


def shift_hours(first_ts: Column, spec: SeriesSpec) -> Column:
    """Whole hours from a series' first timestamp to the anchor, truncated toward zero."""
    distance = micros(ntz(spec.anchor)) - micros(first_ts)
    return F.call_function("div", distance, F.lit(3_600_000_000))


def align_series_start(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Move every series by whole hours so that it starts at the anchor; sub-hour phase is kept."""
    ts = F.col(spec.time_col)
    return attach_series_aggregates(df, spec, _first=("min", spec.time_col)).select(
        *[
            F.timestamp_add("HOUR", shift_hours(F.col("_first"), spec), ts).alias(c)
            if c == spec.time_col
            else F.col(c)
            for c in df.columns
        ]
    )


def clip_time_range(df: DataFrame, spec: SeriesSpec, as_of: datetime) -> DataFrame:
    """Rows in ``[as_of - lookback, as_of]``, both ends included."""
    return df.where(
        F.col(spec.time_col).between(ntz(as_of - spec.lookback), ntz(as_of))
    )


def align_and_clip(df: DataFrame, spec: SeriesSpec, as_of: datetime) -> DataFrame:
    """``align_series_start`` then ``clip_time_range``, without moving rows outside the window.

    The window is first turned back into raw time. Its widest bounds over all series are scalar
    subqueries that reach the scan as filters; the exact per-series test follows. The first time of
    each series, from which the shift comes, still takes a pass over the keys of the whole history.
    """
    ts = F.col(spec.time_col)
    shifts = df.groupBy(spec.series_col).agg(
        shift_hours(F.min(ts), spec).alias("_hours")
    )
    start, end = ntz(as_of - spec.lookback), ntz(as_of)
    oldest = shifts.agg(F.timestamp_add("HOUR", -F.max("_hours"), start)).scalar()
    newest = shifts.agg(F.timestamp_add("HOUR", -F.min("_hours"), end)).scalar()
    candidates = df.where((ts >= oldest) & (ts <= newest))
    moved = attach_per_series(candidates, shifts, spec).withColumn(
        spec.time_col, F.timestamp_add("HOUR", F.col("_hours"), ts)
    )
    return clip_time_range(moved.select(*df.columns), spec, as_of)


def dedup_keep_first(
    df: DataFrame, spec: SeriesSpec, order: list[str] | None = None
) -> DataFrame:
    """One row per ``(series, time)``: the first by ``order``, nulls last.

    The default order is the target, ascending. It is an aggregate, so duplicates of a hot key are
    combined before the shuffle.
    """
    others = [c for c in df.columns if c not in spec.key]
    if len(others) == 1 and (order is None or order == others):
        return df.groupBy(*spec.key).agg(F.min(others[0]).alias(others[0]))
    ranking = []
    for name in order or [spec.target_col]:
        ranking += [F.col(name).isNull(), F.col(name)]
    first = F.min_by(F.struct(*others), F.struct(*ranking, *others))
    return df.groupBy(*spec.key).agg(first.alias("_first")).select(*spec.key, "_first.*")


def _block_heads(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per grid block of a series, from its first to its last slot.

    Columns: series, ``_block``, ``_slot`` (first grid slot in the block), ``_stop`` (last grid slot
    in the block), ``_phase`` and ``_carry`` (last known value of earlier blocks).
    """
    ts = F.col(spec.time_col)
    series = spec.series_col
    every = spec.every_us
    bounds = rows.groupBy(series).agg(
        micros(F.min(ts)).alias("_start"), micros(F.max(ts)).alias("_end")
    )
    by_phase = (
        with_block(rows, spec)
        .withColumn("_phase", phase_of(ts, spec))
        .groupBy(series, BLOCK, "_phase")
        .agg(
            F.max_by(spec.target_col, F.when(F.col(spec.target_col).isNotNull(), ts)).alias("_tail"),
        )
    )
    start, end = F.col("_start"), F.col("_end")
    grid_end = end - F.pmod(end - start, F.lit(every))
    ordered = Window.partitionBy(series).orderBy(BLOCK)
    occupied = (
        by_phase.join(bounds, series)
        .where(F.col("_phase") == F.pmod(start, F.lit(every)))
        .select(
            "*",
            grid_end.alias("_grid_end"),
            F.last("_tail", ignorenulls=True)
            .over(ordered.rowsBetween(Window.unboundedPreceding, -1))
            .alias("_before"),
            F.lead(BLOCK).over(ordered).alias("_next"),
        )
    )
    last_block = block_of(from_micros(F.col("_grid_end")), spec)
    # An occupied block also opens the empty blocks up to the next occupied one.
    opened = occupied.withColumn(
        "_head",
        F.explode(F.sequence(F.col(BLOCK), F.coalesce(F.col("_next") - 1, last_block))),
    )
    block_start = F.col("_head") * spec.block_us
    slot = F.greatest(start, block_start + F.pmod(start - block_start, F.lit(every)))
    stop = block_start + spec.block_us - 1
    stop = F.least(F.col("_grid_end"), stop - F.pmod(stop - start, F.lit(every)))
    return opened.select(
        series,
        F.col("_head").alias(BLOCK),
        from_micros(slot).alias("_slot"),
        from_micros(stop).alias("_stop"),
        "_phase",
        F.when(F.col("_head") == F.col(BLOCK), F.col("_before"))
        .otherwise(F.coalesce("_tail", "_before"))
        .alias("_carry"),
    ).where(F.col("_slot") <= F.col("_stop"))


def densify(df: DataFrame, spec: SeriesSpec, fill: bool = False) -> DataFrame:
    """One row per grid slot of each series, from its first row to its last.

    The grid starts at the series' first timestamp; off-grid rows vanish. New slots have a null
    target, or with ``fill`` the last known value before them (which also fills null targets).
    Keys must be unique. Rows and block heads are shuffled once by ``(series, block)``; a gap is
    produced block by block, so neither a long series nor a long gap is handled in one task.
    """
    key = [spec.series_col, BLOCK]
    ts, y = F.col(spec.time_col), F.col(spec.target_col)
    rows = df.select(*spec.columns)
    source = with_block(rows, spec).select(
        *key,
        ts,
        y,
        F.lit(True).alias("_real"),
        phase_of(ts, spec).alias("_phase"),
        F.lit(None).cast("timestamp_ntz").alias("_stop"),
    )
    heads = _block_heads(rows, spec).select(
        *key,
        F.col("_slot").alias(spec.time_col),
        F.col("_carry").alias(spec.target_col),
        F.lit(False).alias("_real"),
        "_phase",
        "_stop",
    )
    # The head sorts before a real row at the same slot and then covers no slot itself.
    ordered = Window.partitionBy(*key).orderBy(spec.time_col, "_real")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    on_grid = (
        source.unionByName(heads)
        .repartition(*key)
        .select(
            "*",
            F.max(F.when(~F.col("_real"), F.col("_phase"))).over(whole).alias("_grid"),
            F.max("_stop").over(whole).alias("_until"),
        )
        .where(F.col("_phase") == F.col("_grid"))
    )
    known = F.last(spec.target_col, ignorenulls=True).over(
        ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    next_ts = F.lead(ts).over(ordered)
    covered = (
        on_grid.select(
            "*",
            (known if fill else F.lit(None).cast("double")).alias("_known"),
            next_ts.alias("_next"),
        )
        .where(F.col("_real") | F.col("_next").isNull() | (F.col("_next") > ts))
    )
    last_slot = F.coalesce(shift(F.col("_next"), -spec.every), F.col("_until"))
    value = F.col("_known") if fill else F.when(F.col("_real") & (F.col("_slot") == ts), y)
    return covered.withColumn(
        "_slot", F.explode(F.sequence(ts, last_slot, F.lit(spec.every)))
    ).select(
        spec.series_col,
        F.col("_slot").alias(spec.time_col),
        value.alias(spec.target_col),
    )


def forward_fill(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Replace a null target by the last known one of the series; leading nulls stay."""
    key = [spec.series_col, BLOCK]
    ts, y = F.col(spec.time_col), F.col(spec.target_col)
    rows = with_block(df.select(*spec.columns), spec)
    tails = rows.groupBy(*key).agg(F.max_by(y, F.when(y.isNotNull(), ts)).alias("_tail"))
    earlier = (
        Window.partitionBy(spec.series_col)
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    heads = tails.select(
        *key,
        F.lit(None).cast("timestamp_ntz").alias(spec.time_col),
        F.last("_tail", ignorenulls=True).over(earlier).alias(spec.target_col),
        F.lit(False).alias("_real"),
    )
    upto = (
        Window.partitionBy(*key)
        .orderBy("_real", spec.time_col)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_real", F.lit(True))
        .unionByName(heads)
        .repartition(*key)
        .withColumn(spec.target_col, F.last(spec.target_col, ignorenulls=True).over(upto))
        .where("_real")
        .select(*spec.columns)
    )


def preprocess(df: DataFrame, spec: SeriesSpec, as_of: datetime) -> DataFrame:
    """Raw readings to a dense, filled panel over ``[as_of - lookback, as_of]``.

    Duplicated keys are resolved before the grid is built, so that a gap after a duplicated hour is
    filled with the value that was kept.
    """
    raw = df.select(*spec.columns)
    return (
        align_and_clip(raw, spec, as_of)
        .transform(dedup_keep_first, spec)
        .transform(densify, spec, fill=True)
    )


def bucket_times(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Round every timestamp down to the grid step."""
    return df.withColumn(spec.time_col, floor_time(F.col(spec.time_col), spec.every))
