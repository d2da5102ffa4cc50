"""Column arithmetic on zone-less timestamps: microseconds, grid slots and time blocks.

All of it is independent of the session time zone, because only TIMESTAMP_NTZ arithmetic is used.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridpulse.spec import SeriesSpec


def ntz(value: datetime) -> Column:
    """A naive datetime as a TIMESTAMP_NTZ literal (``lit`` alone would give a zoned timestamp)."""
    if value.tzinfo is not None:
        raise ValueError("expected a naive datetime")
    return F.expr(f"timestamp_ntz'{value.isoformat(sep=' ')}'")


EPOCH = datetime(1970, 1, 1)


def micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column."""
    seconds = (ts - ntz(EPOCH)).cast("interval second").cast("decimal(20,6)")
    return (seconds * 1_000_000).cast("bigint")


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, ntz(EPOCH))


def shift(ts: Column, by: timedelta) -> Column:
    return ts + F.lit(by)


def floor_time(ts: Column, every: timedelta) -> Column:
    """Start of the ``every``-long bucket (counted from 1970-01-01) that holds ``ts``."""
    us = micros(ts)
    return from_micros(us - F.pmod(us, F.lit(every // timedelta(microseconds=1))))


def block_of(ts: Column, spec: SeriesSpec) -> Column:
    """Number of the time block that holds ``ts``."""
    us = micros(ts)
    return F.call_function("div", us - F.pmod(us, F.lit(spec.block_us)), F.lit(spec.block_us))


def phase_of(ts: Column, spec: SeriesSpec) -> Column:
    """Offset of ``ts`` inside its grid step; rows of one grid share one phase."""
    return F.pmod(micros(ts), F.lit(spec.every_us))
