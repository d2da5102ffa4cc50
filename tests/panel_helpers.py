"""Small panels for the tests."""

from datetime import datetime, timedelta

T0 = datetime(2025, 1, 1)
HOUR = timedelta(hours=1)


def hours(n: float) -> datetime:
    return T0 + n * HOUR


def panel(spark, rows):
    """``(series, hour number, value)`` tuples as a DataFrame."""
    data = [(s, hours(h), None if v is None else float(v)) for s, h, v in rows]
    return spark.createDataFrame(data, "series STRING, ts TIMESTAMP_NTZ, y DOUBLE")


def as_dict(df, value="y"):
    return {(r["series"], r["ts"]): r[value] for r in df.collect()}
