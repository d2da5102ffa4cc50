"""Run registered queries next to their SQL and compare: ``python tests/check_oracle.py [dir] [names]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(pdf) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = [tuple(None if pd.isna(v) else v for v in row) for row in pdf.itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str | None:
    """None if equal, else what differs."""
    got = contract.queries()[name](spark, sf_dir).toPandas()
    want = con.execute(contract.oracle_sql()[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if len(got) == 0:
        return "no rows"
    kinds = {
        c: (got[c].dtype, want[c].dtype)
        for c in got.columns
        # A null makes an engine choose another type for whole numbers.
        if got[c].dtype.kind != want[c].dtype.kind and not got[c].isna().any()
    }
    a, b = normal(got), normal(want)
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    if different:
        return f"{len(different)} of {len(a)} rows differ, first {different[0]}"
    return f"types {kinds}" if kinds else None


if __name__ == "__main__":
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(contract.oracle_sql())
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    for query in chosen:
        start = time.time()
        try:
            problem = compare(session, connection, query, directory)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{query}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
