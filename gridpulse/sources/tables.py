"""Parquet tables that only ever grow: read with a known schema, probe, append, cut lineage."""

from __future__ import annotations

import tempfile
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.functions.timegrid import ntz
from gridpulse.spec import SeriesSpec

DATE = "event_date"


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if ``path`` exists on the cluster's file system."""
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def has_rows(spark: SparkSession, path: str) -> bool:
    """True if a table's folder holds any date folder, beside files of its writers."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/{DATE}=*")
    return bool(pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern))


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    time_col: str | None = None,
    since: datetime | Column | None = None,
) -> DataFrame:
    """Read a table; ``since`` bounds its time column and prunes the date folders before it."""
    if time_col is None:
        return spark.read.schema(schema).parquet(path)
    stored = spark.read.schema(T.StructType([*schema.fields, T.StructField(DATE, T.DateType())]))
    df = stored.parquet(path)
    if since is not None:
        bound = ntz(since) if isinstance(since, datetime) else since
        df = df.where((F.col(DATE) >= F.to_date(bound)) & (F.col(time_col) >= bound))
    return df.select(*schema.fieldNames())


def append_series(df: DataFrame, path: str, spec: SeriesSpec) -> None:
    """Append rows under their date, sorted by key inside each file.

    Nothing stored is rewritten. Rebalancing by date lets adaptive execution merge small dates and
    split large ones, so files come out near the advisory partition size.
    """
    (
        df.withColumn(DATE, F.to_date(spec.time_col))
        .hint("rebalance", DATE)
        .sortWithinPartitions(DATE, *spec.key)
        .write.mode("append")
        .partitionBy(DATE)
        .parquet(path)
    )


def append_plain(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Only a local session without it gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="gridpulse-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably in the session's checkpoint folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
