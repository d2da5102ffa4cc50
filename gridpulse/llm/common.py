"""Helpers shared by the operators: the shared folder, cut plans, bounded samples, text columns."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_SHIPPED: set[str] = set()
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession, batch_rows: int = 1000) -> None:
    """Give the executors this package, once an application; tasks import it by name.

    Rows hold whole documents, so the session's Arrow batches are kept to ``batch_rows`` at most.
    """
    context = spark.sparkContext
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= batch_rows:
        spark.conf.set(BATCH_ROWS, str(batch_rows))
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own, a cluster fails."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridpulse-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, release: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The rows are computed once, later plans start at the files, and a lost executor costs only the
    tasks it ran. The files live as long as that folder. With ``release`` the shuffle files behind them
    go once they are written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/gridpulse/{uuid.uuid4().hex}"
    before = spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, str(release or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: str, n: int) -> Column:
    """crc32 of a column's decimal text, modulo ``n``; a null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def hashed_share(col: Column, bound: int, total: int, seed: str) -> Column:
    """True for about ``bound`` of ``total`` rows, chosen by a hash of ``col``: the same rows on every run."""
    if total <= bound:
        return F.lit(True)
    grain = 1 << 30
    return F.pmod(F.xxhash64(F.lit(seed), col), F.lit(grain)) < F.lit(int(grain * bound / total))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names, so that extra columns never clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))
