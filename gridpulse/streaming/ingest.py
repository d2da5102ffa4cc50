"""Incremental ingest: every micro-batch adds the rows above each series' own watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridpulse.operators.prepare import dedup_keep_first
from gridpulse.operators.upsert import absent_rows, high_watermarks, new_rows_above_watermark
from gridpulse.sources.tables import append_series, has_rows, read_table, table_exists
from gridpulse.spec import SeriesSpec


def fresh_rows(
    batch: DataFrame, stored: DataFrame | None, spec: SeriesSpec, new_series: str = "admit"
) -> DataFrame:
    """Rows of a batch to be appended: one per key, later than what is stored."""
    unique = dedup_keep_first(batch.select(*spec.columns), spec)
    if stored is None:
        return unique
    return new_rows_above_watermark(unique, high_watermarks(stored, spec), spec, new_series)


def append_above_watermark(
    path: str,
    spec: SeriesSpec,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    new_series: str = "admit",
) -> Callable[[DataFrame, int], None]:
    """Body for ``foreachBatch``. A batch that is delivered again adds what is still missing of it.

    The watermarks a batch is judged by (one row per series) are stored before anything is appended.
    If a crash leaves only some of its date folders, the batch comes again, finds its own watermarks,
    and adds the rows whose keys are not stored yet.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = prepare(batch) if prepare else batch
        unique = dedup_keep_first(rows.select(*spec.columns), spec).persist()
        try:
            marks_path = f"{path}/_watermarks/batch-{batch_id}"
            again = table_exists(spark, f"{marks_path}/_SUCCESS")
            stored = read_stored(spark, path, spec)
            if not again:
                high_watermarks(stored, spec).write.mode("overwrite").parquet(marks_path)
            marks = spark.read.schema(high_watermarks(stored, spec).schema).parquet(marks_path)
            first = marks.isEmpty()
            fresh = unique if first else new_rows_above_watermark(unique, marks, spec, new_series)
            if again and not fresh.isEmpty():
                fresh = absent_rows(fresh, stored, spec)
            append_series(fresh, path, spec)
        finally:
            unique.unpersist()

    return body


def read_stored(spark: SparkSession, path: str, spec: SeriesSpec) -> DataFrame:
    """The stored rows; none if there is no table yet."""
    if table_exists(spark, path) and has_rows(spark, path):
        return read_table(spark, path, spec.series_schema, spec.time_col)
    return spark.createDataFrame([], spec.series_schema)


def start_ingest(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    spec: SeriesSpec,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    new_series: str = "admit",
    max_files: int | None = None,
) -> StreamingQuery:
    """Process what has arrived in ``source`` and stop.

    The watermark is per series, so it is kept in the stored table and not as a query-wide event-time
    watermark.
    """
    reader = spark.readStream.schema(spec.series_schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.parquet(source)
        .writeStream.foreachBatch(append_above_watermark(target, spec, prepare, new_series))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
