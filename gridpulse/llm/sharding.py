"""Proportional stratified interleaving: every shard holds the sources in the mixture of the whole.

Rows are shuffled by a seeded hash inside their source, a row's fractional rank is (rank - 1/2) / rows
of the source, and the order by fractional rank is cut into shards of equal row counts (law ``rows``).
DataFrame operations only.

No rank is taken over a whole source or the whole table: hash buckets hold a bounded share of the rows,
their counts are summed to offsets, and rows are ranked inside buckets. Only ids, sizes and checksums
are shuffled, never texts.

Null source is a source of its own, null text has size 1 and checksum 0. Rows that agree in id, size
and checksum are interchangeable. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import cut, pick

LAW = "rows"
GROUP = 256


def shuffle_key(id_col: str, seed: int) -> Column:
    """60 bits of a seeded hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def bucket_count(rows: int) -> int:
    """A power of two: buckets of at most some thousands of rows, whose counts stay few."""
    return 1 << max(7, (rows // 4096).bit_length())


def offsets(buckets: DataFrame, keys: list[str], bucket: str, value: str) -> DataFrame:
    """Rows before each bucket (``before``) and in all buckets (``total``) of a key.

    Summed over groups of buckets first, so that a window holds a group's buckets or the groups.
    """
    grouped = buckets.withColumn("grp", F.expr(f"{bucket} div {GROUP}"))
    groups = grouped.groupBy(*keys, "grp").agg(F.sum(value).alias("in_grp"))
    order = Window.partitionBy(*keys, F.lit(0)).orderBy("grp")
    groups = groups.select(
        *keys,
        "grp",
        (F.sum("in_grp").over(order) - F.col("in_grp")).alias("grp_before"),
        F.sum("in_grp").over(Window.partitionBy(*keys, F.lit(0))).alias("total"),
    )
    inner = Window.partitionBy(*keys, "grp").orderBy(bucket)
    return grouped.join(groups, [*keys, "grp"]).select(
        *keys,
        bucket,
        (F.col("grp_before") + F.sum(value).over(inner) - F.col(value)).alias("before"),
        "total",
    )


def interleave(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shards: int = 8,
    seed: int = 20,
) -> DataFrame:
    """Id, size, text_crc32, law, shard, slot, grown_shard of every row, with its source."""
    rows = pick(df, id=id_col, text=text_col, source=source_col).select(
        "id",
        "source",
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("stratum"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        shuffle_key("id", seed).alias("key"),
    )
    rows = cut(rows)
    n = rows.count()
    buckets = bucket_count(n)
    rows = rows.withColumn("bucket", F.shiftright("key", 60 - buckets.bit_length() + 1).cast("int"))
    first = offsets(rows.groupBy("stratum", "bucket").agg(F.count("*").alias("n")), ["stratum"], "bucket", "n")
    inside = Window.partitionBy("stratum", "bucket").orderBy("key", "id", "size", "text_crc32")
    ranked = rows.join(first, ["stratum", "bucket"]).withColumn("rank", F.col("before") + F.row_number().over(inside))
    ranked = cut(
        ranked.select(
            "id",
            "source",
            "stratum",
            "size",
            "text_crc32",
            "key",
            ((F.col("rank") - 0.5) / F.col("total")).alias("fraction"),
        ).withColumn("slice", F.floor(F.col("fraction") * buckets).cast("int"))
    )
    second = offsets(ranked.groupBy("slice").agg(F.count("*").alias("n")), [], "slice", "n")
    inside = Window.partitionBy("slice").orderBy("fraction", "stratum", "key", "id", "size", "text_crc32")
    placed = ranked.join(second, "slice").withColumn("place", F.col("before") + F.row_number().over(inside) - 1)
    shard = F.expr(f"cast(place * {shards} div {max(n, 1)} as int)")
    return placed.withColumn("shard", shard).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("place") - F.expr(f"(shard * {n}L + {shards - 1}) div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("source").alias("stratum_source"),
    )
