import pytest
from pyspark.sql import types as T

DOC = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
])


@pytest.fixture(scope="session")
def frames(spark):
    """Make small tables; ``extra`` adds columns whose names operators use inside."""

    class Frames:
        def docs(self, rows, extra=False):
            rows = [(i, text, *(rest or ("en", "a"))) for i, text, *rest in rows]
            df = spark.createDataFrame(rows, DOC).repartition(3)
            if extra:
                names = "id key bucket class sig score piece n vec shard number grp rank y s0 text_crc32".split()
                df = df.selectExpr("*", *[f"'x' AS `{n}`" for n in names])
            return df

        def vectors(self, rows, extra=False):
            df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(3)
            return df.selectExpr("*", *[f"'x' AS `{n}`" for n in ("id", "vec", "part", "n", "class")]) if extra else df

        def pages(self, rows, extra=False):
            df = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").repartition(3)
            return df.selectExpr("*", "'x' AS digest", "'x' AS refers_to") if extra else df

    return Frames()


ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n  "),
    (4, "The The the, don't 12½ <|endoftext|>x é é İ ΣΑΣ \x1c   中文 ß!"),
    (5, "word " * 30_000),
    (6, "x" * 70_000),
    (7, "ab" * 500 + " " + "cd!" * 40_000),
    (7, "ab" * 500 + " " + "cd!" * 40_000),
    (None, "no id here"),
]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD
