"""A corpus pipeline: each stage calls one operator and hands the kept documents on as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridpulse.llm import langid
from gridpulse.llm.common import cut, pick, table
from gridpulse.llm.minhash import one_of_each
from gridpulse.llm.packing import pack
from gridpulse.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose calibrated quality score is 0.3 or more."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is one that the corpus declares, with a score of 0.5 or more."""
    return langid.keep_known(docs, langid.fit(pick(docs, id="doc_id", lang="lang", text="text")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more of five-word shingles."""
    return one_of_each(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its place in a sequence of at most 4096 tokens."""
    return pack(docs)


STAGES = [("quality", quality), ("language", language), ("near_dedup", near_dedup), ("packing", packing)]

#: No stage can be written in SQL: models, hashing and packing; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's result is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if number == len(STAGES) - 1 else cut(out)
    return docs
