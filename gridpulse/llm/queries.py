"""The registered queries ``opN_<name>``: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm import flat_graph, langid, learned_partitions, oracle, warc
from gridpulse.llm.bpe import round_trip
from gridpulse.llm.common import crc_mod, pick, table
from gridpulse.llm.merkle import verified_manifest
from gridpulse.llm.minhash import near_duplicates
from gridpulse.llm.packing import pack
from gridpulse.llm.quality import quality_scores
from gridpulse.llm.repair import repair
from gridpulse.llm.sharding import interleave
from gridpulse.llm.substrings import remove_repeats
from gridpulse.llm.tokencount import token_counts


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod("doc_id", 3) == 1
    model = langid.fit(pick(docs.where(~held_out), id="doc_id", lang="lang", text="text"))
    found = langid.predict(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_flat_graph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=4).drop("text_key")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    want = ("n_tokens", "ids_sha256", "decoded_sha256")
    return round_trip(table(spark, sf_dir, "documents"), want=want)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified_manifest(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), want=("n_words", "n_removed", "kept_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_learned_partitions,
        op2_language_id,
        op3_flat_graph_dedup,
        op4_minhash_dedup,
        op5_bpe_round_trip,
        op6_best_fit_packing,
        op7_warc_round_trip,
        op8_token_counts,
        op9_quality_classifier,
        op10_stratified_shards,
        op11_merkle_manifest,
        op12_substring_dedup,
        op13_conversation_repair,
    )
}

SQL: dict[str, str] = {
    "op3_flat_graph_dedup": oracle.vector_duplicates(0.95),
    "op4_minhash_dedup": oracle.near_duplicates(4, 80),
    "op7_warc_round_trip": oracle.WARC,
    "op10_stratified_shards": oracle.shards(8, 20),
    "op11_merkle_manifest": oracle.MERKLE,
    "op12_substring_dedup": oracle.repeated_windows(13),
    "op13_conversation_repair": oracle.conversation_repair(),
}
