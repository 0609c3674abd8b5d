"""Registered queries of the dealt operators, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import (alignment, bpe, chat, fingerprint, licenses, lm, mixing, ngram_join, periodic, pii,
                       quality, sharding, superminhash)
from vigil.llm.common import documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op1_query(documents(spark, sf_dir))


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op2_query(documents(spark, sf_dir))


def op3_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op3_query(spark, _table(spark, sf_dir, "conversations"))


def op4_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.op4_query(documents(spark, sf_dir))


def op5_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.op5_query(documents(spark, sf_dir))


def op6_distinct_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op6_query(documents(spark, sf_dir))


def op7_systematic_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op7_query(documents(spark, sf_dir))


def op8_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.op8_query(documents(spark, sf_dir))


def op9_license_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op9_query(documents(spark, sf_dir))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.op10_query(documents(spark, sf_dir))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.op11_query(documents(spark, sf_dir))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.op12_query(documents(spark, sf_dir))


def op13_superminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.op13_query(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_label_propagation_shards, op2_compression_bands, op3_event_sourced_chat, op4_ppm_scoring,
        op5_skip_chain_pii, op6_distinct_word_bpe, op7_systematic_mixing, op8_multiset_fingerprint,
        op9_license_join, op10_ngram_join, op11_cross_tokenizer_alignment,
        op12_periodic_runs, op13_superminhash_near_dedup)}
ORACLE: dict[str, str] = {
    "op3_event_sourced_chat": chat.OP3_SQL,
    "op7_systematic_mixing": mixing.OP7_SQL,
    "op10_ngram_join": ngram_join.OP10_SQL,
    "op12_periodic_runs": periodic.OP12_SQL,
    "op13_superminhash_near_dedup": superminhash.OP13_SQL,
}
