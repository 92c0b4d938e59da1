"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, fingerprints, language, lexical, packing, quality, resampling, sharding, simhash, substrings, token_counts, toxicity
from .common import table
from .queries_sql import OP2_SQL, OP7_SQL, OP9_SQL, OP11_SQL, OP12_SQL


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.classes(table(spark, sf_dir, "documents"))
    return marked.selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) as fingerprint", "component_id", "component_size")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table goes into a new index in two batches, so the second one is decided by the anti-join."""
    index = exact_dedup.fresh_index(spark)
    out = exact_dedup.dedup_table(table(spark, sf_dir, "documents"), index)
    index.drop()
    return out


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = [op1_packing, op2_sharding, op3_bpe, op4_token_counts, op5_simhash, op6_substrings, op7_exact_dedup, op8_toxicity, op9_quality, op10_language, op11_resampling, op12_search, op13_fingerprints]
    return {f.__name__: f for f in each}


def oracle_sql() -> dict[str, str]:
    return {"op2_sharding": OP2_SQL, "op7_exact_dedup": OP7_SQL, "op9_quality": OP9_SQL, "op11_resampling": OP11_SQL, "op12_search": OP12_SQL}
