"""The corpus pipeline: quality rules, exact dedup, near-dedup, substring dedup and packing of whole documents.

Each stage works on all rows that its predecessor kept. run() writes each stage's result as Parquet in the shared folder
and reads it back as the next one's input.

Defined results: null and empty texts fail the quality rules and go; rows that repeat doc_id and text are one document from
exact dedup on; of equal or near texts the smallest doc_id stays, and a document without an id only where no other has its
text; a null lang or source is a group of its own in the quality rules; whole texts of any length are read; an empty table
gives an empty result; further columns are carried through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viaduct.llm import exact_dedup, packing, quality, simhash, substrings
from viaduct.llm.common import settle, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the fences of their language and source."""
    return quality.keep(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the one with the smallest doc_id."""
    index = exact_dedup.fresh_index(spark)
    out = exact_dedup.keep_first(docs, index)
    index.drop()
    return out


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest doc_id."""
    return simhash.keep_first(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document of a smaller doc_id has; emptied ones stay, as empty texts."""
    return substrings.remove(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality rules", quality_rules), ("exact dedup", exact), ("near-dedup", near), ("substring dedup", substring), ("packing", pack)]

#: SQL can't express the stages of tokens, fingerprints and components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
