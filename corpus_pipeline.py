"""The corpus pipeline: language ID, near-dedup, decontamination, mixing to target weights, sharding.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sievespark.llm import decontamination, language_id, mixing, near_dedup, sharding
from sievespark.session import cut_lineage, drop, read_table

SHARDS = [f"shard-{i:03d}" for i in range(128)]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language."""
    return language_id.accepted(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, a similarity of 0.8 or more."""
    return near_dedup.keep_one(docs, width=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    return decontamination.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents, some of them twice, until the sources stand in their target weights."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's slot and shard."""
    return sharding.place(docs, "doc_id", SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Language ID and MinHash cannot be written in SQL; a test holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table goes once the next one is written."""
    docs, held = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs)
            drop(*held)
            held = [docs]
    return docs
