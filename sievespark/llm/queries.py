"""The queries of this subpackage: thin digests over the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievespark.llm import chat_format, decontamination, language_id, lm_score, manifest, mixing, near_dedup, ranked_search, secrets, sharding, suffix_dedup, token_counts, topk_search
from sievespark.session import read_table

SHARDS = [f"shard-{i:03d}" for i in range(128)]


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


#: Tools whose calls the conversations may make.
TOOLS = {
    "search": {"type": "object", "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}}, "required": ["query"]},
    "calculate": {"type": "object", "properties": {"expression": {"type": "string"}}, "required": ["expression"], "additionalProperties": False},
    "reply": {"type": "object", "properties": {"turn": {"type": "integer", "minimum": 0}}, "required": ["turn"], "additionalProperties": False},
}


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's conversations hold no explicit call; their plain turns are linked as calls of ``reply`` and its results (in columns, not in the JSON)."""
    out = chat_format.format_messages(read_table(spark, sf_dir, "conversations"), TOOLS, reply="reply")
    return out.select("conv_id", "turn", "at", "level", "role", "answers_turn", F.size("problems").alias("n_problems"), "json")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return topk_search.top_k(rows, rows["vec_id"] % 50 == 0)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op8_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, "doc_id", SHARDS)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.top_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_documents(read_table(spark, sf_dir, "documents"))


def op13_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix, op2_token_counts, op3_chat, op4_topk, op5_suffix_dedup, op6_language, op7_secrets, op8_shard, op9_decontaminate, op10_near_dedup, op11_search, op12_manifest, op13_lm_score)}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": mixing.ORACLE, "op3_chat": chat_format.ORACLE, "op4_topk": topk_search.ORACLE, "op5_suffix_dedup": suffix_dedup.ORACLE, "op8_shard": sharding.oracle(SHARDS), "op9_decontaminate": decontamination.ORACLE, "op10_near_dedup": near_dedup.ORACLE, "op11_search": ranked_search.ORACLE, "op12_manifest": manifest.ORACLE}
