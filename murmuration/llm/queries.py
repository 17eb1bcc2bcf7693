"""Registered queries of these operators, and SQL twins where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmuration.llm import alignment, chat, fingerprints, mixing, packing, periodic_runs, quality_rules, sharding, simhash, substring_dedup, token_output, topk_search, toxicity
from murmuration.sources.scratch import Scratch

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), BPE)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours(_documents(spark, sf_dir))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.near_duplicates(_documents(spark, sf_dir))
    return linked.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_documents(docs, model)


def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "token-output").at("files")
    token_output.write_token_files(_documents(spark, sf_dir), path, BPE)
    return token_output.read_token_files(spark, path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    docs = _documents(spark, sf_dir).withColumn("text_crc32", crc)
    placed = sharding.shard(docs, keep=("text_crc32",))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return chat.format_and_check(chat.with_trial(conversations))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.periodic_runs(_documents(spark, sf_dir), rewrite=periodic_runs.with_trial_period))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(_documents(spark, sf_dir), BPE, PIECES)


REGISTRY = {
    "op1_quality_rules": op1_quality_rules,
    "op2_packing": op2_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_fingerprints": op4_fingerprints,
    "op5_simhash": op5_simhash,
    "op6_toxicity": op6_toxicity,
    "op7_token_output": op7_token_output,
    "op8_sharding": op8_sharding,
    "op9_chat": op9_chat,
    "op10_mixing": op10_mixing,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_topk_search": op12_topk_search,
    "op13_alignment": op13_alignment,
}

ORACLES = {
    "op1_quality_rules": quality_rules.QUALITY_SQL,
    "op9_chat": chat.CHAT_SQL,
    "op10_mixing": mixing.MIX_SQL,
    "op11_periodic_runs": periodic_runs.RUNS_SQL,
    "op12_topk_search": topk_search.TOPK_SQL,
}
