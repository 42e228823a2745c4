"""Registered queries of the subpackage and their DuckDB checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklab.llm import chat, decontaminate, embeddings, line_dedup, lm, merkle, minhash, mixing, pii, quality, substring, toxicity, trie
from sparklab.llm.common import read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return d.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.cut_repeats(read(spark, sf_dir, "documents"), keep_text=False)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.labelled_mix(spark, read(spark, sf_dir, "documents"), sf_dir)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.redact(read(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = minhash.near_duplicates(read(spark, sf_dir, "documents"), k=2)
    return d.select("doc_id", "n_shingles", "component_id", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.dedup(read(spark, sf_dir, "embeddings"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered(read(spark, sf_dir, "documents"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = chat.read_chats(chat.format_chats(chat.with_probe(read(spark, sf_dir, "conversations"))))
    return d.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_quality, op3_substring_dedup, op4_mixing, op5_pii, op6_minhash_near_dedup, op7_toxicity, op8_lm_score,
                                 op9_decontamination, op10_embedding_dedup, op11_merkle_manifest, op12_chat_format, op13_prefix_trie)}
SQL = {"op1_line_dedup": line_dedup.SQL, "op4_mixing": mixing.SQL, "op11_merkle_manifest": merkle.SQL, "op12_chat_format": chat.SQL, "op13_prefix_trie": trie.SQL}
