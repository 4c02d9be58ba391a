"""The thin ``opN_<name>`` queries over the given tables, whole and unfiltered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, decontaminate, filter_audit, language, oracle, packing, pieces,
               quality_compression, quality_rules, secrets, sharding, simhash, token_count, toxicity)
from .common import fold, read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    profiles = language.learn_profiles(docs.filter(fold("doc_id", 4) != 2))
    out = language.identify(docs, profiles)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read(spark, sf_dir, "documents"), parts=True)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op3_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"), shards=24)


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), capacity=1024, end_id=2)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "posterior")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = quality_compression.learn(docs.filter(fold("doc_id", 3) != 1),
                                      labels.filter(fold("doc_id", 3) != 1))
    out = quality_compression.score(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.learn(docs.filter(fold("doc_id", 5) != 0), labels.filter(fold("doc_id", 5) != 0))
    out = toxicity.score(docs, model)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read(spark, sf_dir, "documents"), limit=512)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    ids = rows.select(rows["conv_id"].alias("conv"))
    return conversation_repair.repair(conversation_repair.damage(rows), ids).withColumnRenamed("conv", "conv_id")


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoding_digests(read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_secret_scan, op3_balanced_shards, op4_simhash_dedup, op5_decontamination,
    op6_best_fit_packing, op7_quality_rules, op8_quality_classifier, op9_toxicity, op10_token_counts,
    op11_filter_audit, op12_conversation_repair, op13_sentencepiece)}

#: Only where SQL gives the same rows; the others are tested by brute force.
ORACLE_SQL: dict[str, str] = {"op11_filter_audit": oracle.FILTER_AUDIT,
                              "op12_conversation_repair": oracle.CONVERSATION_REPAIR}
