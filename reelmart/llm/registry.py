"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmart.llm import conversation_repair, decontaminate, filter_audit, jaccard, kneser_ney, language, licenses
from reelmart.llm import line_dedup, mixing, repetition, secret_scan, sharding, url_rules
from reelmart.llm import oracle


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("th")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op8_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(table(spark, sf_dir, "conversations"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_secrets, op2_licenses, op3_language, op4_quality, op5_decontaminate, op6_mix, op7_jaccard, op8_repetition, op9_shard, op10_url_rules,
        op11_conversations, op12_lines, op13_filter_audit)}
ORACLE: dict[str, str] = {"op6_mix": oracle.OP6, "op7_jaccard": oracle.OP7,
                          "op8_repetition": oracle.OP8, "op10_url_rules": oracle.OP10,
                          "op11_conversations": oracle.OP11, "op12_lines": oracle.OP12,
                          "op13_filter_audit": oracle.OP13}
