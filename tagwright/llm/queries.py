"""Queries of the operators over the whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm import conversations, decontaminate, exact_dedup, language_id, license_scan, line_dedup, lm_scoring, mixing, resampling, secret_scan, sharding, simhash, toxicity
from tagwright.llm.common import new_path, remainder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(documents(spark, sf_dir))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.sharded(documents(spark, sf_dir), new_path(spark, "shards"))
    return rows.select("doc_id", "shard_id", "shard_tier", F.md5("text").alias("text_md5"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(documents(spark, sf_dir))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without an id is not held out, and does not teach."""
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    docs = documents(spark, sf_dir)
    model = language_id.train(docs, ~held_out & F.col("doc_id").isNotNull())
    return language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model).drop("text")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.line_dedup(documents(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixed(documents(spark, sf_dir))
    return rows.select("doc_id", "source", "copy", F.round("rate", 6).alias("rate"), "shuffle_key", F.md5("text").alias("text_md5"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(documents(spark, sf_dir), remainder("doc_id", 5) == 1)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(documents(spark, sf_dir))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without an id is not held out, and has no label."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = toxicity.toxicity(documents(spark, sf_dir), labels, remainder("doc_id", 5) == 0)
    return rows.withColumns({"n_spans": F.size("spans"), "first_at": F.get("spans", F.lit(0))["at"], "first_size": F.get("spans", F.lit(0))["size"]}).drop("spans")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1,
    "op2_decontaminate": op2,
    "op3_exact_dedup": op3,
    "op4_sharding": op4,
    "op5_secret_scan": op5,
    "op6_language_id": op6,
    "op7_line_dedup": op7,
    "op8_mixing": op8,
    "op9_lm_scoring": op9,
    "op10_simhash": op10,
    "op11_toxicity": op11,
    "op12_conversation_repair": op12,
    "op13_importance_resampling": op13,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op7_line_dedup": line_dedup.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op12_conversation_repair": conversations.ORACLE,
    "op13_importance_resampling": resampling.ORACLE,
}
