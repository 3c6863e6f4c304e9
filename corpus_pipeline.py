"""The corpus pipeline: five stages over documents, each written before the next reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm import decontaminate, language_id, mixing, near_duplicates, sharding
from tagwright.llm.common import broadcast_up_to, keep, new_path, remainder

#: A text is rejected if no language reaches this score, so that mere mixtures of two languages stay.
LEAST_SCORE = 0.4
#: Hashes of contaminated texts that are broadcast, else joined by a shuffle.
BROADCAST_TEXTS = 1_000_000


def _aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, list[Column]]:
    """docs with columns of names that an operator adds put aside, and what gives all columns back."""
    own = {c: f"__own_{c}" for c in docs.columns if c in taken}
    return docs.withColumnsRenamed(own), [F.col(f"`{own.get(c, c)}`").alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are null or without a letter, or that are near no learned language, go. Rows without an id do not teach."""
    model = language_id.train(docs, remainder("doc_id", 5) != 0)
    rows, columns = _aside(docs, "lang_pred", "score", "ambiguous")
    rows = language_id.predict(rows, model)
    return rows.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts that share 0.8 of their five-word shingles the smallest id stays, once; null and empty texts are one group."""
    rows = keep(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    return near_duplicates.without_near_duplicates(rows).select(docs.columns)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold half of a benchmark item go. A clean row stays, also if it shares its id with one that goes or has none; null texts stay."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    text_hash = F.xxhash64(F.col("text").cast("string"))  # what decides is the text, so equal ones are looked at once
    texts = docs.select(text_hash.alias("doc_id"), "text").where("text is not null")
    gone = keep(decontaminate.contaminated(texts, benchmark).select(F.col("doc_id").alias("__text")).distinct(), "contaminated")
    rows = docs.withColumn("__text", F.when(F.col("text").isNotNull(), text_hash))
    return rows.join(broadcast_up_to(gone, BROADCAST_TEXTS), "__text", "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source (null is one) gets the same share of characters; documents repeat or drop out accordingly. Rows without an id are drawn by their text."""
    rows, columns = _aside(docs, "copy", "rate", "shuffle_key")
    return mixing.mixed(rows).select(columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as files of about the target size. Mixing has dealt them at random, so a file is a mixture of its own."""
    return sharding.sharded(docs, new_path(spark, "shards"))


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_documents),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: No SQL: language ID, SimHash and tiling are no relational operations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
