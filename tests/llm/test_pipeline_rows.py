"""The pipeline's stages on odd rows, empty tables, shared and missing ids."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import CLASHING, ODD, SCHEMA
from tests.oracle import SF_DIR

STAGES = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", list(STAGES))
def test_odd_rows_and_empty_tables(spark, name):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING if not c.startswith("shard_")}).repartition(3)
    out = STAGES[name](spark, odd, SF_DIR)
    given = {tuple(r) for r in odd.collect()}
    assert [c for c in out.columns if not c.startswith("shard_")] == odd.columns
    assert {tuple(r) for r in out.select(odd.columns).collect()} <= given
    empty = STAGES[name](spark, spark.createDataFrame([], SCHEMA), SF_DIR)
    assert empty.count() == 0 and set(SCHEMA.replace(",", "").split()[::2]) <= set(empty.columns)


def documents(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], SCHEMA)


def test_decontamination_drops_rows_and_not_ids(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").where("length(text) > 80").orderBy("item_id").first().text
    docs = documents(spark, (1, f"before {item} after"), (1, "a clean text of the same id"), (None, f"{item}"), (None, "a clean text without an id"), (2, None))
    kept = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.decontaminate_documents(spark, docs, SF_DIR).collect())
    assert kept == collections.Counter([(1, "a clean text of the same id"), (None, "a clean text without an id"), (2, None)])


def test_copies_under_one_id_or_none_leave_one(spark):
    text = " ".join(f"word{i}" for i in range(40))
    docs = documents(spark, (1, text), (1, text), (1, "another text that shares the id of the copies"), (None, text), (None, "only without an id here"), (None, "only without an id here"))
    kept = collections.Counter((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect())
    assert kept == collections.Counter([(1, text), (1, "another text that shares the id of the copies"), (None, "only without an id here")])
