"""The pipeline's near-duplicates against all pairs, on five-word shingles of similarity 0.8."""

import random
import re

import pytest

import corpus_pipeline
from tagwright.llm import near_duplicates
from tagwright.llm.common import keep
from tests.llm.test_operators import SCHEMA, lower
from tests.oracle import SF_DIR

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(lower(text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """Of each component of all pairs, the first row by id (null last)."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if group[i] != group[j] and 5 * len(a & b) >= 4 * len(a | b):
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    return [r for i, r in enumerate(rows) if group[i] == i]


def made():
    """Texts with changed words at similarities around 0.8, copies, rows without an id, repeated ids."""
    pick = random.Random(5)
    rows, n = [], 0
    for _ in range(40):
        words = [f"w{pick.randrange(5000)}" for _ in range(pick.choice((12, 60, 200)))]
        for changes in range(4):
            text = list(words)
            for at in pick.sample(range(len(words)), changes):
                text[at] = f"x{pick.randrange(5000)}"
            rows.append((n, " ".join(text)))
            n += 1
    rows += [rows[3], rows[3], (None, rows[7][1]), (None, "only here and without an id"), (None, "only here and without an id"), (3, "another text of the same id as before"), (n, None), (n + 1, "")]
    return rows


def key(row):
    return (str(row[0]), str(row[1]))


@pytest.mark.parametrize("cell", [near_duplicates.CELL, 3])
def test_against_all_pairs(spark, cell):
    from pyspark.sql import functions as F

    rows = made()
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    numbered = keep(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    got = near_duplicates.without_near_duplicates(numbered, cell).collect()
    assert sorted(key(r) for r in got if r[1]) == sorted(key(r) for r in plain(rows) if r[1])


def test_stage_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    assert sorted(key((r.doc_id, r.text)) for r in got.collect()) == sorted(key(r) for r in plain([(r.doc_id, r.text) for r in docs.collect()]))
