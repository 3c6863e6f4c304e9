"""Each stage of the pipeline against a plain version of it, on what its predecessor kept."""

import collections
import hashlib
import math
import re

import pytest

import corpus_pipeline
from tagwright.llm import decontaminate
from tagwright.llm.common import keep
from tests.llm.test_near_duplicates import plain
from tests.oracle import SF_DIR


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before the first stage and after each."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, SF_DIR), f"tested-{name.replace(' ', '-')}")
        out.append(docs.collect())
    return out


def test_language_id_rejects_what_has_no_letter_and_keeps_prose(stages):
    kept = {r.doc_id for r in stages[1]}
    assert all(any(c.isalpha() for c in r.text or "") for r in stages[1])
    prose = [r for r in stages[0] if len(re.findall(r"[a-z]{2,}", (r.text or "").lower())) >= 50]
    assert sum(r.doc_id in kept for r in prose) >= 0.98 * len(prose) > 0


def test_near_duplicates_by_all_pairs(stages):
    """The rule of the stage: five words, similarity 0.8, compared for all pairs."""
    want = plain([(r.doc_id, r.text) for r in stages[1]])
    assert sorted((r.doc_id, r.text) for r in stages[2]) == sorted((i, t) for i, t in want)


def test_decontamination_by_all_pairs(spark, stages):
    """Every pair of document and item is tiled, without seeds."""
    import pyarrow as pa

    tokens = lambda text: decontaminate._tokens(pa.array([text], pa.string())).hashes()
    items = [t for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() if len(t := tokens(r.text))]
    clean = []
    for r in stages[2]:
        text = tokens(r.text)
        if all(sum(n for _, _, n in decontaminate.tiles(item, text, decontaminate.MIN_MATCH)) < decontaminate.COVERAGE * len(item) for item in items):
            clean.append(r.doc_id)
    assert sorted(r.doc_id for r in stages[3]) == sorted(clean)


def test_mixing_by_plain_inversion(stages):
    mass = collections.Counter()
    for r in stages[3]:
        mass[r.source] += len(r.text or "")
    want = collections.Counter()
    for r in stages[3]:
        rate = sum(mass.values()) / len(mass) / mass[r.source]
        u = (int(hashlib.md5(f"0|1|{r.doc_id}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        n, p = 0, math.exp(-rate)
        below = p
        while below <= u:
            n += 1
            p *= rate / n
            below += p
        want[r.doc_id] += n
    assert collections.Counter(r.doc_id for r in stages[4]) == +want


def test_sharding_keeps_every_row(stages):
    before = collections.Counter(tuple(r) for r in stages[4])
    columns = list(stages[4][0].asDict())
    assert collections.Counter(tuple(r[c] for c in columns) for r in stages[5]) == before
    assert set(stages[5][0].asDict()) == {*columns, "shard_id", "shard_tier"}
