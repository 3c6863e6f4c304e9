"""The suffix tree over light and heavy contexts, against dictionaries of counts."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagwright.llm import lm_scoring
from tests.llm.test_operators import plain_scores


def phrased(n, seed):
    """Texts in which some words follow each other, and words that are rare."""
    rng = np.random.default_rng(seed)
    phrases = ["the red fox runs", "a red hen sits", "the old red fox sleeps now", "every hen runs home"]
    return [" ".join(x for _ in range(int(rng.integers(1, 9))) for x in (phrases[int(rng.integers(4))], f"w{int(rng.integers(60))}")).split() for _ in range(n)]


def scores(spark, texts, **arguments):
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    return [r.score for r in lm_scoring.lm_scores(docs, F.col("doc_id") % 5 == 0, **arguments).orderBy("doc_id").collect()]


def test_states_and_continuations_need_no_share_of_a_large_corpus(spark):
    """Of 2.4 million training tokens, one that follows its context twice has less than a millionth, and its context may have less than 1e-5."""
    texts = [*phrased(150, 8), *([["padding"] * 100 if i % 5 else [] for i in range(30_000)])]
    got = scores(spark, texts)
    want, states = plain_scores(texts, [i % 5 != 0 for i in range(len(texts))], 3, 0.0, 0.0)
    assert states > 20 and got == pytest.approx(want, rel=1e-6)


@pytest.mark.parametrize(("heavy", "lookups"), [(10, 1 << 20), (10, 16), (60, 4), (1, 0), (1 << 17, 4)])
def test_heavy_and_light_contexts_score_alike(spark, monkeypatch, heavy, lookups):
    """Heavy from 10 tokens: contexts of every depth are; from 1: all are. Few lookups: the texts ask for most counts."""
    monkeypatch.setattr(lm_scoring, "HEAVY", heavy)
    monkeypatch.setattr(lm_scoring, "LOOKUPS", lookups)
    monkeypatch.setattr(lm_scoring, "GROUP", 8)
    texts = phrased(150, 9)
    want, states = plain_scores(texts, [i % 5 != 0 for i in range(150)], 3, 0.0, 0.0)
    assert states > 20 and scores(spark, texts) == pytest.approx(want, rel=1e-6)


def test_nothing_to_learn_from_scores_zero(spark):
    docs = spark.createDataFrame([(1, "a b a b"), (2, None)], "doc_id long, text string")
    assert [(r.n_tokens, r.n_known, r.score) for r in lm_scoring.lm_scores(docs, F.lit(True)).orderBy("doc_id").collect()] == [(5, 0, 0.0), (1, 0, 0.0)]


def test_texts_travel_in_packed_pieces(spark):
    """Words of many texts are one packed row a task and not a row a text, and are read back as they were, rare ones too."""
    texts = phrased(150, 10)
    docs = spark.createDataFrame([(i, " ".join(t), i % 5 == 0) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean").coalesce(1)
    want = lm_scoring.symbols(pa.array([" ".join(t) for t in texts]))
    alphabet, n = np.unique(want.symbols, return_counts=True)
    alphabet, n = alphabet[n > 9], n[n > 9]
    rank = np.argsort(np.argsort(-n, kind="stable")).astype(np.int32)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    known = lm_scoring.Shared(lm_scoring.Tree(alphabet, n, [], int(n.sum()), len(n), 0.5, 0.0), rank, [], *none, 2, 0.0)
    table = lm_scoring.encoded(docs, spark.sparkContext.broadcast(known))
    assert table.count() == 1
    (piece,) = lm_scoring.pieces(table.toArrow().to_batches(), known)
    assert (piece.text.symbols == want.symbols).all() and (piece.text.document == want.document).all() and (piece.text.place == want.place).all()
    assert (piece.held_out == (np.arange(150) % 5 == 0)).all() and 0 < (piece.ids < 0).sum() < len(piece.ids)
    size = len(table.select("text").first()[0])
    assert size < 4 * len(want.symbols), "packed words take fewer than the four bytes of a number"
