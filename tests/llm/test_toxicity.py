"""The toxic-span field against sums over all taggings, and held-out accuracy."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.llm import toxicity
from tagwright.llm.arrays import words
from tagwright.llm.common import remainder
from tests.llm.test_operators import CLASHING, ODD, SCHEMA


def random_model(rng):
    return toxicity.Model(rng.normal(0, 1, (1 << toxicity.FEATURE_BITS) + 1), rng.normal(0, 1, 2), rng.normal(0, 1, (2, 2)))


@pytest.mark.parametrize("lengths", [[1], [5], [3, 1, 4], [2] * 20, [7, 6, 7]])
def test_marginals_are_sums_over_all_taggings(lengths):
    rng = np.random.default_rng(sum(lengths))
    model, scores = random_model(rng), rng.normal(0, 2, sum(lengths))
    first = np.zeros(len(scores), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    got, at = toxicity.passes(scores, first, model).marginal, 0
    for n in lengths:
        own, total, mass = scores[at : at + n], 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            w = np.exp(model.start[tags[0]] + sum(model.transition[a, b] for a, b in zip(tags, tags[1:])) + np.dot(tags, own))
            total, mass = total + w, mass + w * np.array(tags)
        assert np.allclose(got[at : at + n], mass / total)
        at += n


def test_a_long_text_is_scored_like_one_by_a_plain_loop():
    rng = np.random.default_rng(1)
    model, scores = random_model(rng), rng.normal(0, 3, 5003)
    first = np.zeros(5003, bool)
    first[[0, 17]] = True
    alpha, beta = np.zeros((5003, 2)), np.ones((5003, 2))
    emit = np.stack((np.ones(5003), np.exp(scores)), 1)
    for i in range(5003):
        alpha[i] = (np.exp(model.start) if first[i] else alpha[i - 1] @ np.exp(model.transition)) * emit[i]
        alpha[i] /= alpha[i].sum()
    for i in reversed(range(5002)):
        beta[i] = [1, 1] if first[i + 1] else np.exp(model.transition) @ (emit[i + 1] * beta[i + 1])
        beta[i] /= beta[i].sum()
    both = alpha * beta
    assert np.allclose(toxicity.passes(scores, first, model).marginal, both[:, 1] / both.sum(1))


def test_features_look_at_the_word_its_parts_and_its_neighbours():
    import pyarrow as pa

    at = toxicity.features(words(pa.array(["One twoer three", None, "", "twoer", "X twoer three"]), toxicity.NOT_ALNUM))
    assert (at[1, :7] == at[3, :7]).all() and (at[1, [0, 8]] == at[5, [0, 8]]).all() and at[1, 7] != at[5, 7]
    assert at[0, 7] == at[3, 7] == at[4, 7] and at[3, 8] == at[2, 8]  # the ends of a text


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts of made-up words; toxic ones hold words of a list, or words with a beginning that no other has."""
    rng, rows, labels = np.random.default_rng(4), [], []
    syllables = ["ka", "to", "mi", "ra", "lu", "po", "si", "né"]
    for i in range(1500):
        tokens = ["".join(rng.choice(syllables, int(rng.integers(1, 5)))) for _ in range(int(rng.integers(5, 90)))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(int(rng.integers(1, 5))):
                tokens[int(rng.integers(len(tokens)))] = str(rng.choice(["grubble", "snark"])) if i % 2 else "wex" + str(rng.choice(syllables)) + str(rng.choice(syllables))
        rows.append((i, " ".join(tokens).capitalize() + ".", "xx", "s", 0))
        if rng.random() < 0.8:
            labels.append((i, toxic if rng.random() < 0.98 else 1 - toxic, toxic))
    return spark.createDataFrame(rows, SCHEMA).repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int, truth int")


def test_held_out_documents_and_spans(spark, corpus):
    docs, labels = corpus
    out = toxicity.toxicity(docs, labels.select("doc_id", "toxic"), remainder("doc_id", 5) == 0).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("held_out").collect()
    right = [r.predicted == r.truth for r in out]
    assert len(out) > 200 and np.mean(right) > 0.97
    assert np.mean([r.predicted for r in out if r.truth]) > 0.93 and np.mean([r.predicted for r in out if not r.truth]) < 0.02
    found = [r.text.encode()[s.at : s.at + s["size"]].decode().lower() for r in out if r.truth for s in r.spans]
    assert len(found) > 80 and np.mean([all(w.startswith(("grubble", "snark", "wex")) for w in t.split(" ")) for t in found]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_labels_of_held_out_rows_do_not_teach(spark, corpus):
    docs, labels = corpus
    held = remainder("doc_id", 5) == 0
    turned = labels.select("doc_id", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")).alias("toxic"))
    both = [sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs, x, held).collect()) for x in (labels, turned)]
    assert both[0] == both[1]


def test_odd_rows_and_empty_tables(spark, corpus):
    docs, labels = corpus
    model = toxicity.train(toxicity.labelled(docs, labels, F.lit(True)), 200)
    odd = spark.createDataFrame([*ODD, (77, "the grubble " * 40_000, "en", "a", 1), (78, "x" * 500_000, None, None, None)], SCHEMA).withColumns({c: F.lit("x") for c in (*CLASHING, "spans", "predicted")})
    out = toxicity.predict(odd, model)
    assert sorted(out.columns) == sorted(odd.columns)
    rows = out.collect()
    assert len(rows) == len(ODD) + 2 and all(r.score == 0 and r.predicted == 0 and r.spans == [] for r in rows if not (r.text or "").strip())
    long = next(r for r in rows if r.doc_id == 77)
    assert long.predicted == 1 and long.spans[-1].at + long.spans[-1]["size"] > 450_000
    none, no_labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(none, labels, F.lit(False)).count() == 0
    silent = toxicity.toxicity(docs, no_labels, F.lit(False)).collect()
    assert len(silent) == 1500 and {(r.score, r.predicted) for r in silent} == {(0.0, 0)}
    several = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (2, None), (3, 0)], "doc_id long, toxic int")
    texts = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "d"), (3, None)], "doc_id long, text string")
    assert sorted((r.text or "", r.toxic) for r in toxicity.labelled(texts, several, F.lit(True)).collect()) == [("", 0), ("a", 1), ("b", 1)]
