"""Language identification by error-correcting output codes.

Each language has a codeword; a binary classifier over hashed letter n-grams
predicts each bit, as the mean log-odds of a text's n-grams between the languages
with the bit and those without. Decoding weighs each bit's loss by how well the
bit separates that language in training, and takes the codeword of least loss.
Training reads all labelled texts; what it keeps is a table of fixed size for
each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.arrays import NOT_LETTER, slices, spaced, windows, words

GRAMS = (2, 3, 4)
FEATURE_BITS = 15
#: More labels than this are refused: the model holds 2**FEATURE_BITS numbers for each, on the driver too.
MAX_LANGUAGES = 500
SHARPNESS = 6.0
#: A text is ambiguous if the second language is nearer than this to the first.
AMBIGUOUS = 0.2


class Model(NamedTuple):
    languages: list[str]
    code: np.ndarray  # languages x bits, -1 or 1
    weights: np.ndarray  # features x bits
    trust: np.ndarray  # languages x bits, rows sum to 1
    scale: np.ndarray  # bits


def codewords(n: int) -> np.ndarray:
    """Exhaustive codes up to 6 languages; beyond that random columns, all different from each other and their complements."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        columns = [[1] + [1 if c >> i & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, float).T
    rng, columns = np.random.default_rng(n), set()
    while len(columns) < 12 * int(np.ceil(np.log2(n))):
        column = np.where(rng.random(n) < 0.5, 1, -1)
        if abs(column.sum()) < n:
            columns.add(tuple((column * column[0]).tolist()))
    return np.array(sorted(columns), float).T


def grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and their documents, for each n-gram length."""
    found = words(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), NOT_LETTER)
    line, at = spaced(found)
    line = np.concatenate((line, np.zeros(8, np.uint8))).astype(np.uint32)
    packed = line[:-7] | line[1:-6] << np.uint32(8) | line[2:-5] << np.uint32(16) | line[3:-4] << np.uint32(24)
    for n in GRAMS:
        first, documents = windows(at[found.bounds], n)
        cut = packed[first] & np.uint32((1 << (8 * n)) - 1)
        yield ((cut + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS), documents


def train(docs: DataFrame, trained: Column) -> Model:
    """docs: text, lang. Rows where trained holds and lang is not null teach."""
    rows = docs.where(trained & F.col("lang").isNotNull()).select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    size = 1 << FEATURE_BITS

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            langs = batch.column("lang").dictionary_encode()
            names = langs.dictionary.to_pylist()
            label = langs.indices.to_numpy().astype(np.int64)
            for features, documents in grams(batch.column("text")):
                sums = np.bincount(label[documents] * size + features, minlength=len(names) * size).reshape(-1, size)
                for name, counts in zip(names, sums, strict=True):
                    totals[name] = totals.get(name, 0) + counts
        for name, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["lang", "feature", "n"])

    sums = rows.mapInArrow(counted, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = sums.toArrow()  # at most 2**FEATURE_BITS rows a language
    languages = sorted(pc.unique(table.column("lang")).to_pylist())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"{len(languages)} languages; at most {MAX_LANGUAGES} can be told apart")
    counts = np.zeros((len(languages), size))
    label = np.searchsorted(languages, table.column("lang").to_pylist()) if languages else []
    counts[label, table.column("feature").to_numpy()] = table.column("n").to_numpy()
    p = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * size)
    code = codewords(len(languages))
    if len(languages) < 2:
        return Model(languages, code, np.zeros((size, code.shape[1])), np.ones(code.shape), np.ones(code.shape[1]))
    with_bit, without = code > 0, code < 0
    weights = np.log(p.T @ (with_bit / with_bit.sum(0))) - np.log(p.T @ (without / without.sum(0)))
    expected = (p @ weights) * code
    trust = np.maximum(expected, 1e-9)
    return Model(languages, code, weights.astype(np.float32), trust / trust.sum(1, keepdims=True), np.maximum(expected.mean(0), 1e-9))


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its score, and the score of the second, for rows of bit margins."""
    agree = np.clip(model.code[None] * (margins / model.scale)[:, None, :], -4, 4)
    loss = (model.trust[None] * np.exp(-agree)).sum(2)
    score = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
    score /= score.sum(1, keepdims=True)
    order = np.argsort(-score, axis=1, kind="stable")
    rows = np.arange(len(score))
    second = score[rows, order[:, 1]] if score.shape[1] > 1 else np.zeros(len(score))
    return order[:, 0], score[rows, order[:, 0]], second


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and ambiguous (columns of these names are replaced).

    lang_pred is `und` with score 0 where a text is null, has no letter, or
    nothing was learned. Only the text is looked at.
    """
    docs = docs.drop("lang_pred", "score", "ambiguous").withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            n, column = batch.num_rows, batch.column("text")
            margins, total = np.zeros((n, model.code.shape[1])), np.zeros(n)
            for features, documents in grams(column):
                some, first = np.unique(documents, return_index=True)  # documents are in order
                if len(some):
                    margins[some] += np.add.reduceat(model.weights[features], first, axis=0, dtype=np.float64)
                total += np.bincount(documents, minlength=n)
            lettered = pc.fill_null(pc.match_substring_regex(column, "[A-Za-z]"), False).to_numpy(zero_copy_only=False).copy()
            for k in np.flatnonzero(~lettered & (total > 0)).tolist():  # letters beyond ASCII
                lettered[k] = any(map(str.isalpha, column[k].as_py()))
            if len(model.languages):
                best, score, second = decode(model, margins / np.maximum(total, 1)[:, None])
                names = np.array(model.languages, object)[best]
            else:
                lettered[:], names, score, second = False, np.full(n, "und", object), np.zeros(n), np.zeros(n)
            names[~lettered], score[~lettered] = "und", 0.0
            added = [pa.array(names.tolist(), pa.string()), pa.array(score), pa.array(~lettered | (score - second < AMBIGUOUS))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "lang_pred", "score", "ambiguous"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(rows, f"{fields}, lang_pred string, score double, ambiguous boolean")
