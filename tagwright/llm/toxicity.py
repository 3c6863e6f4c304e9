"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

1. Labelled tokens: labels are of documents, so the words of all labelled texts
   and beginnings of words are counted by label. One is marked if the share of
   its documents that are toxic is surely (Wilson bound) more than half the way
   from the base rate to one. Tokens with a mark in toxic documents are toxic, all
   tokens of clean documents are clean; toxic documents without one teach nothing.
2. Fit: the field has two tags and features of the word, its beginnings and end,
   and its neighbours. It is fitted to a sample of pieces of texts, PIECES of each
   kind, which one task can hold.
3. Scoring: forward and backward passes give each token's probability to be toxic,
   over whole texts of any length; neighbouring tokens over one half are a span.
   A document's score is a logistic function of its most toxic token, the
   expected number of toxic tokens and the number of tokens, fitted to a sample
   of the labelled documents.

A pass is exact and has no loop over the tokens of a text: tokens of a slice are one
chain that begins anew at each document, cut to blocks whose 2x2 products are
made side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.arrays import BYTE_CODES, NOT_ALNUM, Words, mixed, range_hashes, slices, text_bytes, words
from tagwright.llm.common import broadcast_up_to, keep

FEATURE_BITS = 17
#: Bounds of the fit, and of it alone: pieces of each kind, tokens a piece, marks that label them (those of most documents).
PIECES, PIECE, MARKED = 2_048, 64, 65_536
#: Standard deviations of the bound by which a word is marked.
SURE = 2.0
STEPS, RATE, DECAY = 80, 0.5, 0.1
#: Labelled documents, as expected, that the document scores are fitted to; Newton steps and prior of that fit.
DOCUMENTS, NEWTON, PRIOR = 20_000, 20, 0.1
BROADCAST_LABELS = 1_000_000
TOXIC = 0.5
#: Bytes of the beginnings and of the end of a word.
HEADS, TAIL = (3, 4, 5, 6, 8), 4


class Model(NamedTuple):
    """Log potentials of the toxic tag (the clean one has 0), the last one for every token; of a text's first tag; of tag after tag. document: weights of a text's evidence."""

    weights: np.ndarray
    start: np.ndarray
    transition: np.ndarray
    document: np.ndarray | None = None


class Passes(NamedTuple):
    """Of each token: the toxic tag's share given what comes before (with the token), given what comes after, and given all; potentials from tag to tag."""

    alpha: np.ndarray
    beta: np.ndarray
    marginal: np.ndarray
    step: np.ndarray


def passes(scores: np.ndarray, first: np.ndarray, model: Model) -> Passes:
    """Forward and backward over tokens with these scores of the toxic tag; first: where a text begins."""
    n = len(scores)
    side = max(1, int(np.ceil(np.sqrt(n))))
    blocks = -(-n // side) if n else 1
    start, transition = np.exp(model.start), np.exp(model.transition)
    step = np.empty((2, 2, side * blocks))
    new = np.ones(side * blocks, bool)
    new[:n] = first
    potential = np.ones(side * blocks)
    potential[:n] = np.exp(np.clip(scores, -30, 30))
    for a in range(2):
        for b in range(2):
            step[a, b] = np.where(new, start[b], transition[a, b]) * (potential if b else 1.0)
    m = np.ascontiguousarray(step.reshape(2, 2, blocks, side).transpose(3, 0, 1, 2))
    whole = np.zeros((2, 2, blocks))
    whole[0, 0] = whole[1, 1] = 1
    for k in range(side):
        whole = (whole[:, :, None] * m[k][None]).sum(1)
        whole /= whole.sum((0, 1))
    enter, leave = np.empty((2, blocks)), np.empty((2, blocks))
    now = np.array([0.5, 0.5])
    for b in range(blocks):
        enter[:, b] = now
        now = now @ whole[:, :, b]
        now = now / now.sum()
    now = np.array([0.5, 0.5])
    for b in reversed(range(blocks)):
        leave[:, b] = now
        now = whole[:, :, b] @ now
        now = now / now.sum()
    alpha, beta = np.empty((side, blocks)), np.empty((side, blocks))
    for k in range(side):
        enter = (enter[:, None] * m[k]).sum(0)
        enter /= enter.sum(0)
        alpha[k] = enter[1]
    for k in reversed(range(side)):
        beta[k] = leave[1]
        leave = (m[k] * leave[None]).sum(1)
        leave /= leave.sum(0)
    alpha, beta = alpha.T.ravel()[:n], beta.T.ravel()[:n]
    toxic = alpha * beta
    return Passes(alpha, beta, toxic / (toxic + (1 - alpha) * (1 - beta)), step[:, :, :n])


def first_tokens(bounds: np.ndarray, n: int) -> np.ndarray:
    first = np.zeros(n, bool)
    first[bounds[:-1][np.diff(bounds) > 0]] = True
    return first


def units(found: Words) -> np.ndarray:
    """Hashes of each word and of its beginnings, a column each; a word that is no longer than a beginning stands for it."""
    h, codes, lengths = found.hashes(), BYTE_CODES[found.data], found.ends - found.starts
    heads = [np.where(lengths > k, mixed(range_hashes(codes, found.starts, np.minimum(found.starts + k, found.ends)) + np.uint64(k)), h) for k in HEADS]
    return np.stack((h, *heads), 1)


def features(found: Words) -> np.ndarray:
    """Hashed features of each token, a column a kind."""
    own = units(found)
    h = own[:, 0]
    before, after = np.concatenate(([0], h[:-1])).astype(np.uint64)[: len(h)], np.concatenate((h[1:], [0])).astype(np.uint64)[: len(h)]
    some = np.diff(found.bounds) > 0
    before[found.bounds[:-1][some]] = 0
    after[found.bounds[1:][some] - 1] = 0
    tails = range_hashes(BYTE_CODES[found.data], np.maximum(found.ends - TAIL, found.starts), found.ends)
    kinds = [*own.T, tails, before, after]
    return np.stack([mixed(x + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - FEATURE_BITS) for k, x in enumerate(kinds)], 1).astype(np.int32)


def token_scores(model: Model, found: Words) -> np.ndarray:
    return model.weights[features(found)].sum(1, dtype=np.float64) + model.weights[-1]


def evidence(model: Model, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Each token's probability to be toxic; and of each text: 1, log of the expected number, logit of the largest, log of the number of tokens."""
    n = np.diff(found.bounds)
    p = passes(token_scores(model, found), first_tokens(found.bounds, len(found.starts)), model).marginal
    some, largest, total = np.flatnonzero(n), np.zeros(len(n)), np.zeros(len(n))
    if len(some):
        largest[some], total[some] = np.maximum.reduceat(p, found.bounds[some]), np.add.reduceat(p, found.bounds[some])
    largest = np.clip(largest, 1e-4, 1 - 1e-4)
    return p, np.stack((np.ones(len(n)), np.log1p(total), np.log(largest / (1 - largest)), np.log1p(n)), 1)


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a Gaussian prior, by Newton's steps."""
    w, prior = np.zeros(x.shape[1]), PRIOR * np.eye(x.shape[1])
    for _ in range(NEWTON):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + prior, x.T @ (p - y) + prior @ w)
    return w


def fitted(at: np.ndarray, first: np.ndarray, toxic: np.ndarray) -> Model:
    """The field of most likely tags (with a Gaussian prior) by AdaGrad; at: features of each token, toxic: its tag."""
    size = (1 << FEATURE_BITS) + 1
    weights, chain = np.zeros(size), np.zeros(6)  # chain: start, transition
    sums, chain_sums = np.full(size, 1e-8), np.full(6, 1e-8)
    inner = np.flatnonzero(~first)
    pairs = 2 * toxic[inner - 1] + toxic[inner]
    seen = np.concatenate((np.bincount(toxic[first], minlength=2), np.bincount(pairs, minlength=4)))
    flat = at.ravel()
    for _ in range(STEPS):
        model = Model(weights, chain[:2], chain[2:].reshape(2, 2))
        p = passes(weights[at].sum(1) + weights[-1], first, model)
        off = p.marginal - toxic
        gradient = np.bincount(flat, np.repeat(off, at.shape[1]), size)
        gradient[-1] = off.sum()
        alpha, beta = p.alpha[inner - 1], p.beta[inner]
        ways = np.stack((1 - alpha, alpha))[:, None] * p.step[:, :, inner] * np.stack((1 - beta, beta))[None]
        expected = np.concatenate(([(1 - p.marginal[first]).sum(), p.marginal[first].sum()], (ways / ways.sum((0, 1))).sum(2).ravel()))
        for w, g, s in ((weights, gradient + DECAY * weights, sums), (chain, expected - seen + DECAY * chain, chain_sums)):
            s += g * g
            w -= RATE * g / np.sqrt(s)
    return Model(weights.astype(np.float32), chain[:2], chain[2:].reshape(2, 2))


def unit_counts(texts: DataFrame) -> DataFrame:
    """unit (a word or beginning, as a hash), toxic, clean: numbers of texts (text, toxic) that hold it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), NOT_ALNUM)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(found.bounds))
            h, owner = units(found).ravel(), np.repeat(owner, 1 + len(HEADS))
            order = np.lexsort((owner, h))
            h, owner = h[order], owner[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
            h, label = h[new], batch.column("toxic").to_numpy()[owner[new]]
            unique, begins = np.unique(h, return_index=True)
            toxic = np.add.reduceat(label, begins) if len(begins) else label[:0]
            n = np.diff(np.append(begins, len(h)))
            yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(toxic.astype(np.int64)), pa.array((n - toxic).astype(np.int64))], ["unit", "toxic", "clean"])

    return texts.mapInArrow(rows, "unit long, toxic long, clean long").groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def marked(texts: DataFrame, sure: float = SURE) -> DataFrame:
    """unit, toxic: words and beginnings that mark a text as toxic, from texts (text, toxic 0 or 1)."""
    base = texts.agg(F.avg("toxic")).first()[0] or 0.0
    n, z2 = F.col("toxic") + F.col("clean"), sure * sure
    p = F.col("toxic") / n
    bound = (p + z2 / (2 * n) - sure * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return unit_counts(texts).where(F.col("toxic") > 0).where(bound > (1 + base) / 2).select("unit", "toxic")


def is_marked(lexicon: np.ndarray, found: Words) -> np.ndarray:
    """Tokens with a unit of the lexicon, which is sorted and not empty."""
    own = units(found)
    return (lexicon[np.minimum(np.searchsorted(lexicon, own), len(lexicon) - 1)] == own).any(1)


def pieces(texts: DataFrame, lexicon: np.ndarray, most: int = PIECES) -> DataFrame:
    """toxic, text: at most `most` pieces of clean texts, and of toxic ones that hold a mark, drawn by a hash of their words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[int, bytes]]] = [[], []]
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), NOT_ALNUM)
            h, n = found.hashes(), np.diff(found.bounds)
            per = -(-n // PIECE)
            owner = np.repeat(np.arange(len(n)), per)
            begins = found.bounds[:-1][owner] + PIECE * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
            ends = np.minimum(begins + PIECE, found.bounds[1:][owner])
            key, label = range_hashes(h, begins, ends), batch.column("toxic").to_numpy()[owner]
            hits = np.concatenate(([0], np.cumsum(is_marked(lexicon, found))))
            for kind, chosen in ((0, label == 0), (1, (label == 1) & (hits[ends] > hits[begins]))):
                at = np.flatnonzero(chosen)
                at = at[np.argsort(key[at], kind="stable")][:most]
                text = [(int(key[k]), found.data[found.starts[begins[k]] : found.ends[ends[k] - 1]].tobytes()) for k in at]
                held[kind] = sorted({*held[kind], *text})[:most]
        out = [(kind, k - (1 << 63), text.decode("utf-8", "replace")) for kind in (0, 1) for k, text in held[kind]]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["toxic", "key", "text"])

    table = keep(texts.mapInArrow(rows, "toxic long, key long, text string"), "pieces")
    both = [table.where(F.col("toxic") == kind).distinct().orderBy("key", "text").limit(most) for kind in (0, 1)]
    return both[0].unionByName(both[1]).select("toxic", "text")


def train(texts: DataFrame, most: int = PIECES) -> Model | None:
    """The model of texts (text, toxic 0 or 1), None if nothing tells toxic texts."""
    lexicon = marked(texts).orderBy(F.desc("toxic"), "unit").limit(MARKED).toArrow().column("unit").to_numpy()
    if not len(lexicon):
        return None
    lexicon = np.sort(lexicon.view(np.uint64))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).sort_by([("toxic", "ascending"), ("text", "ascending")])
        if len(table):
            found = words(table.column("text").combine_chunks(), NOT_ALNUM)
            label = np.repeat(table.column("toxic").to_numpy(), np.diff(found.bounds))
            tags = (label * is_marked(lexicon, found)).astype(np.int64)
            model = fitted(features(found), first_tokens(found.bounds, len(tags)), tags)
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in model[:3]], Model._fields[:3])

    row = pieces(texts, lexicon, most).coalesce(1).mapInArrow(fit, ", ".join(f"{x} binary" for x in Model._fields[:3])).first()
    model = Model(np.frombuffer(row.weights, np.float32), np.frombuffer(row.start), np.frombuffer(row.transition).reshape(2, 2))
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = evidence(shared.value, words(batch.column("text"), NOT_ALNUM))[1]
            yield pa.RecordBatch.from_arrays([pa.array(x[:, k]) for k in range(4)] + [batch.column("toxic")], ["one", "number", "largest", "tokens", "toxic"])

    share = DOCUMENTS / max(texts.count(), 1)
    sample = texts.where(F.abs(F.xxhash64("text") % 1_000_000) < int(1_000_000 * share)).mapInArrow(weigh, "one double, number double, largest double, tokens double, toxic long").toArrow()
    x = np.stack([c.to_numpy() for c in sample.columns[:4]], 1)
    return model._replace(document=logistic(x, sample.column("toxic").to_numpy()))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with score, predicted and spans (columns of these names are replaced): at, size (bytes of UTF-8 in the text), score of each toxic span. Only the text is looked at."""
    docs = docs.drop("score", "predicted", "spans").withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            found = words(batch.column("text"), NOT_ALNUM)
            n, first = batch.num_rows, first_tokens(found.bounds, len(found.starts))
            score, p = np.zeros(n), np.zeros(len(first))
            if model:
                p, x = evidence(model, found)
                score = np.where(np.diff(found.bounds) > 0, 1 / (1 + np.exp(-np.clip(x @ model.document, -30, 30))), 0.0)
            hit = p >= TOXIC
            begins = np.flatnonzero(hit & (first | ~np.concatenate(([False], hit[:-1]))[: len(hit)]))
            last = np.flatnonzero(hit & np.concatenate((first[1:] | ~hit[1:], [True]))[: len(hit)])
            owner = np.searchsorted(found.bounds, begins, side="right") - 1
            at = found.starts[begins]
            best = np.maximum.reduceat(np.where(hit, p, 0), begins) if len(begins) else np.zeros(0)
            spans = pa.StructArray.from_arrays([pa.array(at - text_bytes(batch.column("text"))[1][owner]), pa.array(found.ends[last] - at), pa.array(best)], ["at", "size", "score"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= TOXIC).astype(np.int32)), lists], [*batch.schema.names, "score", "predicted", "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(rows, f"{fields}, score double, predicted int, spans array<struct<at: bigint, size: bigint, score: double>>")


def labelled(docs: DataFrame, labels: DataFrame, trained: Column) -> DataFrame:
    """text, toxic of the rows of docs where trained holds and that have a label. An id of several labels is toxic if one is."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("toxic"))
    known = broadcast_up_to(keep(known, "labels"), BROADCAST_LABELS)
    return docs.where(trained).select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id").select("text", "toxic")


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """Learn from labelled rows where held_out does not hold, score every row: doc_id, held_out, score, predicted, spans.

    Null and empty texts score 0, as do all texts where nothing can be learned
    (no labels, or none that words tell). Rows that repeat an id teach and
    are scored each; rows without an id are held out of no learning, as they have
    no label. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = train(labelled(docs, labels, ~F.col("held_out")))
    return predict(docs, model).select("doc_id", "held_out", "score", "predicted", "spans")
