"""Scoring by a probabilistic suffix tree of words.

Symbols are words (and one end a text). The root holds the counts of all words
of the training texts. A deeper state is a context of one to max_depth words that
passes a divergence test against its longest retained suffix. Its next-symbol
distribution keeps the symbols that followed it at least LEAST_COUNT times,
discounted, and backs off to that suffix for the rest.

The tree grows with the corpus and is never in one place. Contexts are light or
heavy. A light one has fewer than HEAVY training tokens behind it (or than
HEAVY_SHARE of all, if that is more): the tokens behind it are dealt to one task by
its hash, which counts the subtree below it (longer contexts that end alike), tests
its states and scores those tokens at once. Texts travel in pieces, whose words are
packed; what a piece's texts gain comes back to it by document.
Heavy contexts, of which there are at most 1 / HEAVY_SHARE a depth, are counted by
aggregation. Their entries are a table, of which the LOOKUPS most frequent at most
are broadcast; texts ask for the rest, as for rare words, by a join.

Shares are arguments and zero by default: a state then needs no share of the corpus.
Words are identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.arrays import mixed, range_hashes, slices, words
from tagwright.llm.common import bit_words, discard, filter_bits, hub_join, keep, passing

#: Default of the argument of the same name, and learn's shares.
MAX_DEPTH = 3
CONTEXT_SHARE = 1e-5
JOINT_SHARE = 1e-6
#: Least count of a kept symbol in a state, where a share of a small corpus is less.
LEAST_COUNT = 2
DISCOUNT = 0.5
#: Nats that each kept symbol of a state must gain on average over its suffix.
GAIN = 2.0
END = np.uint64(0x5D1C0FFEE)
#: Partial counts that a task holds before it passes them on.
HELD = 1 << 20
#: Training tokens behind a heavy context, at least, and the share of all that is taken if it is more.
HEAVY, HEAVY_SHARE = 1 << 17, 1e-5
#: Words, and entries of heavy contexts, that are broadcast at most.
LOOKUPS = 1 << 20
#: Training tokens of a group of light contexts, on average, and tokens of a piece, which a task deals at a time (one text at least).
GROUP, PIECE = 1 << 19, 1 << 18


class Tree(NamedTuple):
    """Arrays sorted by key. alphabet: frequent symbols and their counts. levels[d]: states of d + 1 words and their entries."""

    alphabet: np.ndarray
    counts: np.ndarray
    levels: list[dict[str, np.ndarray]]
    total: int
    distinct: int
    discount: float
    joint_share: float

    def known(self, counts):
        return np.log10(np.maximum(counts - self.discount, 1e-9) / self.total)

    def unknown(self) -> float:
        return float(np.log10(self.discount * self.distinct / self.total)) if self.total else 0.0

    def base(self, counts):
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


def find(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
    return at, keys[at] == values


def joined(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """One key of a context and a next symbol."""
    return (context ^ np.uint64(0xA5A5A5A5A5A5A5A5)) * np.uint64(0x9E3779B97F4A7C15) + symbol


class Text(NamedTuple):
    symbols: np.ndarray  # with an end after each text
    document: np.ndarray
    place: np.ndarray  # in its text

    def context(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions with depth words before them in their text, and hashes of these words."""
        at = np.flatnonzero(self.place >= depth)
        return at, range_hashes(self.symbols, at - depth, at)


def symbols(column: pa.Array) -> Text:
    found = words(column)
    lengths = np.diff(found.bounds) + 1
    ends = np.cumsum(lengths)
    out = np.full(ends[-1] if len(ends) else 0, END, np.uint64)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = found.hashes()
    document = np.repeat(np.arange(len(lengths)), lengths)
    return Text(out, document, np.arange(len(out)) - (ends - lengths)[document])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, at = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(at, np.concatenate(counts)).astype(np.int64)


def symbol_counts(docs: DataFrame) -> DataFrame:
    """symbol, n over all rows of docs (text)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def out(keys, counts):
            unique, n = _summed(keys, counts)
            for at in range(0, len(unique), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(unique[at : at + (1 << 17)].view(np.int64)), pa.array(n[at : at + (1 << 17)])], ["symbol", "n"])

        for batch in slices(batches, "text"):
            unique, n = np.unique(symbols(batch.column("text")).symbols, return_counts=True)
            keys.append(unique)
            counts.append(n)
            held += len(unique)
            if held > 2 * HELD:
                unique, n = _summed(keys, counts)
                keys, counts, held = [unique], [n], len(unique)
                if held > HELD:
                    yield from out(keys, counts)
                    keys, counts, held = [], [], 0
        if keys:
            yield from out(keys, counts)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))


def level_counts(docs: DataFrame, alphabet, contexts, depth: int) -> DataFrame:
    """path (hashes of the context and its suffixes, longest first), symbol, whole (hash of context and symbol), n.

    Only contexts given and symbols of the alphabet are counted.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text = symbols(batch.column("text"))
            at, context = text.context(depth)
            chosen = find(contexts.value, context)[1]
            at, context = at[chosen], context[chosen]
            chosen = find(alphabet.value, text.symbols[at])[1]
            at, context = at[chosen], context[chosen]
            _, first, n = np.unique(joined(context, text.symbols[at]), return_index=True, return_counts=True)
            at = at[first]
            path = [pa.array(range_hashes(text.symbols, at - d, at).view(np.int64)) for d in range(depth, 0, -1)]
            whole = range_hashes(text.symbols, at - depth, at + 1)
            yield pa.RecordBatch.from_arrays([*path, pa.array(text.symbols[at].view(np.int64)), pa.array(whole.view(np.int64)), pa.array(n.astype(np.int64))], names)

    names = [*(f"c{d}" for d in range(depth, 0, -1)), "symbol", "whole", "n"]
    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, ", ".join(f"{x} long" for x in names))
    return counted.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def log_probability(tree: Tree, text_symbols: np.ndarray, contexts: list[np.ndarray], has: list[np.ndarray], root: np.ndarray) -> np.ndarray:
    """log10 of each symbol's probability in its longest retained context. contexts[d]: hashes of d + 1 words before; has: where there are so many."""
    out = root.copy()
    for level, context, there in zip(tree.levels, contexts, has, strict=False):
        rows = np.flatnonzero(there)
        state, found = find(level["states"], context[rows])
        rows, state = rows[found], state[found]
        entry, kept = find(level["entries"], joined(context[rows], text_symbols[rows]))
        out[rows] = np.where(kept, level["log_p"][entry] if len(level["log_p"]) else 0.0, out[rows] + level["log_back"][state])
    return out


def _level(tree: Tree, table: pa.Table, depth: int, context_counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """States of this depth that pass the divergence test."""
    column = lambda name: table.column(name).to_numpy().view(np.uint64)
    context, symbol, n = column(f"c{depth}"), column("symbol"), table.column("n").to_numpy()
    at, _ = find(context_counts["key"], context)
    seen = context_counts["n"][at]
    p = np.maximum(n - DISCOUNT, 1e-9) / seen
    suffixes = [column(f"c{d}") for d in range(1, depth)]
    root = tree.known(tree.counts[find(tree.alphabet, symbol)[0]])
    parent = 10 ** log_probability(tree, symbol, suffixes, [np.ones(len(n), bool)] * len(suffixes), root)
    states, of = np.unique(context, return_inverse=True)
    kept_mass, parent_mass, kept = np.bincount(of, p, len(states)), np.bincount(of, parent, len(states)), np.bincount(of, minlength=len(states))
    left = np.maximum(1 - kept_mass, 1e-9)
    back = left / np.maximum(1 - parent_mass, 1e-9)
    state_n = np.zeros(len(states))
    state_n[of] = seen
    gain = np.bincount(of, n * np.log(p / parent), len(states)) + (state_n - np.bincount(of, n, len(states))) * np.log(back)
    retained = gain >= GAIN * kept
    rows = np.flatnonzero(retained[of])
    keys = joined(context[rows], symbol[rows])
    order = np.argsort(keys)
    return {"states": states[retained], "log_back": np.log10(back[retained]), "entries": keys[order], "log_p": np.log10(p[rows][order])}


def root_counts(docs: DataFrame) -> tuple[DataFrame, int, int, float]:
    """symbol, n of all texts, written; their sum and number, and the root's discount."""
    counts = keep(symbol_counts(docs), "symbol-counts")
    stats = counts.agg(F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)).first()
    total, distinct, once, twice = (int(x or 0) for x in stats)
    return counts, total, distinct, once / (once + 2 * twice) if once else 0.5


def learn(docs: DataFrame, max_depth: int = MAX_DEPTH, context_share: float = CONTEXT_SHARE, joint_share: float = JOINT_SHARE) -> tuple[Tree, DataFrame]:
    """The part of the tree above the shares as arrays, and the root's counts as a table (symbol, n).

    It is for looking at the frequent states; lm_scores does not use it and has no such bound.
    """
    context = docs.sparkSession.sparkContext
    counts, total, distinct, discount = root_counts(docs)
    frequent = counts.where(F.col("n") >= joint_share * total).toArrow()  # at most 1 / joint_share rows
    order = np.argsort(frequent.column("symbol").to_numpy().view(np.uint64))
    alphabet = frequent.column("symbol").to_numpy().view(np.uint64)[order]
    tree = Tree(alphabet, frequent.column("n").to_numpy()[order], [], total, distinct, discount, joint_share)
    found = {"key": range_hashes(alphabet, np.arange(len(alphabet)), np.arange(len(alphabet)) + 1), "n": tree.counts}
    end = alphabet == END
    found = {k: v[~end] for k, v in found.items()}
    symbols_sent = context.broadcast(alphabet)
    for depth in range(1, max_depth + 1):
        often = found["n"] >= context_share * total
        order = np.argsort(found["key"][often])
        found = {k: v[often][order] for k, v in found.items()}
        if not len(found["key"]):
            break
        level = level_counts(docs, symbols_sent, context.broadcast(found["key"]), depth)
        table = level.where(F.col("n") >= max(joint_share * total, LEAST_COUNT)).toArrow()  # at most 1 / joint_share rows
        tree.levels.append(_level(tree, table, depth, found))
        inner = table.column("symbol").to_numpy().view(np.uint64) != END
        found = {"key": table.column("whole").to_numpy().view(np.uint64)[inner], "n": table.column("n").to_numpy()[inner]}
    return tree, counts


class Heavy(NamedTuple):
    """Sorted contexts of one depth with many training tokens behind them (seen), and their states."""

    contexts: np.ndarray
    seen: np.ndarray
    retained: np.ndarray
    log_back: np.ndarray


class Shared(NamedTuple):
    """What every task holds. root: the frequent words; rank: their numbers by frequency; keys, n: the most frequent entries of heavy states."""

    root: Tree
    rank: np.ndarray
    heavy: list[Heavy]
    keys: np.ndarray
    n: np.ndarray
    least: float
    often: float


def _at_least(counts: DataFrame, most: int) -> int:
    """A power of two that at most so many n of counts reach."""
    classes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()
    taken, least = 0, 1 << (max((r.k for r in classes), default=0) + 1)
    for k, found in sorted(((r.k, r["count"]) for r in classes), reverse=True):
        taken += found
        if taken > most:
            break
        least = 1 << k
    return least


def _sorted(table: pa.Table, key: str, n: str = "n") -> tuple[np.ndarray, np.ndarray]:
    keys = table.column(key).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], table.column(n).to_numpy()[order]


def _packed(*columns: np.ndarray) -> tuple[int, bytes]:
    """Columns one after the other, each byte by byte, so that like bytes lie together, compressed; their size before that comes first."""
    data = b"".join(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() for x in columns)
    return len(data), pa.compress(data, "zstd", asbytes=True)


class Unpacked:
    """Columns of what _packed made, taken in their order."""

    def __init__(self, raw: int, block: bytes) -> None:
        self.data, self.at = np.frombuffer(pa.decompress(block, raw, "zstd", asbytes=True), np.uint8), 0

    def take(self, kind: type, n: int) -> np.ndarray:
        size = np.dtype(kind).itemsize
        planes = self.data[self.at : self.at + n * size].reshape(size, n)
        self.at += n * size
        return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def encoded(docs: DataFrame, shared) -> DataFrame:
    """Documents in pieces of about PIECE words, a row each, written: piece, doc_id and held_out of each, and their words packed.

    A frequent word is its number, others (-1) are hashes. n_words and n_rare number them.
    """
    names = ["doc_id", "held_out", "n_words", "n_rare", "raw", "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root, rank = shared.value.root, shared.value.rank

        def out(held):
            doc_ids, held_out, lengths, ids, rare = (list(x) for x in zip(*held, strict=True))
            ids, rare = np.concatenate(ids), np.concatenate(rare)
            raw, block = _packed(np.concatenate(lengths), ids, rare)
            columns = [_one(x) for x in (doc_ids, held_out)]
            return pa.RecordBatch.from_arrays([*columns, *(pa.array([x]) for x in (len(ids), len(rare), raw)), pa.array([block], pa.binary())], names)

        held, n_held = [], 0
        for batch in slices(batches, "text"):
            text = symbols(batch.column("text"))
            at, frequent = find(root.alphabet, text.symbols)
            ids = np.where(frequent, rank[at] if len(rank) else 0, -1).astype(np.int32)
            if held and n_held + len(ids) > PIECE:
                yield out(held)
                held, n_held = [], 0
            lengths = np.bincount(text.document, minlength=batch.num_rows).astype(np.int32)
            held.append((batch.column("doc_id"), batch.column("held_out"), lengths, ids, text.symbols[~frequent]))
            n_held += len(ids)
        if held:
            yield out(held)

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col("text").cast("string").alias("text"))
    out = docs.mapInArrow(rows, "doc_id array<long>, held_out array<boolean>, n_words long, n_rare long, raw long, text binary")
    return keep(out.withColumn("piece", F.monotonically_increasing_id()), "encoded")


def _one(arrays: list[pa.Array]) -> pa.Array:
    """A list column of one row."""
    values = pa.concat_arrays(arrays)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Piece(NamedTuple):
    row: dict[str, pa.Scalar]
    text: Text
    ids: np.ndarray  # number of each word, -1: rare
    held_out: np.ndarray  # by document


def pieces(batches: Iterator[pa.RecordBatch], shared: Shared) -> Iterator[Piece]:
    by_rank = np.empty(len(shared.rank), np.uint64)
    by_rank[shared.rank] = shared.root.alphabet
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            held_out = row["held_out"].values.to_numpy(zero_copy_only=False).astype(bool)
            packed = Unpacked(row["raw"].as_py(), row["text"].as_buffer())
            lengths = packed.take(np.int32, len(held_out)).astype(np.int64)
            ids = packed.take(np.int32, row["n_words"].as_py())
            rare = packed.take(np.uint64, row["n_rare"].as_py())
            words = by_rank[ids] if len(by_rank) else np.zeros(len(ids), np.uint64)
            words[ids < 0] = rare
            document = np.repeat(np.arange(len(lengths)), lengths)
            yield Piece(row, Text(words, document, np.arange(len(words)) - (np.cumsum(lengths) - lengths)[document]), ids, held_out)


def heavy_entries(docs: DataFrame, shared, contexts) -> DataFrame:
    """context, symbol, n of the longest of the heavy contexts given, which come by depth."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, shared.value):
            text = piece.text
            at = np.flatnonzero(~piece.held_out[text.document])
            for depth, chosen in enumerate(contexts.value, 1):  # what a heavy context ends in is heavy
                at = at[text.place[at] >= depth]
                context = range_hashes(text.symbols, at - depth, at)
                found = find(chosen, context)[1]
                at, context = at[found], context[found]
            symbol = text.symbols[at]
            _, first, n = np.unique(joined(context, symbol), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(context[first].view(np.int64)), pa.array(symbol[first].view(np.int64)), pa.array(n.astype(np.int64))], ["context", "symbol", "n"])

    counted = docs.mapInArrow(rows, "context long, symbol long, n long")
    return counted.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def with_keys(entries: DataFrame, contexts) -> DataFrame:
    """entries with key, before (key of the entry one word shorter) and whole (hash of context and symbol). contexts: their hashes, sorted, and their words."""
    names = ["context", "symbol", "n", "key", "before", "whole"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, words = contexts.value
            depth = words.shape[1]
            context, symbol = (batch.column(x).to_numpy().view(np.uint64) for x in ("context", "symbol"))
            runs = np.column_stack([words[find(hashes, context)[0]], symbol]).reshape(-1)
            at = np.arange(len(symbol)) * (depth + 1)
            before = joined(range_hashes(runs, at + 1, at + depth), symbol) if depth > 1 else symbol
            new = [joined(context, symbol), before, range_hashes(runs, at, at + depth + 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names[:3]), *(pa.array(x.view(np.int64)) for x in new)], names)

    return entries.select(*names[:3]).mapInArrow(rows, ", ".join(f"{x} long" for x in names))


def heavy_states(docs: DataFrame, counts: DataFrame, shared, max_depth: int) -> tuple[list[Heavy], DataFrame | None]:
    """States of heavy contexts by depth, and the entries (key, n) of those that are retained."""
    spark, root, least, often = docs.sparkSession, shared.value.root, shared.value.least, shared.value.often
    most = max(HEAVY, int(HEAVY_SHARE * root.total))
    end = int(np.array([END]).view(np.int64)[0])
    contexts = counts.where((F.col("n") >= most) & (F.col("symbol") != end)).toArrow()  # at most 1 / HEAVY_SHARE rows, here and below
    words, seen = _sorted(contexts, "symbol")
    hashes = range_hashes(words, np.arange(len(words)), np.arange(len(words)) + 1)
    order = np.argsort(hashes)
    hashes, seen, words = hashes[order], seen[order], words[order, None]
    chains = counts.select(F.col("symbol").alias("before"), F.log10(F.greatest(F.col("n") - root.discount, F.lit(1e-9)) / max(root.total, 1)).alias("chain"))
    levels, entries, tables, contexts = [], None, [], []
    for depth in range(1, max_depth + 1):
        if not len(hashes):
            break
        contexts = [*contexts, hashes]
        level = heavy_entries(docs, shared, spark.sparkContext.broadcast(contexts)).where(F.col("n") >= least)
        level = with_keys(level, spark.sparkContext.broadcast((hashes, words)))
        level = keep(level.join(chains, "before").drop("before"), "heavy-entries")
        tables.append(level)
        sizes = F.broadcast(spark.createDataFrame(pa.table({"context": hashes.view(np.int64), "seen": seen})))
        p = F.greatest(F.col("n") - DISCOUNT, F.lit(1e-9)) / F.col("seen")
        parent = F.pow(F.lit(10.0), F.col("chain"))
        sums = [F.first("seen").alias("seen"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kept"), F.sum(p).alias("mass"), F.sum(parent).alias("parent"), F.sum(F.col("n") * F.log(p / parent)).alias("gain")]
        table = level.join(sizes, "context").groupBy("context").agg(*sums).toArrow()
        column = lambda name: table.column(name).to_numpy()
        back = np.maximum(1 - column("mass"), 1e-9) / np.maximum(1 - column("parent"), 1e-9)
        gain = column("gain") + (column("seen") - column("n")) * np.log(back)
        at, _ = find(hashes, column("context").view(np.uint64))
        retained, log_back = np.zeros(len(hashes), bool), np.zeros(len(hashes))
        retained[at], log_back[at] = (gain >= GAIN * column("kept")) & (column("seen") >= often), np.log10(back)
        levels.append(Heavy(hashes, seen, retained, log_back))
        states = F.broadcast(spark.createDataFrame(pa.table({"context": hashes.view(np.int64), "seen": seen, "retained": retained})))
        level = level.join(states, "context")
        chains = level.select(F.col("key").alias("before"), F.when(F.col("retained"), F.log10(p)).otherwise(F.col("chain")).alias("chain"))
        found = level.where("retained").select("key", "n")
        entries = found if entries is None else entries.unionByName(found)
        longer = level.where((F.col("n") >= most) & (F.col("symbol") != end)).select("context", "symbol", "whole", "n").toArrow()
        column = lambda name: longer.column(name).to_numpy().view(np.uint64)
        order = np.argsort(column("whole"))
        words = np.column_stack([words[find(hashes, column("context"))[0]], column("symbol")])[order]
        hashes, seen = column("whole")[order], longer.column("n").to_numpy()[order]
    if entries is not None:
        entries = keep(entries, "heavy-lookups")
        discard(*tables)
    return levels, entries


def heavy_walk(text: Text, shared: Shared) -> Iterator[tuple[Heavy, np.ndarray, np.ndarray, np.ndarray]]:
    """By depth: the heavy contexts, tokens behind one of them, its place, and the key of the entry. Last of all comes what heavy contexts are left of."""
    at = np.arange(len(text.symbols))
    for depth, heavy in enumerate(shared.heavy, 1):
        at = at[text.place[at] >= depth]
        context = range_hashes(text.symbols, at - depth, at)
        state, found = find(heavy.contexts, context)
        at, state, context = at[found], state[found], context[found]
        yield heavy, at, state, joined(context, text.symbols[at])


def heavy_chain(text: Text, shared: Shared, chain: np.ndarray, told_of=None) -> tuple[np.ndarray, np.ndarray]:
    """Takes chain, log10 of each token's probability by the root, on through heavy states. The depth that follows these, and tokens with an entry that was told."""
    depth, told = np.ones(len(chain), np.uint8), np.zeros(len(chain), bool)
    for level, (heavy, at, state, key) in enumerate(heavy_walk(text, shared), 1):
        where, there = find(shared.keys, key)
        n_entry = np.where(there, shared.n[where] if len(shared.n) else 0, 0)
        if told_of:
            n_entry[~there] = told_of(key[~there])
            told[at] |= ~there & (n_entry > 0)
        log_p = np.log10(np.maximum(n_entry - DISCOUNT, 1e-9) / heavy.seen[state])
        chain[at] = np.where(heavy.retained[state], np.where(n_entry >= shared.least, log_p, chain[at] + heavy.log_back[state]), chain[at])
        depth[at] = level + 1
    return depth, told


def asked(docs: DataFrame, shared) -> DataFrame:
    """piece, key: the rare words of each piece, and its entries of retained heavy states that are not broadcast."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, shared.value):
            keys = [piece.text.symbols[piece.ids < 0]]
            for heavy, _, state, key in heavy_walk(piece.text, shared.value):
                keys.append(key[heavy.retained[state] & ~find(shared.value.keys, key)[1]])
            keys = np.unique(np.concatenate(keys)).view(np.int64)
            for i in range(0, len(keys), 1 << 17):
                some = pa.array(keys[i : i + (1 << 17)])
                yield pa.RecordBatch.from_arrays([pa.repeat(piece.row["piece"], len(some)), some], ["piece", "key"])

    return docs.select(*PACKED).mapInArrow(rows, "piece long, key long")


def answered(docs: DataFrame, facts: DataFrame, shared) -> DataFrame:
    """docs with answers (key, n of facts) to what their texts ask for, written. docs and facts are deleted, and Spark's shuffles of what has been written."""
    bits = filter_bits(facts.count())
    near = passing(asked(docs, shared), keep(bit_words(facts, "key", bits), "asked-filter"), "key", bits)
    near = keep(near, "asked")
    met = keep(near.groupBy("key").agg(F.count(F.lit(1)).alias("n_rows")).join(facts, "key"), "asked-met")
    answers = hub_join(near, met, "key").groupBy("piece").agg(F.collect_list(F.struct("key", "n")).alias("answers"))
    out = keep(docs.join(answers, "piece", "left"), "answered")
    discard(docs, facts, near, met)
    docs.sparkSession.sparkContext._jvm.System.gc()
    return out


#: Columns that pieces reads.
PACKED = ["piece", "held_out", "n_words", "n_rare", "raw", "text"]
#: Stands in a block for a next symbol that is NONE.
_NONE = -2
#: Stands for next symbols that are too rare to be kept in any state.
NONE = np.uint64(1 << 63)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of one of each different key, and the number of each key among these."""
    order = np.argsort(keys)
    new = np.ones(len(keys), bool)
    new[1:] = np.diff(keys[order]) != 0
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


#: What texts score by the root and heavy states, of each document of a piece.
TOTALS = {"doc_id": "long", "held_out": "boolean", "n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double"}
_ARROW = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
_SENT = {"piece": pa.int64(), "size": pa.int64(), "raw": pa.int64(), "block": pa.binary()} | {k: pa.list_(_ARROW[v]) for k, v in TOTALS.items()}
_SENT_SCHEMA = "piece long, size long, raw long, block binary, " + ", ".join(f"{k} array<{v}>" for k, v in TOTALS.items())


def _record(columns: dict[str, pa.Array], n: int, kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns[x].cast(t) if x in columns else pa.nulls(n, t) for x, t in kinds.items()], list(kinds))


def dealt(docs: DataFrame, shared, max_depth: int, groups: int) -> DataFrame:
    """A row a piece of what its texts score by the root and heavy states, and the piece's tokens behind light contexts as blocks by group.

    A block has of each of its tokens (size) the next symbol and the words before it from the last,
    its document in the piece, marks, and what it scores so far where that rests on rare words or on entries that were told.
    """
    kinds = {"group": pa.int64()} | _SENT

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        root, ranked = known.root, np.empty(len(known.rank), np.int64)
        ranked[known.rank] = root.counts
        for piece in pieces(batches, known):
            text, ids, n = piece.text, piece.ids, len(piece.held_out)
            frequent = ids >= 0
            told = piece.row["answers"].values
            told_keys, told_n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            if told is not None:
                told_keys, first = np.unique(told.field("key").to_numpy().view(np.uint64), return_index=True)
                told_n = told.field("n").to_numpy()[first]

            def told_of(keys, told_keys=told_keys, told_n=told_n):
                at, found = find(told_keys, keys)
                return np.where(found, told_n[at] if len(told_n) else 0, 0)

            count = np.where(frequent, ranked[ids] if len(ranked) else 0, 0)
            count[~frequent] = told_of(text.symbols[~frequent])
            chain = np.where(count > 0, root.known(np.maximum(count, 1)), root.unknown()) if root.total else np.zeros(len(count))
            depth, told = heavy_chain(text, known, chain, told_of)
            number = piece.row["piece"].as_py()
            total = {
                "doc_id": piece.row["doc_id"].values,
                "held_out": pa.array(piece.held_out),
                "n_tokens": pa.array(np.bincount(text.document, minlength=n)),
                "n_known": pa.array(np.bincount(text.document, count > 0, n).astype(np.int64)),
                "base_score": pa.array(np.bincount(text.document, root.base(count), n)),
                "score": pa.array(np.bincount(text.document, chain, n)),
            }
            yield _record({"group": pa.array([number % groups]), "piece": pa.array([number])} | {k: _one([v]) for k, v in total.items()}, 1, kinds)
            # a word that is rarer than any entry ends what a light context can reach back to
            rare = count < known.least
            barrier = np.maximum.accumulate(np.where(rare, np.arange(len(rare)), -1))
            reach = np.minimum(text.place, max_depth)
            reach[1:] = np.minimum(reach[1:], np.arange(len(rare) - 1) - barrier[:-1])
            at = np.flatnonzero(reach >= depth)
            group = (range_hashes(text.symbols, at - depth[at], at) % np.uint64(groups)).astype(np.int64)
            code = np.where(rare, _NONE, ids).astype(np.int32)
            low = np.uint64((1 << 20) - 1)
            order = np.argsort((group.astype(np.uint64) << np.uint64(40)) | ((code[at - 1].astype(np.uint64) & low) << np.uint64(20)) | (code[at].astype(np.uint64) & low))
            at, group = at[order], group[order]
            reach, depth = reach[at].astype(np.uint8), depth[at]
            document = text.document[at].astype(np.int32)
            codes = np.stack([code[at], *(np.where(reach >= d, code[np.maximum(at - d, 0)], np.int32(0)) for d in range(1, max_depth + 1))])
            again = ~told[at] & (codes[0] >= 0)  # tasks of groups know what these score so far
            for d in range(1, max_depth):
                again &= (depth <= d) | (codes[d] >= 0)
            marks = (piece.held_out[document].astype(np.uint8) << np.uint8(7)) | (again.astype(np.uint8) << np.uint8(6)) | (reach << np.uint8(3)) | depth
            so_far = chain[at]
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            ends = np.append(starts[1:], len(at))

            def packed(a, b, text=text, at=at, codes=codes, document=document, marks=marks, so_far=so_far, again=again):
                some = np.ascontiguousarray(codes[:, a:b])
                back, where = np.nonzero(some == -1)
                return _packed(marks[a:b], document[a:b], *some, so_far[a:b][~again[a:b]], text.symbols[at[a:b][where] - back])

            for i in range(0, len(starts), 512):
                spans = list(zip(starts[i : i + 512].tolist(), ends[i : i + 512].tolist(), strict=True))
                raw, blocks = zip(*(packed(a, b) for a, b in spans), strict=True)
                sent = {"group": pa.array(group[starts[i : i + 512]]), "piece": pa.array([number] * len(spans)), "size": pa.array([b - a for a, b in spans]), "raw": pa.array(raw), "block": pa.array(blocks, pa.binary())}
                yield _record(sent, len(spans), kinds)

    return docs.select(*PACKED, "doc_id", "answers").mapInArrow(rows, f"group long, {_SENT_SCHEMA}")


class Tokens(NamedTuple):
    """Tokens of a block. columns: the next symbol and the words before it from the last; start: what they score so far; document: in the piece."""

    columns: list[np.ndarray]
    start: np.ndarray
    marks: np.ndarray
    document: np.ndarray


def tokens(size: int, raw: int, block: bytes, max_depth: int) -> Tokens:
    packed = Unpacked(raw, block)
    marks, document = packed.take(np.uint8, size), packed.take(np.int32, size)
    codes = np.stack([packed.take(np.int32, size) for _ in range(max_depth + 1)])
    start, sent = np.zeros(size), (marks >> 6 & 1) == 0
    start[sent] = packed.take(np.float64, int(sent.sum()))
    columns = codes.astype(np.uint64)
    columns[codes == _NONE] = NONE
    rare = codes == -1
    columns[rare] = packed.take(np.uint64, int(rare.sum())) | NONE
    return Tokens(list(columns), start, marks, document)


def start_again(columns: list[np.ndarray], start: np.ndarray, marks: np.ndarray, shared: Shared, by_rank: np.ndarray, by_root: np.ndarray) -> None:
    """Fills in start where blocks leave it out. by_rank, by_root: hashes of frequent words, and log10 of their probability."""
    again = np.flatnonzero(marks >> 6 & 1)
    start[again] = by_root[columns[0][again].astype(np.int64)]
    again = again[(marks[again] & 7) > 1]
    for i in range(0, len(again), 1 << 16):
        some = again[i : i + (1 << 16)]
        depth = (marks[some] & 7).astype(np.int64) - 1
        most = int(depth.max())
        runs = np.stack([by_rank[np.where(depth >= d, columns[d][some], 0).astype(np.int64)] for d in range(most, -1, -1)], axis=1)
        last = np.arange(len(some)) * (most + 1) + most
        place, chain = np.zeros(runs.size, np.int64), np.zeros(runs.size)
        place[last], chain[last] = depth, start[some]
        heavy_chain(Text(runs.reshape(-1), place, place), shared, chain)
        start[some] = chain[last]


def light_gains(columns: list[np.ndarray], start: np.ndarray, marks: np.ndarray, shared: Shared) -> np.ndarray:
    """What each token of a group gains over its heavy states by the states of light contexts, which are all here."""
    symbol, words = columns[0], columns[1:]
    least, often = shared.least, shared.often
    taught, reach, first = (marks >> 7) == 0, (marks >> 3) & 7, marks & 7
    chain, key = start.copy(), np.zeros(len(symbol), np.uint64)
    grown = np.ones(len(symbol), bool)  # tokens whose shorter context has entries
    for depth, word in enumerate(words, 1):
        key = mixed(joined(key, mixed(word + np.uint64(depth))))
        at = np.flatnonzero(grown & (reach >= depth) & (first <= depth))
        context, of = grouped(key[at])
        size = len(context)
        seen = np.bincount(of, taught[at], size)
        counted = (seen[of] >= least) & (symbol[at] != NONE)
        some, of_some = at[counted], of[counted]
        place, entry = grouped(joined(key[some], mixed(symbol[some])))
        n = np.bincount(entry, taught[some], len(place))
        kept = np.flatnonzero(n >= least)
        mine, n_kept = of_some[place[kept]], n[kept]
        p = np.maximum(n_kept - DISCOUNT, 1e-9) / seen[mine]
        parent = 10 ** chain[some[place[kept]]]
        entries = np.bincount(mine, minlength=size)
        back = np.maximum(1 - np.bincount(mine, p, size), 1e-9) / np.maximum(1 - np.bincount(mine, parent, size), 1e-9)
        gain = np.bincount(mine, n_kept * np.log(p / parent), size) + (seen - np.bincount(mine, n_kept, size)) * np.log(back)
        retained = (gain >= GAIN * entries) & (entries > 0) & (seen >= often)
        log_p = np.full(len(n), np.nan)
        log_p[kept] = np.log10(p)
        chain[at] += np.where(retained, np.log10(back), 0.0)[of]
        held = retained[of_some] & ~np.isnan(log_p)[entry]
        chain[some[held]] = log_p[entry[held]]
        grown[:] = first > depth
        grown[at[(entries > 0)[of]]] = True
    return chain - start


def gathered(blocks: DataFrame, max_depth: int, shared) -> DataFrame:
    """Rows of dealt without its blocks, and blocks of what documents of a piece gain in the groups of a task (size of them)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        by_rank, by_root = np.empty(len(known.rank), np.uint64), np.zeros(len(known.rank))
        by_rank[known.rank], by_root[known.rank] = known.root.alphabet, known.root.known(known.root.counts)
        group, held, gained, n_gained = None, [], [], 0

        def scored_group():
            """piece, document, gain of each document that gains."""
            number = np.repeat([x for x, _ in held], [len(x.marks) for _, x in held])
            columns = [np.concatenate(x) for x in zip(*(x.columns for _, x in held), strict=True)]
            start, marks, document = (np.concatenate(x) for x in zip(*(x[1:] for _, x in held), strict=True))
            held.clear()
            start_again(columns, start, marks, known, by_rank, by_root)
            gains = light_gains(columns, start, marks, known)
            some = np.flatnonzero(gains)
            return number[some], document[some], gains[some]

        def together():
            number, document, gains = (np.concatenate(x) for x in zip(*gained, strict=True))
            order = np.lexsort((document, number))
            number, document = number[order], document[order]
            first = np.ones(len(order), bool)
            first[1:] = (number[1:] != number[:-1]) | (document[1:] != document[:-1])
            return number[first], document[first], np.bincount(np.cumsum(first) - 1, gains[order], int(first.sum()))

        def out():
            number, document, gains = together()
            first = np.ones(len(number), bool)
            first[1:] = number[1:] != number[:-1]
            starts = np.flatnonzero(first)
            ends = np.append(starts[1:], len(number))
            for i in range(0, len(starts), 512):
                spans = list(zip(starts[i : i + 512].tolist(), ends[i : i + 512].tolist(), strict=True))
                raw, packed = zip(*(_packed(document[a:b], gains[a:b]) for a, b in spans), strict=True)
                yield _record({"piece": pa.array(number[starts[i : i + 512]]), "size": pa.array([b - a for a, b in spans]), "raw": pa.array(raw), "block": pa.array(packed, pa.binary())}, len(spans), _SENT)

        for batch in batches:
            is_block = batch.column("block").is_valid().to_numpy(zero_copy_only=False)
            if not is_block.all():
                yield batch.select(list(_SENT)).filter(pa.array(~is_block))
            groups, numbers, sizes, raws = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("group", "piece", "size", "raw"))
            for i in np.flatnonzero(is_block).tolist():
                if groups[i] != group and held:
                    gained.append(scored_group())
                    n_gained += len(gained[-1][0])
                    if n_gained > 2 * HELD:
                        gained = [together()]
                        n_gained = len(gained[0][0])
                        if n_gained > HELD:
                            yield from out()
                            gained, n_gained = [], 0
                group = groups[i]
                held.append((numbers[i], tokens(int(sizes[i]), int(raws[i]), batch.column("block")[i].as_buffer(), max_depth)))
        if held:
            gained.append(scored_group())
        if gained:
            yield from out()

    return blocks.repartition("group").sortWithinPartitions("group").mapInArrow(rows, _SENT_SCHEMA)


def texts(sums: DataFrame) -> DataFrame:
    """A row a document, of the rows of gathered."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total, gained = None, None, []

        def out():
            columns = {x: total[x].values for x in TOTALS}
            if gained:
                document, gains = (np.concatenate(x) for x in zip(*gained, strict=True))
                columns["score"] = pa.array(columns["score"].to_numpy() + np.bincount(document, gains, len(columns["score"])))
            for i in range(0, len(columns["score"]), 1 << 16):
                yield pa.RecordBatch.from_arrays([x.slice(i, 1 << 16) for x in columns.values()], list(columns))

        for batch in batches:
            for i, here in enumerate(batch.column("piece").to_pylist()):
                if here != number and total is not None:
                    yield from out()
                    total, gained = None, []
                number = here
                if batch.column("block")[i].is_valid:
                    size = batch.column("size")[i].as_py()
                    packed = Unpacked(batch.column("raw")[i].as_py(), batch.column("block")[i].as_buffer())
                    gained.append((packed.take(np.int32, size), packed.take(np.float64, size)))
                else:
                    total = {x: batch.column(x)[i] for x in TOTALS}
        if total is not None:
            yield from out()

    return sums.repartition("piece").sortWithinPartitions("piece").mapInArrow(rows, ", ".join(f"{k} {v}" for k, v in TOTALS.items()))


def lm_scores(docs: DataFrame, held_out: Column, max_depth: int = MAX_DEPTH, context_share: float = 0.0, joint_share: float = 0.0) -> DataFrame:
    """Learn from the rows where held_out does not hold, score every row.

    Shares above zero leave out contexts, and next symbols of a context, below
    that share of the training tokens. Null is an empty text, which is one end.
    Rows that repeat an id teach and are scored each; a null id is a row like any
    other (held_out null counts as false). With nothing to learn from, scores are
    0. Other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts, total, distinct, discount = root_counts(docs.where(~F.col("held_out")))
    frequent = _at_least(counts, LOOKUPS)
    alphabet, n = _sorted(counts.where(F.col("n") >= frequent).toArrow(), "symbol")  # at most LOOKUPS rows, as of entries below
    rank = np.empty(len(n), np.int32)
    rank[np.argsort(-n, kind="stable")] = np.arange(len(n), dtype=np.int32)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    known = Shared(Tree(alphabet, n, [], total, distinct, discount, joint_share), rank, [], *none, max(joint_share * total, LEAST_COUNT), context_share * total)
    shared = context.broadcast(known)
    docs = encoded(docs, shared)
    levels, entries = heavy_states(docs.select(*PACKED), counts, shared, max_depth)
    facts = counts.where(F.col("n") < frequent).select(F.col("symbol").alias("key"), "n")
    if entries is not None:
        often = _at_least(entries, LOOKUPS)
        keys, n = _sorted(entries.where(F.col("n") >= often).toArrow(), "key")
        known = known._replace(heavy=levels, keys=keys, n=n)
        facts = facts.unionByName(entries.where(F.col("n") < often))
    shared = context.broadcast(known)
    facts = keep(facts, "facts")
    discard(*(x for x in (counts, entries) if x is not None))
    docs = answered(docs, facts, shared)
    blocks = dealt(docs, shared, max_depth, max(64, total // GROUP))
    out = texts(gathered(blocks, max_depth, shared))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
