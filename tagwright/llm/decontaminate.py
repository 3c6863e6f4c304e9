"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits in lower case. Seeds are the hashes of
every min_match consecutive tokens (whole items where they are shorter). A first
pass over the documents keeps those with a seed of the benchmark: it looks each
seed up in a bit table of fixed size. Their seeds are joined with the
benchmark's, which gives pairs of document and item. The join leaves out the most
frequent seeds of an item, as many as cannot cover it by themselves, so passages
that very many documents share make no pairs. Each pair is tiled:
repeatedly mark the longest match of unmarked tokens, found by running Karp-Rabin
hashes, until none has min_match tokens. The share of the item's tokens under
tiles decides, so passages are caught in any order of their parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.arrays import NOT_ALNUM, range_hashes, slices, windows, words
from tagwright.llm.common import hub_join, keep

MIN_MATCH = 5
COVERAGE = 0.5
#: Bits of the table of benchmark seeds: 4 MB in the driver and in tasks, whatever the benchmark's size. A full table lets more documents through to the join and changes no result.
SEED_BITS = 1 << 25
#: Items that a document's tokens travel with at once.
BUNDLE = 32


def _tokens(column: pa.Array):
    return words(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")), NOT_ALNUM)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def seeds(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Seed of each run of size tokens, and its document."""
    first, documents = windows(bounds, size)
    return range_hashes(hashes, first, first + size), documents


def item_tokens(benchmark: DataFrame) -> DataFrame:
    """item_id, tokens (hashes) of the items that have any."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = _tokens(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), _lists(found.hashes(), found.bounds)], ["item_id", "tokens"])

    columns = F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    return benchmark.select(*columns).mapInArrow(rows, "item_id long, tokens array<long>").where("size(tokens) > 0")


def item_seeds(items: DataFrame, min_match: int, coverage: float) -> DataFrame:
    """seed, item_id, width, times (in the item), needed.

    A tile of n tokens begins n - width + 1 seeds, which is n / width or more. An
    item that is covered thus has at least `needed` seeds in the document.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, tokens in zip(batch.column("item_id"), batch.column("tokens"), strict=True):
                hashes = np.array(tokens.as_py(), np.int64).view(np.uint64)
                width = min(min_match, len(hashes))
                seed, times = np.unique(seeds(hashes, np.array([0, len(hashes)]), width)[0].view(np.int64), return_counts=True)
                needed = max(1, int(np.ceil(coverage * len(hashes) / width - 1e-9)))
                same = [np.full(len(seed), x, t) for x, t in ((item.as_py(), np.int64), (width, np.int32), (needed, np.int64))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (seed, *same, times)], ["seed", "item_id", "width", "needed", "times"])

    return items.mapInArrow(rows, "seed long, item_id long, width int, needed long, times long")


def telling_seeds(item_seed: DataFrame, hits: DataFrame) -> DataFrame:
    """seed, item_id, n_rows (of the seed in hits): an item's seeds but the most frequent in hits (seed), which together stay below `needed`.

    Whatever document covers the item has a seed beyond them. Ties go to the smaller seed.
    """
    frequency = hits.groupBy("seed").agg(F.count(F.lit(1)).alias("documents"))
    along = Window.partitionBy("item_id").orderBy(F.desc("documents"), "seed").rowsBetween(Window.unboundedPreceding, 0)
    spent = item_seed.join(frequency, "seed").withColumn("spent", F.sum("times").over(along))
    return spent.where("spent >= needed").select("seed", "item_id", F.col("documents").alias("n_rows"))


def bit_table(item_seed: DataFrame) -> np.ndarray:
    """Bits of the slots of all seeds. Tasks set them in words of 64 bits, which merge by OR: the driver gets at most SEED_BITS / 64 words."""
    slot = F.col("seed").bitwiseAND(SEED_BITS - 1)
    bit = F.expr(f"shiftleft(1L, cast((seed & {SEED_BITS - 1}) % 64 as int))")
    words = item_seed.groupBy(F.floor(slot / 64).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(SEED_BITS // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return table.view(np.uint8)


def seeded_documents(docs: DataFrame, table: np.ndarray, widths: list[int]) -> DataFrame:
    """doc_id, tokens, seeds of documents with a seed in the bit table."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in slices(batches, "text"):
            found = _tokens(batch.column("text"))
            hashes = found.hashes()
            hits, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for width in widths:
                seed, owner = seeds(hashes, found.bounds, width)
                slot = (seed & np.uint64(SEED_BITS - 1)).astype(np.int64)
                hit = np.flatnonzero(table[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                hits.append(seed[hit])
                owners.append(owner[hit])
            seed, owner = np.concatenate(hits), np.concatenate(owners)
            order = np.lexsort((seed, owner))
            seed, owner = seed[order], owner[order]
            first = np.ones(len(seed), bool)
            first[1:] = (seed[1:] != seed[:-1]) | (owner[1:] != owner[:-1])
            seed, owner = seed[first], owner[first]
            chosen, counts = np.unique(owner, return_counts=True)
            lengths = found.bounds[chosen + 1] - found.bounds[chosen]
            at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(found.bounds[chosen], lengths)
            bounds = lambda sizes: np.concatenate(([0], np.cumsum(sizes)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(chosen)), _lists(hashes[at], bounds(lengths)), _lists(seed, bounds(counts))], ["doc_id", "tokens", "seeds"])

    columns = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    return docs.select(*columns).mapInArrow(rows, "doc_id long, tokens array<long>, seeds array<long>")


def tiles(item: np.ndarray, text: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in item, start in text, length), longest first.

    Ties go to the smaller start in the item, then in the text.
    """
    size = min(min_match, len(item))
    if len(text) < size:
        return []
    where: dict[int, list[int]] = {}
    for at, seed in enumerate(range_hashes(item, np.arange(len(item) - size + 1), np.arange(size, len(item) + 1)).tolist()):
        where.setdefault(seed, []).append(at)
    running = range_hashes(text, np.arange(len(text) - size + 1), np.arange(size, len(text) + 1))
    spots = np.flatnonzero(np.isin(running, np.fromiter(where, np.uint64)))
    i_marks, t_marks = np.zeros(len(item), bool), np.zeros(len(text), bool)

    def reach(i: int, t: int) -> int:
        """Length of the match that begins there, up to a mark."""
        n = min(len(item) - i, len(text) - t)
        stop = np.flatnonzero((item[i : i + n] != text[t : t + n]) | i_marks[i : i + n] | t_marks[t : t + n])
        return int(stop[0]) if len(stop) else n

    queue = []
    ends: dict[int, int] = {}  # per diagonal, the end of its last match: starts inside it are no new ones
    for t in spots.tolist():
        for i in where[int(running[t])]:
            if t >= ends.get(t - i, -1):
                n = reach(i, t)
                ends[t - i] = t + n
                if n >= size:
                    queue.append((-n, i, t))
    heapq.heapify(queue)
    out = []
    while queue:
        length, i, t = heapq.heappop(queue)
        n, free = -length, ~(i_marks[i : i - length] | t_marks[t : t - length])
        if free.all():
            i_marks[i : i + n] = t_marks[t : t + n] = True
            out.append((i, t, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False])).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= size:
                heapq.heappush(queue, (a - b, i + a, t + a))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest_tile of the pairs that reach the coverage.

    Null and empty texts or items match nothing. An item of fewer tokens than
    min_match matches as a whole. Rows without an id are not tested. Rows that
    repeat an id are tested each, and the best coverage counts; equal items
    are reported each. Empty tables give an empty result. Other columns are
    ignored.
    """
    items = keep(item_tokens(benchmark.where("item_id is not null")), "benchmark-tokens")
    item_seed = keep(item_seeds(items, min_match, coverage), "benchmark-seeds")
    widths = [r[0] for r in item_seed.select("width").distinct().collect()]  # at most min_match
    found = seeded_documents(docs.where("doc_id is not null"), bit_table(item_seed), widths)
    found = keep(found.withColumn("row", F.monotonically_increasing_id()), "seeded-documents")
    hits = found.select("row", F.explode("seeds").alias("seed"))
    telling = keep(telling_seeds(item_seed, hits), "telling-seeds")
    pairs = keep(hub_join(hits, telling, "seed", several=True).select("row", "item_id").distinct(), "seeded-pairs")
    # a document travels once for a bundle of its items
    place = F.row_number().over(Window.partitionBy("row").orderBy("item_id"))
    item = F.struct("item_id", F.col("tokens").alias("item"))
    leaked = keep(items.join(pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_rows")), "item_id"), "leaked-items")
    bundles = hub_join(pairs.withColumn("bundle", F.floor((place - 1) / BUNDLE)), leaked, "item_id").groupBy("row", "bundle").agg(F.collect_list(item).alias("items"))
    met = found.select("row", "doc_id", "tokens").join(bundles, "row")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for number, (several, tokens) in enumerate(zip(batch.column("items"), batch.column("tokens"), strict=True)):
                text = tokens.values.to_numpy().view(np.uint64)
                for one in several:
                    item = one["item"].values.to_numpy().view(np.uint64)
                    got = tiles(item, text, min_match)
                    out.append((number, one["item_id"].as_py(), sum(n for _, _, n in got) / len(item), len(got), max((n for _, _, n in got), default=0)))
            columns = zip(*out, strict=True) if out else [()] * 5
            number, *values = (pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32()), strict=True))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(number), *values], ["doc_id", "item_id", "coverage", "n_tiles", "longest_tile"])

    tiled = met.select("doc_id", "items", "tokens").mapInArrow(rows, "doc_id long, item_id long, coverage double, n_tiles int, longest_tile int")
    best = tiled.where(F.col("coverage") >= coverage).groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_tiles", "longest_tile")).alias("b"))
    return best.select("doc_id", "item_id", "b.*")
