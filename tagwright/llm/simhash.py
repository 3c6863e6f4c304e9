"""SimHash near-duplicates found by anchor-point covering.

The 64 bits are cut into blocks. Fingerprints that differ in at most max_bits
bits differ in at most max_bits // blocks bits of some block (the rim). The
anchors of a block are the words whose first bits lie in a Hamming code, whose
covering radius is 1: every fingerprint has one home anchor within it. It is also
replicated to every anchor within the covering radius plus the rim. Two linked
fingerprints thus meet at the home anchor of either, where they are compared in
full. An anchor with many members is cut into cells of members against members,
each of bounded size. A cell returns a spanning forest of its links, not all
pairs.

Any layout gives the same links; it sets what they cost. With few anchors a
fingerprint has few replicas but meets many others, so the length of the code
follows the number of distinct fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm.arrays import slices, spaced, words
from tagwright.llm.common import broadcast_up_to, discard, hub_join, keep
from tagwright.llm.components import components

SHINGLE = 4
MAX_BITS = 4
#: Members of one side of a cell. Larger anchors are cut, at any size of the input.
CELL = 4096
#: Anchors that are cut are broadcast up to this many, else joined by a shuffle.
BROADCAST_ANCHORS = 200_000


class Layout(NamedTuple):
    """Blocks of the 64 bits, and parity bits of the Hamming code [2**parity - 1] within each."""

    blocks: int = 3
    parity: int = 4

    @property
    def code_bits(self) -> int:
        return (1 << self.parity) - 1

    def spans(self) -> list[tuple[int, int]]:
        """First bit and width of each block."""
        edges = [64 * k // self.blocks for k in range(self.blocks + 1)]
        if min(b - a for a, b in zip(edges, edges[1:], strict=False)) < self.code_bits:
            raise ValueError(f"blocks of {64 // self.blocks} bits are shorter than the code of {self.code_bits}")
        return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


#: About 14 replicas a block at 2**17 anchors or more; and about 160 at 2**27 or more.
SHORT, LONG = Layout(3, 4), Layout(2, 5)


def shingle_hashes(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 with seed 42 of each text's shingles of words, joined by single spaces."""
    found = words(column)
    bounds = found.bounds
    line, at = spaced(found)
    text, digest = memoryview(line.tobytes()), xxhash.xxh64_intdigest
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        n = last - first
        if n == 0:
            yield np.zeros(0, np.uint64)
            continue
        k = min(n, size)
        begins, ends = at[first : last - k + 1].tolist(), (at[first + k : last + 1] - 1).tolist()
        yield np.fromiter((digest(text[b:e], 42) for b, e in zip(begins, ends, strict=True)), np.uint64, n - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes, as a signed long."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp of every row, from its whole text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fps = [fingerprint(h) for h in shingle_hashes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(rows, "doc_id long, fp long")


def flips(parity: int, rim: int) -> list[np.ndarray]:
    """Of each syndrome, what turns a word with it into the codewords within 1 + rim bits; the nearest first."""
    n = (1 << parity) - 1
    out: list[list[int]] = [[] for _ in range(n + 1)]
    for weight in range(rim + 2):
        for bits in combinations(range(1, n + 1), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= bit
            out[syndrome].append(sum(1 << (bit - 1) for bit in bits))
    return [np.array(x, np.int64) for x in out]


def syndromes(words: np.ndarray, parity: int) -> np.ndarray:
    """Sum of the places of the bits that are set, without carry; 0 for codewords."""
    out = np.zeros_like(words)
    for bit in range((1 << parity) - 1):
        out ^= (words >> bit & 1) * (bit + 1)
    return out


def anchor_rows(fps: np.ndarray, max_bits: int = MAX_BITS, layout: Layout = SHORT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, anchor number and whether it is home, for all replicas."""
    bits, code_bits = fps.view(np.uint64), layout.code_bits
    rim = max_bits // layout.blocks
    index, anchors, homes = [], [], []
    for number, (low, width) in enumerate(layout.spans()):
        block = ((bits >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
        code, free = block & ((1 << code_bits) - 1), block >> code_bits
        of = syndromes(code, layout.parity)
        for outside in range(min(rim, width - code_bits) + 1):
            others = np.array([sum(1 << bit for bit in some) for some in combinations(range(width - code_bits), outside)], np.int64)
            patterns = flips(layout.parity, rim - outside)
            size = np.array([len(x) for x in patterns])
            flat, begins = np.concatenate(patterns), np.cumsum(size) - size
            n = size[of]
            who = np.repeat(np.arange(len(fps)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            word = code[who] ^ flat[np.repeat(begins[of], n) + at]
            for other in others.tolist():
                index.append(who)
                anchors.append((number << 60) | ((free[who] ^ other) << code_bits) | word)
                homes.append(at == 0 if outside == 0 else np.zeros(len(who), bool))
    return np.concatenate(index), np.concatenate(anchors), np.concatenate(homes)


def replicas(fps: DataFrame, max_bits: int = MAX_BITS, layout: Layout = SHORT) -> DataFrame:
    """anchor, fp, home: each fingerprint at its anchors."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy(zero_copy_only=False)
            index, anchors, homes = anchor_rows(values, max_bits, layout)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(values[index]), pa.array(homes)], ["anchor", "fp", "home"])

    return fps.select("fp").mapInArrow(rows, "anchor long, fp long, home boolean")


def forest(homes: np.ndarray, others: np.ndarray, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links that connect whatever is linked between homes and others: fewer than both have members."""
    members = np.unique(np.concatenate((homes, others)))
    group = np.arange(len(members))
    right = np.searchsorted(members, others)
    for value, me in zip(homes, np.searchsorted(members, homes), strict=True):
        near = right[np.bitwise_count((others ^ value).view(np.uint64)) <= max_bits]
        met = np.unique(group[near])
        if len(met) and (len(met) > 1 or met[0] != group[me]):
            met = np.union1d(met, group[me : me + 1])
            group[np.isin(group, met)] = met[0]
    moved = np.flatnonzero(group != np.arange(len(members)))
    return [(int(members[i]), int(members[group[i]])) for i in moved]


def _compare(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Cells arrive in order, each whole: compare the members of each."""
    from itertools import chain

    names = "anchor", "home_part", "other_part"

    def links(table: pa.Table) -> pa.RecordBatch:
        keys = np.stack([table.column(c).to_numpy() for c in names])
        fps, home, other = (table.column(c).to_numpy() for c in ("fp", "is_home", "is_other"))
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
        bounds = np.concatenate(([0], cuts, [len(fps)]))
        some = np.flatnonzero(np.diff(bounds) > 1)
        got = chain.from_iterable(forest(fps[a:b][home[a:b]], fps[a:b][other[a:b]], max_bits) for a, b in zip(bounds[some], bounds[some + 1], strict=True))
        u, v = np.array(list(got) or np.zeros((0, 2)), np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([rest, table]) if rest is not None else table
        last = [table.column(c)[-1].as_py() for c in names]
        same = np.all([table.column(c).to_numpy() == x for c, x in zip(names, last, strict=True)], axis=0)
        at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if at:
            yield links(table.slice(0, at))
        rest = table.slice(at)
    if rest is not None:
        yield links(rest)


def links(fps: DataFrame, cell: int = CELL, max_bits: int = MAX_BITS, layout: Layout = SHORT, used: list[DataFrame] | None = None) -> DataFrame:
    """u, v: links between distinct fingerprints that keep the components of all links of at most max_bits bits. used gets the tables that they are read from."""
    placed = keep(replicas(fps, max_bits, layout), "simhash-replicas")
    if used is not None:
        used.append(placed)
    sizes = placed.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count(F.lit(1)).alias("others"))
    parts = lambda n: F.ceil(F.col(n) / cell).cast("int")
    met = sizes.where("homes > 0 and others > 1")
    cut = keep(met.where(F.col("others") > cell).select("anchor", parts("homes").alias("home_parts"), parts("others").alias("other_parts")), "simhash-cut")
    rows = placed.join(broadcast_up_to(cut, BROADCAST_ANCHORS), "anchor", "left")
    whole = F.lit(1)
    home_parts, other_parts = F.coalesce("home_parts", whole), F.coalesce("other_parts", whole)
    mine_home = F.pmod(F.xxhash64("fp"), home_parts).cast("int")
    mine_other = F.pmod(F.xxhash64("fp", F.lit(1)), other_parts).cast("int")
    cells = F.array_union(
        F.when(F.col("home"), F.transform(F.sequence(F.lit(0), other_parts - 1), lambda o: F.struct(mine_home.alias("h"), o.alias("o")))).otherwise(F.array().cast("array<struct<h:int,o:int>>")),
        F.transform(F.sequence(F.lit(0), home_parts - 1), lambda h: F.struct(h.alias("h"), mine_other.alias("o"))),
    )
    dealt = rows.select("anchor", "fp", "home", mine_home.alias("_h"), mine_other.alias("_o"), F.explode(cells).alias("c")).select(
        "anchor",
        F.col("c.h").alias("home_part"),
        F.col("c.o").alias("other_part"),
        "fp",
        (F.col("home") & (F.col("c.h") == F.col("_h"))).alias("is_home"),
        (F.col("c.o") == F.col("_o")).alias("is_other"),
    )
    key = "anchor", "home_part", "other_part"
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(lambda batches: _compare(batches, max_bits), "u long, v long")


def simhash_groups(docs: DataFrame, cell: int = CELL, max_bits: int = MAX_BITS, layout: Layout = SHORT) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id reachable over links of at most max_bits
    differing bits. Texts without words (null, empty, white space) have
    fingerprint zero and are linked like any other. Texts of under 4 words are
    one shingle. Rows that repeat an id or a text come out each; a null id never
    names a component unless no member has one. An empty table gives an empty
    result. Other columns are ignored. LONG suits more than some 10**8 distinct
    fingerprints.
    """
    prints = keep(fingerprints(docs), "simhash-prints")
    distinct = keep(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_docs")), "simhash-distinct")
    used: list[DataFrame] = []
    roots = components(links(distinct, cell, max_bits, layout, used)).select(F.col("node").alias("fp"), "root")
    rooted = keep(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-roots")
    per_root = keep(rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_rows")), "simhash-components")
    named = keep(hub_join(rooted, per_root, "root").select("fp", "component_id", F.col("n_docs").alias("n_rows")), "simhash-named")
    discard(distinct, rooted, per_root, *used)
    return hub_join(prints, named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
