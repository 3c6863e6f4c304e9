"""Near-duplicates by the exact Jaccard similarity of their five-word shingles.

A 64-bit SimHash alone does not retrieve pairs of similarity 0.8: they differ in
about 10 bits. Candidates are therefore linked in two ways, by SimHash anchors
(fingerprints of at most 4 differing bits) and by bands of minima of the same
shingle hashes: 32 bands of 7 miss a pair of similarity 0.8 with probability
0.0005, and more similar ones less. Links only gather texts into groups; within
a group every pair that is not yet connected is compared on its whole shingle
sets. Large groups are cut into cells of members against members. Texts of the
same shingle set are one member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright.llm import simhash
from tagwright.llm.arrays import mixed, slices
from tagwright.llm.common import bit_words, broadcast_up_to, discard, filter_bits, keep, passing
from tagwright.llm.components import components

SHINGLE = 5
#: Least Jaccard similarity of two near-duplicates, as a fraction.
SIMILAR = (4, 5)
BANDS, ROWS = 32, 7
#: Members of one side of a cell.
CELL = 1024
#: Keys of bands that several texts share are broadcast up to this many, else joined by a shuffle.
BROADCAST_KEYS = 200_000
#: Rows of the cells' members (40 bytes each) that are broadcast to the texts, else joined by a shuffle.
BROADCAST_CELLS = 400_000
#: Shingles whose minima are taken at once.
_CHUNK = 2048

_salts = mixed(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def band_keys(members: np.ndarray) -> np.ndarray:
    """A key for each band of the minima of a shingle set; none of an empty one."""
    if not len(members):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), _CHUNK):
        np.minimum(least, (members[at : at + _CHUNK, None] * _salts).min(0), out=least)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = mixed(keys ^ column) + np.arange(1, BANDS + 1, dtype=np.uint64)
    return keys.view(np.int64)


def prints(rows: DataFrame) -> DataFrame:
    """__row, doc_id, digest of the shingle set, fp and keys of every row, from its whole text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            digests, fps, keys = [], [], []
            for hashes in simhash.shingle_hashes(batch.column("text"), SHINGLE):
                members = np.unique(hashes)
                digests.append(xxhash.xxh3_128_digest(members.tobytes()))
                fps.append(simhash.fingerprint(hashes))
                keys.append(band_keys(members))
            bounds = pa.array(np.concatenate(([0], np.cumsum([len(k) for k in keys]))), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))
            columns = [batch.column("__row"), batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(fps, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, ["__row", "doc_id", "digest", "fp", "keys"])

    columns = F.col("__row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    return rows.select(*columns).mapInArrow(made, "__row long, doc_id long, digest binary, fp long, keys array<long>")


def candidates(members: DataFrame, used: list[DataFrame]) -> DataFrame:
    """u, v: links between members (node, fp, keys) that may be similar; fewer than there are pairs. used gets the tables that they are read from."""
    keyed = members.select(F.col("node").alias("u"), F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("u").alias("v"), F.max("u").alias("last")).where("v < last").drop("last")
    shared, firsts = keep(shared, "near-shared"), keep(members.groupBy("fp").agg(F.min("node").alias("first_node")), "near-firsts")
    used += [shared, firsts]
    bands = keyed.join(broadcast_up_to(shared, BROADCAST_KEYS), "key").where("u <> v").select("u", "v")
    named = lambda end: firsts.select(F.col("fp").alias(end), F.col("first_node").alias(f"{end}_node"))
    anchors = simhash.links(firsts, used=used).join(named("u"), "u").join(named("v"), "v").select(F.col("u_node").alias("u"), F.col("v_node").alias("v"))
    same = members.join(firsts, "fp").where("node <> first_node").select(F.col("node").alias("u"), F.col("first_node").alias("v"))
    return bands.unionByName(anchors).unionByName(same)


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever is similar between the sets at left and at right: fewer than there are sets."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, word = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(word, kind="stable")
    posted, begins = owner[order], np.searchsorted(word[order], np.arange(word.max(initial=-1) + 2))
    at = np.concatenate(([0], np.cumsum(sizes)))
    group = np.arange(len(sets))
    out = []
    for i in left.tolist():
        if not (group[right] != group[i]).any():
            continue
        mine = word[at[i] : at[i + 1]]
        n = begins[mine + 1] - begins[mine]
        where = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[mine], n)
        common = np.bincount(posted[where], minlength=len(sets))[right]
        near = right[(SIMILAR[1] * common >= SIMILAR[0] * (sizes[i] + sizes[right] - common)) & (group[right] != group[i])]
        if len(near):
            met, first = np.unique(group[near], return_index=True)
            out += [(i, j) for j in near[first].tolist()]
            group[np.isin(group, met)] = group[i]
    return out


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells arrive in order, each whole: compare the texts of each."""
    names = "root", "low", "high"

    def links(table: pa.Table) -> pa.RecordBatch:
        nodes, part, low, high = (table.column(c).to_numpy() for c in ("node", "part", "low", "high"))
        sets = [np.unique(h) for h in simhash.shingle_hashes(table.column("text").combine_chunks(), SHINGLE)]
        found = similar(sets, np.flatnonzero(part == low), np.flatnonzero(part == high))
        u, v = nodes[np.array(found, np.int64).reshape(-1, 2)].T
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    held: list[pa.RecordBatch] = []
    cell = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and cell != tuple(keys[:, a]):
                yield links(pa.Table.from_batches(held))
                held = []
            cell = tuple(keys[:, a])
            held.append(batch.slice(a, b - a))
    if held:
        yield links(pa.Table.from_batches(held))


def verified(rows: DataFrame, groups: DataFrame, cell: int = CELL) -> DataFrame:
    """u, v: links between nodes of a group (node, root) that keep the components of all pairs of similar texts."""
    parts = keep(groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / cell).cast("int").alias("parts")), "near-parts")
    placed = groups.join(parts, "root").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    cells = placed.select("root", "node", "part", other).select("root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "node", "part")
    cells = keep(cells, "near-cells")
    # only texts of groups travel: a filter stops most others before the join
    bits = filter_bits(groups.count())
    words = keep(bit_words(groups, "node", bits), "near-filter")
    texts = passing(rows.select(F.col("__row").alias("node"), F.col("text").cast("string").alias("text")), words, "node", bits)
    key = "root", "low", "high"
    met = texts.join(broadcast_up_to(cells, BROADCAST_CELLS), "node").select(*key, "node", "part", "text")
    return met.repartition(*key).sortWithinPartitions(*key).mapInArrow(_compare, "u long, v long")


def without_near_duplicates(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """One row of each component of similar texts: the smallest id, of equal ids the smallest __row.

    rows is a written table with a number of its own in __row. Texts of under 5
    words are one shingle; texts without words (null, empty, white space) are
    one component. Rows and not ids are decided on: a row of a null id stays
    only where no member has one. Other columns are returned as they are.
    """
    found = keep(prints(rows), "near-prints")
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row")
    members = found.groupBy("digest").agg(F.min("__row").alias("node"), F.min(first).alias("first"), F.min("fp").alias("fp"), F.min("keys").alias("keys"))
    members, used = keep(members, "near-members"), []
    groups = keep(components(candidates(members, used)), "near-groups")
    discard(*used)
    roots = components(verified(rows, groups, cell))
    rooted = members.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = keep(rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.__row").alias("__row")), "near-kept")
    gone = keep(found.select("__row").join(kept, "__row", "left_anti"), "near-gone")
    discard(found, members, groups)
    # rows that a filter of those that go does not know stay where they are
    bits = filter_bits(gone.count())
    words = keep(bit_words(gone, "__row", bits), "near-gone-filter")
    asked = passing(rows, words, "__row", bits).join(gone, "__row", "left_anti")
    return passing(rows, words, "__row", bits, False).unionByName(asked).select(rows.columns)
