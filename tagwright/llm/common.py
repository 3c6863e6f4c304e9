"""The written tables of the library, size-checked broadcasts, hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.sources.staging import discard, exists, file_system, keep, new_path, shared_dir

__all__ = ["bit_words", "broadcast_up_to", "discard", "exists", "file_system", "filter_bits", "hub_join", "keep", "new_path", "passing", "remainder", "shared_dir", "unit_hash"]

#: Keys that hub_join broadcasts at most; a key has more than this share of all rows, or more than HUB_ROWS of them.
HUBS, HUB_ROWS = 100_000, 128
#: Bits of a filter a key, and the least and most bits of one: at most 2**20 words of 64 bits are broadcast. A full filter lets more rows through to what is exact.
BITS_A_KEY, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 26


def broadcast_up_to(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast if a count shows at most max_rows, else leave a shuffle join.

    df should be a written table: it is counted here and read again by the join.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def hub_join(rows: DataFrame, facts: DataFrame, key: str, several: bool = False) -> DataFrame:
    """Inner join of rows with facts (n_rows: rows of that key) where a few keys may have most rows.

    facts should be a written table, of one row a key, or of few (several). Hubs,
    keys of more than `most` rows, number at most HUBS (their rows sum to no more than all),
    so they are broadcast and their rows stay where they are; the rest is
    shuffled, and no key of it has more than `most` rows. n_rows is dropped.
    """
    total = facts.agg(F.sum("n_rows")).first()[0] or 0
    most = max(HUB_ROWS, total // HUBS)
    facts, n_rows = facts.drop("n_rows"), facts.select(key, "n_rows")
    hubs = n_rows.where(F.col("n_rows") > most).select(key)
    hubs = hubs.distinct() if several else hubs
    if hubs.isEmpty():
        return rows.join(facts, key)
    hub_facts = F.broadcast(facts.join(F.broadcast(hubs), key))
    return rows.join(hub_facts, key).unionByName(rows.join(F.broadcast(hubs), key, "left_anti").join(facts, key))


def filter_bits(n_keys: int) -> int:
    """Bits of a filter for so many keys, a power of two."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_KEY * n_keys - 1).bit_length()))


def _place(key: str, bits: int) -> tuple[Column, Column]:
    """Word of a key in a filter, and its bit there."""
    slot = F.xxhash64(key).bitwiseAND(F.lit(bits - 1))
    return F.shiftright(slot, 6), F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))


def bit_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """word, bits: the filter of keys."""
    word, bit = _place(key, bits)
    return keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def passing(rows: DataFrame, words: DataFrame, key: str, bits: int, how: bool = True) -> DataFrame:
    """rows that a filter lets through, or those that it does not. At most MOST_BITS / 64 words are broadcast."""
    word, bit = _place(key, bits)
    words = words.select(F.col("word").alias("__word"), F.col("bits").alias("__bits"))
    return rows.join(F.broadcast(words), (word == F.col("__word")) & (F.col("__bits").bitwiseAND(bit) != 0), "left_semi" if how else "left_anti")


def unit_hash(*parts: Column) -> Column:
    """52 bits of an MD5 over the parts, as an integer; the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus
