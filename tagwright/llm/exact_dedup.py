"""Exact deduplication with a log-structured merge index, in DataFrame operations.

The index lies in a folder and outlives the call. Its runs hold digest, smallest
id and number of rows.

1. Flush: each task is a memtable. It writes the digests of its rows as a file
   of level 0; nothing is shuffled.
2. Compaction: the files of a flush merge into one run of level 1, smallest id
   and count per digest; Spark combines copies before the shuffle, so a hot
   digest sends one row per task. FAN_IN runs of a level merge into one of the
   next. A run is in order of its digests, file after file.
3. Filters: each run has a bit table, sized by its count. The digests of a batch
   are looked up in the tables of the older runs, and only what passes is joined
   with a run. Digests of several rows are the hits; they have such a table too,
   and rows that miss it are unique without a shuffle.
4. Verification: texts of hits are grouped by their bytes, so equal digests of
   unequal texts stay apart.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.llm import versions
from tagwright.llm.common import bit_words, file_system, filter_bits, hub_join, keep, new_path, passing

#: Runs of a level that merge into one of the next.
FAN_IN = 4
#: Parts by which an index of one call is filled: FAN_IN of them are compacted, the last is looked up in what they gave.
PARTS = FAN_IN + 1
RUN = "digest binary, keep_id long, n_rows long"


def normalised(text: str = "text") -> Column:
    """Null is empty; each run of ASCII white space is one space."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _sha(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def _digest(sha: Column, digest_bits: int) -> Column:
    return F.substring(sha, 1, digest_bits // 8)


def runs(spark: SparkSession, root: str) -> list[dict]:
    """run, level, n_rows, bits of the live runs of an index, none if there is no index yet."""
    version = versions.latest_version(spark, root)
    return versions.content(spark, root, version)["runs"] if version else []


def read_run(spark: SparkSession, root: str, run: str) -> DataFrame:
    return spark.read.schema(RUN).parquet(f"{root}/runs/{run}")


def _merge(rows: DataFrame, root: str, level: int, batches: list[str]) -> dict:
    """Write rows as one run in order of its digests, with its filter.

    A flush holds copies, which combine before they are shuffled. Runs hold a
    digest once each, so they are merged range by range: one shuffle to ranges of
    digests, in which equal ones meet and are summed.
    """
    spark, run = rows.sparkSession, uuid.uuid4().hex
    sums = F.min("keep_id").alias("keep_id"), F.sum("n_rows").alias("n_rows")
    merged = rows.groupBy("digest").agg(*sums).repartitionByRange("digest") if level == 1 else rows.repartitionByRange("digest").groupBy("digest").agg(*sums)
    merged.sortWithinPartitions("digest").write.parquet(f"{root}/runs/{run}")
    n = read_run(spark, root, run).count()
    bits = filter_bits(n)
    bit_words(read_run(spark, root, run), "digest", bits).write.parquet(f"{root}/filters/{run}")
    return {"run": run, "level": level, "n_rows": n, "bits": bits, "batches": batches}


def flush(docs: DataFrame) -> DataFrame:
    """doc_id, sha of the rows of docs: a file of each task."""
    return keep(docs.select("doc_id", _sha(normalised()).alias("sha")), "dedup-flush")


def insert(flushed: DataFrame, root: str, digest_bits: int = 256, batch: str | None = None) -> tuple[dict, bool]:
    """Merge a flush into one run of level 1 and add it to the index; the run, and whether it was added.

    A batch that the index holds already, be it from another attempt or another
    writer, is not added again; its run is then one of its own, outside the index.
    """
    spark, batch = flushed.sparkSession, batch or uuid.uuid4().hex
    rows = flushed.select(_digest(F.col("sha"), digest_bits).alias("digest"), F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n_rows"))
    new = _merge(rows, root, 1, [batch])
    while True:
        version, live = versions.latest_version(spark, root), runs(spark, root)
        if any(batch in r["batches"] for r in live):
            return new, False
        if versions.publish(spark, root, version + 1, {"runs": [*live, new]}):
            return new, True


def compact(spark: SparkSession, root: str, fan_in: int = FAN_IN) -> None:
    """Merge runs while a level has fan_in or more. Runs that were merged stay on disk for readers of older versions, until vacuum."""
    while True:
        version, live = versions.latest_version(spark, root), runs(spark, root)
        full = [level for level in sorted({r["level"] for r in live}) if sum(r["level"] == level for r in live) >= fan_in]
        if not full:
            return
        old = [r for r in live if r["level"] == full[0]]
        new = _merge(reduce(DataFrame.unionByName, [read_run(spark, root, r["run"]) for r in old]), root, full[0] + 1, sorted({b for r in old for b in r["batches"]}))
        # another writer's version in between makes this merge void
        versions.publish(spark, root, version + 1, {"runs": [*(r for r in live if r not in old), new]})


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete runs and filters that the last version does not list; how many runs. No writer may be at work, and no reader of an older version."""
    live, system = {r["run"] for r in runs(spark, root)}, None
    dead = []
    for kind in ("runs", "filters"):
        system, at = file_system(spark, f"{root}/{kind}")
        dead = [s.getPath() for s in system.listStatus(at) if s.getPath().getName() not in live] if system.exists(at) else []
        for path in dead:
            system.delete(path, True)
    return len(dead)


def totals(spark: SparkSession, root: str, digests: DataFrame, others: list[dict]) -> DataFrame:
    """digest, keep_id, n_rows of digests (a run's rows) over themselves and other runs, which are read where their filters let a digest pass."""
    found = [digests.select("digest", "keep_id", "n_rows")]
    for r in others:
        words = spark.read.schema("word long, bits long").parquet(f"{root}/filters/{r['run']}")
        found.append(read_run(spark, root, r["run"]).join(passing(digests, words, "digest", r["bits"]).select("digest"), "digest", "left_semi"))
    return reduce(DataFrame.unionByName, found).groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n_rows").alias("n_rows")) if others else found[0]


def shared(spark: SparkSession, root: str) -> DataFrame:
    """digest, n_rows (2 or more) of the digests that have several rows over the live runs: in one of them, or in two, where the filter of the larger lets those of the smaller pass."""
    live = sorted(runs(spark, root), key=lambda r: r["n_rows"])
    found = [read_run(spark, root, r["run"]).where("n_rows > 1").select("digest") for r in live]
    for k, small in enumerate(live):
        for large in live[k + 1 :]:
            words = spark.read.schema("word long, bits long").parquet(f"{root}/filters/{large['run']}")
            maybe = passing(read_run(spark, root, small["run"]), words, "digest", large["bits"]).select("digest")
            found.append(read_run(spark, root, large["run"]).select("digest").join(maybe, "digest", "left_semi"))
    return reduce(DataFrame.unionByName, found).distinct().withColumn("n_rows", F.lit(2).cast("long"))


def lookup(spark: SparkSession, root: str, digests: list[bytes]) -> DataFrame:
    """Runs' rows of a few digests. As runs are in order, Parquet's bounds leave one row group of each run to read."""
    live = [read_run(spark, root, r["run"]).where(F.col("digest").isin(digests)) for r in runs(spark, root)]
    return reduce(DataFrame.unionByName, live, spark.createDataFrame([], RUN))


def classified(docs: DataFrame, flushed: DataFrame, hits: DataFrame, earlier: DataFrame | None, digest_bits: int) -> DataFrame:
    """A row per row of docs, given its flush and the digests that have several rows. Texts of hits are compared by their bytes."""
    hits = keep(hits.where("n_rows > 1").select("digest"), "dedup-hits")
    bits = filter_bits(hits.count())
    words = keep(bit_words(hits, "digest", bits), "dedup-filter")
    members = flushed.withColumn("digest", _digest(F.col("sha"), digest_bits))
    texts = docs.select("doc_id", normalised().alias("norm"))
    texts = texts if earlier is None else texts.unionByName(earlier.select("doc_id", normalised().alias("norm")))
    texts = texts.withColumn("digest", _digest(_sha(F.col("norm")), digest_bits))
    per_text = F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    classes = passing(texts, words, "digest", bits).groupBy("digest", "norm").agg(*per_text).select("digest", _sha(F.col("norm")).alias("text_sha"), "keep_id", "group_size")
    classes = keep(classes, "dedup-classes")
    unequal = classes.groupBy("digest").count().where("count > 1").select("digest")
    columns = "doc_id", "sha", "keep_id", "group_size"
    met = passing(members, words, "digest", bits)
    if unequal.isEmpty():
        found = hub_join(met, classes.select("digest", "keep_id", "group_size", F.col("group_size").alias("n_rows")), "digest").select(*columns)
    elif digest_bits < 256:  # texts that differ share a cut digest; their whole one tells them apart
        whole = classes.select(F.col("text_sha").alias("sha"), "keep_id", "group_size", F.col("group_size").alias("n_rows"))
        found = hub_join(met, keep(whole, "dedup-whole"), "sha").select(*columns)
    else:  # two texts of one SHA-256: rows are matched by their bytes
        apart = docs.select("doc_id", normalised().alias("norm")).withColumn("sha", _sha(F.col("norm"))).withColumn("digest", F.col("sha"))
        apart = passing(apart, words, "digest", bits)
        found = apart.join(passing(texts, words, "digest", bits).groupBy("norm").agg(*per_text), "norm").select(*columns)
    unique = passing(members, words, "digest", bits, False).select("doc_id", "sha", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    return found.unionByName(unique).select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("group_size") == 1) | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, digest_bits: int = 256, root: str | None = None, earlier: DataFrame | None = None, batch: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    root: an index that earlier batches have filled; docs are added to it, and
    keep_id and group_size count the earlier documents too. By default a new one,
    which docs fill part by part, with compaction on the way.
    earlier: those documents, of which the texts that docs may equal are compared.
    batch: a name of docs; a call that failed can be made again with it and counts docs once.
    digest_bits below 256 makes digests collide, which costs time and changes
    nothing; it must be the same for all batches of an index.

    docs needs doc_id and text; other columns are ignored. Null text is empty.
    Rows of a null doc_id take part; they stay only where the whole group has no
    id (keep_id is then null). Rows that repeat an id and a text are one
    document: all of them are kept if the id is the smallest. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    if root is None and earlier is None:
        root, flushed = new_path(spark, "dedup-index"), flush(docs)
        for part in range(PARTS):
            insert(flushed.where(F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)) == part), root, digest_bits)
            compact(spark, root)
        return classified(docs, flushed, shared(spark, root), None, digest_bits)
    root = root or new_path(spark, "dedup-index")
    older = runs(spark, root)
    if any(r["batches"] != [batch] for r in older) and earlier is None:
        raise ValueError("the index holds earlier documents; pass them, as equal digests are compared by their texts")
    flushed = flush(docs)
    new, added = insert(flushed, root, digest_bits, batch)
    digests = read_run(spark, root, new["run"])
    hits = totals(spark, root, digests if added else digests.withColumn("n_rows", F.lit(0).cast("long")), older if added else runs(spark, root))
    out = classified(docs, flushed, hits, earlier, digest_bits)
    compact(spark, root)
    return out


ORACLE = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
