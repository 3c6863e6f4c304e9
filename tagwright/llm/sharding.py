"""Sharding by size-tiered compaction, in DataFrame operations.

A root folder holds immutable Parquet files, the shards, and versions. A version
lists its live files; nothing else is part of it.

- append: each task writes its rows as small files (tier 0); nothing is shuffled.
- compact: in each tier, files smaller than the tier's size are put in order of
  size and merged, neighbours with neighbours, into files of about that size;
  what a tier makes takes part in the next, and only the end of it is written.
  Files that are large enough, or too few to merge, stay where they are.
- commit: a version becomes visible by the rename of one small file, which fails
  if another writer took its number; the loser applies its change to the version
  that won. A crash before that leaves files that no version lists; vacuum
  deletes them.

Sizes are those of files. Planning works on one row a file, in groups of bounded
size; ids play no part in it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tagwright.llm import versions
from tagwright.llm.common import broadcast_up_to, exists, file_system, keep
from tagwright.llm.versions import latest_version

#: Rows of an arriving file at most.
ARRIVAL_ROWS = 1024
#: Bytes from which a file leaves a tier; the last is the target size.
TIERS = (2 << 20, 16 << 20)
#: Files of a tier that make a merge worth its writing.
FAN_IN = 4
#: Files of a tier's size in one planning group, in bytes of that size.
SPAN = 256
#: Bytes that one task of a compaction writes, if a shard is not larger.
TASK_BYTES = 16 << 20
#: Up to so many merged files the plan is broadcast to the writers (some 200 bytes each), beyond that joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Files that are named to a reader one by one.
LISTED_FILES = 100_000

#: Of the files; they are written twice and read often.
COMPRESSION = "zstd"
MANIFEST = "file string, shard_tier int, n_bytes long, n_docs long"
_SHARD = ("shard_id", "shard_tier")
_FOLDER = r"^(.*/shard_tier=\d+)/"


class Conflict(RuntimeError):
    """Another writer has replaced files that this one meant to replace."""


def manifest(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """file, shard_tier, n_bytes, n_docs of the live files of a version (the last), empty if there is none."""
    version = version or latest_version(spark, root)
    if not version:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{versions.content(spark, root, version)['manifest']}")


def commit(spark: SparkSession, root: str, schema: StructType, added: DataFrame, removed: DataFrame | None = None) -> int:
    """Commit the last version with files added and removed; the new version.

    Of two writers the second starts again from what the first committed, unless
    that lacks files which it replaces.
    """
    while True:
        version = latest_version(spark, root)
        if version and versions.content(spark, root, version)["schema"] != json.loads(schema.json()):
            raise ValueError("the rows have other columns than those under this root")
        live = manifest(spark, root, version)
        if removed is not None:
            if not removed.join(live, "file", "left_anti").isEmpty():
                raise Conflict(f"version {version} has other files than those that were merged")
            live = live.join(removed, "file", "left_anti")
        name = uuid.uuid4().hex
        live.unionByName(added).write.parquet(f"{root}/manifests/{name}")
        if versions.publish(spark, root, version + 1, {"manifest": name, "schema": json.loads(schema.json())}):
            return version + 1


def _rows(spark: SparkSession, schema: StructType, files: DataFrame) -> DataFrame:
    """__row and __file of the rows of the files, which alone are opened; of more than LISTED_FILES of the folders that hold some of them."""
    paths = [unquote(r[0]) for r in files.select("file").limit(LISTED_FILES + 1).collect()]
    if len(paths) > LISTED_FILES:
        paths = [r[0] for r in files.select(F.regexp_extract("file", _FOLDER, 1)).distinct().collect()]  # one a write
    if not paths:
        rows, file = spark.createDataFrame([], schema), F.lit("")
    else:
        rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
        file = rows.metadataColumn("_metadata")["file_path"]
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in schema.names]).alias("__row"), file.alias("__file"))


def _files(spark: SparkSession, schema: StructType, folder: str) -> DataFrame:
    """Manifest rows of the files just written; only their footers are read."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(folder)
    about = rows.metadataColumn("_metadata")
    per = rows.groupBy(about["file_path"].alias("file"), about["file_size"].alias("n_bytes")).agg(F.count(F.lit(1)).alias("n_docs"))
    return keep(per.select("file", F.regexp_extract("file", r"/shard_tier=(\d+)/", 1).cast("int").alias("shard_tier"), "n_bytes", "n_docs"), "shard-files")


def append(docs: DataFrame, root: str, arrival_rows: int = ARRIVAL_ROWS) -> int:
    """Add docs as small shards; the version committed. Columns of docs named shard_id or shard_tier are dropped."""
    spark, docs = docs.sparkSession, docs.drop(*_SHARD)
    folder = f"{root}/data/{uuid.uuid4().hex}"
    docs.write.options(maxRecordsPerFile=arrival_rows, compression=COMPRESSION).parquet(f"{folder}/shard_tier=0")
    return commit(spark, root, docs.schema, _files(spark, docs.schema, folder))


def plan(files: DataFrame, tiers: Sequence[int] = TIERS, fan_in: int = FAN_IN, span: int = SPAN) -> DataFrame:
    """file, n_bytes, shard, shard_tier of the files to merge. shard: the least file name of those that become one.

    In each tier the files (and what smaller tiers made) under its size are
    dealt by a hash to groups of about span times that size. A group is put in
    order of size and cut where the running sum passes multiples of the tier's
    size. fan_in files or more of one piece are merged.
    """
    placed = keep(files.select("file", "n_bytes", F.col("file").alias("shard"), "shard_tier"), "shard-plan")
    for tier, most in enumerate(tiers, 1):
        shards = placed.groupBy("shard").agg(F.sum("n_bytes").alias("size"))
        small = keep(shards.where(F.col("size") < most), "shard-small")
        groups = max(1, (small.agg(F.sum("size")).first()[0] or 0) // (most * span))
        along = Window.partitionBy("group").orderBy("size", "shard").rowsBetween(Window.unboundedPreceding, 0)
        cut = small.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)))
        cut = cut.withColumn("piece", F.floor((F.sum("size").over(along) - F.col("size")) / most))
        together = Window.partitionBy("group", "piece")
        merged = cut.select("shard", F.min("shard").over(together).alias("into"), F.count(F.lit(1)).over(together).alias("n")).where(F.col("n") >= fan_in)
        placed = placed.join(merged, "shard", "left").select(
            "file", "n_bytes", F.coalesce("into", "shard").alias("shard"), F.when(F.col("into").isNotNull(), tier).otherwise(F.col("shard_tier")).alias("shard_tier")
        )
        placed = keep(placed, "shard-plan")
    several = placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shard")
    return keep(placed.join(several, "shard"), "shard-merges")


def _tasks(merges: DataFrame, task_bytes: int, span: int) -> tuple[DataFrame, int]:
    """merges with number (of the shard in its task) and task, and how many tasks: runs of shards of about task_bytes."""
    shards = merges.groupBy("shard").agg(F.sum("n_bytes").alias("size"))
    groups = max(1, (merges.agg(F.sum("n_bytes")).first()[0] or 0) // (task_bytes * span))
    along = Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    cut = shards.withColumn("group", F.pmod(F.xxhash64("shard"), F.lit(groups)))
    cut = cut.select("shard", "group", F.floor((F.sum("size").over(along) - F.col("size")) / task_bytes).alias("run"), F.count(F.lit(1)).over(along).alias("number"))
    cut = keep(cut, "shard-tasks")
    runs = 1 + (cut.agg(F.max("run")).first()[0] or 0)
    task = (F.col("group") * runs + F.col("run")).cast("int")
    return merges.join(cut, "shard").select("file", "shard_tier", F.concat_ws("-", "group", "number").alias("shard_id"), task.alias("task")), int(groups * runs)


def compact(spark: SparkSession, root: str, tiers: Sequence[int] = TIERS, fan_in: int = FAN_IN, span: int = SPAN, task_bytes: int = TASK_BYTES) -> int:
    """Merge what the last version holds too many small files of; the version committed, or the last if there is nothing to merge."""
    version = latest_version(spark, root)
    merges = plan(manifest(spark, root, version), tiers, fan_in, span)
    if merges.isEmpty():
        return version
    schema = StructType.fromJson(versions.content(spark, root, version)["schema"])
    dealt, tasks = _tasks(merges, task_bytes, span)
    dealt = keep(dealt.withColumnRenamed("file", "__file"), "shard-dealt")
    rows = _rows(spark, schema, merges)
    rows = rows.join(broadcast_up_to(dealt, BROADCAST_ROWS), "__file")
    folder = f"{root}/data/{uuid.uuid4().hex}"
    (
        rows.repartitionById(tasks, F.col("task"))
        .sortWithinPartitions("shard_tier", "shard_id")
        .select(*[F.col(f"__row.`{c}`") for c in schema.names], "shard_tier", "shard_id")
        .write.option("compression", COMPRESSION)
        .partitionBy("shard_tier", "shard_id")
        .parquet(folder)
    )
    return commit(spark, root, schema, _files(spark, schema, folder), merges.select("file"))


def read_shards(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a committed version (the last), with shard_id (the file below root) and shard_tier."""
    version = version or latest_version(spark, root)
    if not version:
        raise ValueError(f"no version under {root}")
    schema = StructType.fromJson(versions.content(spark, root, version)["schema"])
    files = manifest(spark, root, version)
    rows = _rows(spark, schema, files)
    live = files.select(F.col("file").alias("__file"), F.regexp_extract("file", r"/(data/[^/]+/shard_tier=.*)$", 1).alias("shard_id"), "shard_tier")
    rows = rows.join(broadcast_up_to(live, BROADCAST_ROWS), "__file")
    return rows.select(*[F.col(f"__row.`{c}`") for c in schema.names], *_SHARD)


def vacuum(spark: SparkSession, root: str, last: int = 1) -> int:
    """Delete the folders that none of the last versions lists a file of; how many. No writer may be at work."""
    newest, used = latest_version(spark, root), set()
    for version in range(max(1, newest - last + 1), newest + 1):
        used |= {r[0] for r in manifest(spark, root, version).select(F.regexp_extract("file", r"/data/([^/]+)/", 1)).distinct().collect()}
    if not exists(spark, f"{root}/data"):
        return 0
    system, at = file_system(spark, f"{root}/data")
    idle = [status.getPath() for status in system.listStatus(at) if status.getPath().getName() not in used]
    for path in idle:
        system.delete(path, True)
    return len(idle)


def sharded(docs: DataFrame, root: str, arrival_rows: int = ARRIVAL_ROWS, tiers: Sequence[int] = TIERS, fan_in: int = FAN_IN, span: int = SPAN) -> DataFrame:
    """Append docs under root, compact, and read the last version: its rows with shard_id and shard_tier.

    Every row is kept, repeated ones and those with nulls too; ids and texts are
    not looked at. A row larger than the target makes a file of its own size. An
    empty table adds no file. Columns of docs named shard_id or shard_tier are
    replaced.
    """
    spark = docs.sparkSession
    append(docs, root, arrival_rows)
    return read_shards(spark, root, compact(spark, root, tiers, fan_in, span))
