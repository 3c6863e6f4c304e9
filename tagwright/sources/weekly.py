"""A store of rows by week that is never seen half merged.

Rows lie in a folder a week; a version is a small file that names the folders of
the weeks, and is taken once. A merge writes the weeks that it touches to new
folders and publishes the next version: readers see the old one or the new one,
weeks that it does not touch keep their very files, and of two writers the second
merges again on what the first has made. A crash leaves folders that no version
names, which vacuum deletes.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.sources import versions
from tagwright.sources.staging import discard, file_system, keep

UNKNOWN = "unknown-week"
#: Rows of a task that writes weeks.
ROWS_A_TASK = 1_000_000
ORDER = ("year_week", "country", "retailer", "file")


class Merge(NamedTuple):
    """What a merge did: the version, and the weeks that it wrote and those that are gone."""

    version: int
    written: list[str]
    gone: list[str]


def week_of(year_week: str = "year_week") -> Column:
    return F.when(F.coalesce(year_week, F.lit("")) == "", UNKNOWN).otherwise(F.col(year_week))


def weeks(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Folder of each week, as of a version (the last one)."""
    version = versions.latest_version(spark, root) if version is None else version
    return versions.content(spark, root, version)["weeks"] if version else {}


def read_weeks(spark: SparkSession, root: str, only: list[str] | None = None, version: int | None = None) -> DataFrame | None:
    """Rows of the weeks (all), None if there are none. Only the folders of these weeks are read."""
    folders = [f"{root}/{f}" for w, f in sorted(weeks(spark, root, version).items()) if only is None or w in only]
    return spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None


def _dealt(rows: DataFrame) -> DataFrame:
    """rows with week, dealt by week and order to ranges: a large week takes as many tasks as it needs, and its files follow each other in order."""
    order = [F.coalesce(c, F.lit("")) for c in ORDER if c in rows.columns]
    by = ["week", *order, F.col("_tie")]  # rows that are equal in the order are told apart, so that they are no single range
    ties = [c for c, kind in rows.dtypes if "map" not in kind and "variant" not in kind]
    tied = rows.withColumn("week", week_of()).withColumn("_tie", F.xxhash64(*ties))
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_A_TASK))
    return tied.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("_tie")


def _write(rows: DataFrame, root: str) -> dict[str, str]:
    """Write rows by week, in order within a week; the folder of each week."""
    spark, name = rows.sparkSession, f"data/{uuid.uuid4().hex}"
    _dealt(rows).write.partitionBy("week").parquet(f"{root}/{name}")
    system, at = file_system(spark, f"{root}/{name}")
    folders = [s.getPath().getName() for s in system.listStatus(at) if s.isDirectory()]
    return {unquote(f.removeprefix("week=")): f"{name}/{f}" for f in folders if f.startswith("week=")}


def merge_weeks(rows: DataFrame, root: str, files: DataFrame | None = None) -> Merge:
    """Merge rows (file, year_week, brand and others) by file.

    Rows without a brand are left out. Old rows of files (by default those of
    rows) are replaced, also where a file now yields nothing or has moved to
    another week. The weeks touched are those of the rows and of the files' old
    rows. A week without a row is gone.
    """
    spark = rows.sparkSession
    new = keep(rows.where(F.coalesce("brand", F.lit("")) != ""), "incoming")
    names = keep((rows if files is None else files).select("file").distinct(), "incoming-files")
    arriving = {r[0] for r in new.select(week_of()).distinct().collect()}
    while True:
        version = versions.latest_version(spark, root)
        have = weeks(spark, root, version)
        stored = read_weeks(spark, root, version=version)
        leaving = set() if stored is None else {r[0] for r in stored.join(names, "file", "left_semi").select(week_of()).distinct().collect()}
        touched = arriving | leaving
        old = read_weeks(spark, root, sorted(touched), version)
        merged = new if old is None else old.join(names, "file", "left_anti").unionByName(new, allowMissingColumns=True)
        made = _write(merged, root) if touched else {}
        now = {w: f for w, f in have.items() if w not in touched} | made
        if versions.publish(spark, root, version + 1, {"weeks": now}):
            discard(new, names)
            return Merge(version + 1, sorted(made), sorted(touched & set(have) - set(made)))


def deliver(spark: SparkSession, root: str, path: str, merge: Merge) -> None:
    """Write the weeks of a merge as CSV, a folder a week, and delete those that are gone; other weeks stay as they are."""
    rows = read_weeks(spark, root, merge.written, merge.version) if merge.written else None
    if rows is not None:
        _dealt(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week").options(header=True, escape='"').csv(path)
    for week in merge.gone:
        system, at = file_system(spark, f"{path}/week={week}")
        system.delete(at, True)


def vacuum(spark: SparkSession, root: str, keep_versions: int = 2) -> list[str]:
    """Delete the folders that none of the last versions names; readers of older versions must have ended, and no merge may run."""
    last = versions.latest_version(spark, root)
    live = {f.split("/")[1] for v in range(max(1, last - keep_versions + 1), last + 1) for f in weeks(spark, root, v).values()}
    system, at = file_system(spark, f"{root}/data")
    dead = [s.getPath() for s in system.listStatus(at) if s.getPath().getName() not in live] if system.exists(at) else []
    for folder in dead:
        system.delete(folder, True)
    return [f.getName() for f in dead]
