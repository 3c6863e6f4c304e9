"""Tables written to the shared folder on the way of a long job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Where that is unset, a local session (tests, one machine) gets a folder of
    its own; on a cluster it is an error, as executors do not see each other's
    local folders.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="spark-"))
    return _own_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again.

    It cuts the lineage: a lost executor costs the tasks that were running, not
    what has been written, and later plans start from the table.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its terms."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder. A store that cannot be reached is an error and no answer."""
    system, at = file_system(spark, path)
    return system.exists(at)


def discard(*tables: DataFrame) -> None:
    """Delete tables that keep wrote and whose readers have all been written."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            system, at = file_system(table.sparkSession, folder)
            system.delete(at, True)
