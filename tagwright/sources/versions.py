"""Versions of what is stored under a root folder: small files whose names are taken once."""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from tagwright.sources.staging import file_system


def latest_version(spark: SparkSession, root: str) -> int:
    """The last committed version, 0 if there is none."""
    system, at = file_system(spark, f"{root}/versions")
    if not system.exists(at):
        return 0
    names = [status.getPath().getName() for status in system.listStatus(at)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def content(spark: SparkSession, root: str, version: int) -> dict:
    return json.loads(spark.read.text(f"{root}/versions/{version:010d}", wholetext=True).first()[0])


def publish(spark: SparkSession, root: str, version: int, what: dict) -> bool:
    """Make a version visible by a rename; False if its number is taken."""
    jvm = spark.sparkContext._jvm
    system, folder = file_system(spark, f"{root}/versions")
    system.mkdirs(folder)
    _, draft = file_system(spark, f"{root}/versions/draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(json.dumps(what).encode())
    out.close()
    _, final = file_system(spark, f"{root}/versions/{version:010d}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(system.makeQualified(draft), system.makeQualified(final), plain)  # fails where there is a file of that name
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True
