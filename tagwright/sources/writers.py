"""Writers: output files, weekly partitions, versioned stores, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.sources.readers import missing_headers
from tagwright.sources.staging import exists, file_system, keep


def write_output(rows: DataFrame, path: str) -> None:
    """The 21 columns as CSV, each file with a byte order mark, as spreadsheets want it."""
    named = [F.col(f"`{h}`").alias(h if i else "\ufeff" + h) for i, h in enumerate(R.HEADERS)]
    rows.select(*named).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_token_audit(tokens: DataFrame, path: str) -> None:
    """All tokens of a run as CSV, a folder a page."""
    tokens.repartition("file", "page").sortWithinPartitions("file", "page", "tok_id").write.mode("overwrite").partitionBy("file", "page").option("header", True).csv(path)


def write_routes(rows: DataFrame, path: str) -> None:
    """rows (route) as one folder a route; each is replaced, empty or not."""
    for name in ("matched", "review", "out_of_scope"):
        rows.where(F.col("route") == name).drop("route").write.mode("overwrite").parquet(f"{path}/{name}")


def write_weeks(rows: DataFrame, path: str) -> None:
    """rows in a folder a week, replacing the whole store so that weeks that are gone go."""
    week = F.when(F.coalesce("year_week", F.lit("")) == "", "unknown-week").otherwise(F.col("year_week"))
    rows.withColumn("week", week).repartition("week").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("week").parquet(path)


def replace_store(rows: DataFrame, path: str, archive: str) -> None:
    """Replace a store by uploaded rows of the 21 columns; the old one is moved to the archive. Rows that lack columns are refused."""
    missing = missing_headers(rows)
    if missing:
        raise ValueError(f"not a store: no columns {missing}")
    spark = rows.sparkSession
    rows = keep(rows.withColumn("year_week", F.col("`Year-Week`")), "upload")
    if exists(spark, path):
        system, at = file_system(spark, path)
        _, to = file_system(spark, archive)
        system.mkdirs(to.getParent())
        if not system.rename(at, to):
            raise RuntimeError(f"{path} could not be moved to {archive}")
    write_weeks(rows, path)


def append_log(records: DataFrame, path: str) -> None:
    """Records as JSON lines, added to a log."""
    records.write.mode("append").json(path)


def write_catalog(catalog: DataFrame, path: str) -> None:
    catalog.write.mode("overwrite").parquet(path)
