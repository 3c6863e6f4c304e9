"""Incremental intake: files that arrive are processed once and merged by file.

The store is a base and a delta a batch. A delta holds the rows of its batch and
the list of its files; a file's rows are those of its last delta. So a batch
writes what it brings and no more; fold makes a new base of all. A version names
the base and the deltas in order, and is taken once: of two writers of one batch
only one commits.

A batch that fails is searched for the files at fault, and these are set aside
with their rows; each run tries them again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright.operators.store import todo
from tagwright.sources import versions
from tagwright.sources.readers import LEDGER, list_files, read_ledger
from tagwright.sources.staging import discard, exists, file_system, keep
from tagwright.sources.writers import append_log

Status = tuple[str, str, str | None]


def _state(spark: SparkSession, store: str, version: int | None = None) -> dict:
    """base, deltas (in order), batch (last of the stream), failed (deltas of rows set aside) of the last version."""
    version = versions.latest_version(spark, store) if version is None else version
    return versions.content(spark, store, version) if version else {"base": None, "deltas": [], "batch": None, "failed": []}


def last_batch(spark: SparkSession, store: str) -> int | None:
    return _state(spark, store)["batch"]


def current(spark: SparkSession, store: str) -> DataFrame | None:
    """The rows of the store as of its last committed batch, None if there is none."""
    state = _state(spark, store)
    rows = None if state["base"] is None else spark.read.parquet(f"{store}/base/{state['base']}")
    if not state["deltas"]:
        return rows
    order = F.broadcast(spark.createDataFrame(list(zip(state["deltas"], range(len(state["deltas"])), strict=True)), "delta string, at int"))
    read = lambda kind: spark.read.option("basePath", f"{store}/{kind}").option("mergeSchema", "true").parquet(*[f"{store}/{kind}/delta={d}" for d in state["deltas"]])
    files = read("files").join(order, "delta").groupBy("file").agg(F.max("at").alias("at"))
    deltas = read("data").join(order, "delta").join(files, ["file", "at"], "left_semi").drop("delta", "at")
    return deltas if rows is None else rows.join(files, "file", "left_anti").unionByName(deltas, allowMissingColumns=True)


def _commit(spark: SparkSession, store: str, change: Callable[[dict], dict | None]) -> bool:
    """Publish what change makes of the last state; it is asked again if another writer was first. None: nothing to do."""
    while True:
        version = versions.latest_version(spark, store)
        state = change(_state(spark, store, version))
        if state is None:
            return False
        if versions.publish(spark, store, version + 1, state):
            return True


def merge_batch(
    rows: DataFrame, store: str, batch: int | None, files: DataFrame | None = None, failed: DataFrame | None = None, retried: list[str] | None = None
) -> bool:
    """Write the rows of a batch that have a brand as its delta, then commit it; False if that batch was committed before.

    files: all files of the batch, so that one which yields nothing loses its
    old rows; by default those of rows. failed: rows of the batch's files that
    could not be processed, kept for later runs; retried: sets of such rows that
    this commit settles. batch None is no batch of the stream.
    """
    spark, delta = rows.sparkSession, uuid.uuid4().hex
    done = last_batch(spark, store)
    if batch is not None and done is not None and done >= batch:
        return False
    rows.where("coalesce(brand, '') <> ''").write.parquet(f"{store}/data/delta={delta}")
    (rows if files is None else files).select("file").distinct().write.parquet(f"{store}/files/delta={delta}")
    if failed is not None:
        failed.write.parquet(f"{store}/failed/{delta}")

    def change(state: dict) -> dict | None:
        if batch is not None and state["batch"] is not None and state["batch"] >= batch:
            return None
        left = [x for x in state["failed"] if x not in (retried or [])] + ([] if failed is None else [delta])
        return state | {"deltas": [*state["deltas"], delta], "failed": left, "batch": state["batch"] if batch is None else batch}

    return _commit(spark, store, change)


def fold(spark: SparkSession, store: str) -> None:
    """Write the store as one base, which later reads start from. Deltas of other writers that come meanwhile stay."""
    state = _state(spark, store)
    if not state["deltas"]:
        return
    base = uuid.uuid4().hex
    current(spark, store).write.parquet(f"{store}/base/{base}")

    def change(now: dict) -> dict | None:
        if now["base"] != state["base"]:
            return None  # another fold was first
        return now | {"base": base, "deltas": now["deltas"][len(state["deltas"]) :]}

    _commit(spark, store, change)


def planned(spark: SparkSession, source: str, ledger: str, week: str | None = None, force: bool = False, pattern: str = "*.pdf") -> DataFrame:
    """path, file of what a run would process: a dry run."""
    done = read_ledger(spark, ledger) if exists(spark, ledger) else spark.createDataFrame([], LEDGER)
    return todo(list_files(spark, source, pattern), done, force, week).select("path", "file")


def _healthy(spark: SparkSession) -> bool:
    """Whether the session can still compute and write; if not, an error says nothing of a file."""
    try:
        table = keep(spark.range(1), "probe")
        sound = table.count() == 1
        discard(table)
        return sound
    except Exception:
        return False


def isolated(rows: DataFrame, process: Callable[[DataFrame], DataFrame]) -> tuple[list[DataFrame], list[Status]]:
    """Processed rows (written), and file, status, error of all files.

    If a batch fails, a file at fault is searched by halves: a half that
    succeeds is kept, and what was not looked at on the way is one run at the
    end. So one bad file of 100 costs 8 more runs. An error with which the
    session itself is gone is no file's fault and is raised.
    """
    spark = rows.sparkSession

    def attempt(files: list[str]) -> DataFrame | Exception:
        try:
            return keep(process(rows.where(F.col("file").isin(files))), "intake")
        except Exception as error:
            if not _healthy(spark):
                raise
            return error

    good: list[DataFrame] = []
    said: list[Status] = []
    left = sorted(r[0] for r in rows.select("file").distinct().collect())
    while left:
        tried = attempt(left)
        if not isinstance(tried, Exception):
            good.append(tried)
            said += [(f, "done", None) for f in left]
            break
        suspects, unseen = left, []
        while len(suspects) > 1:
            half, rest = suspects[: len(suspects) // 2], suspects[len(suspects) // 2 :]
            outcome = attempt(half)
            if isinstance(outcome, Exception):
                suspects, unseen, tried = half, rest + unseen, outcome
            else:
                good.append(outcome)
                said += [(f, "done", None) for f in half]
                suspects = rest
        said.append((suspects[0], "failed", f"{type(tried).__name__}: {(str(tried).splitlines() or [''])[0]}"))
        left = unseen
    return good, said


def _merged(rows: DataFrame, process: Callable[[DataFrame], DataFrame], store: str, batch: int | None, ledger: str | None, retried: list[str] | None = None) -> None:
    """Process and commit rows (written), and note each file in the ledger."""
    spark = rows.sparkSession
    parts, said = isolated(rows, process)
    good = rows.limit(0)
    for k, part in enumerate(parts):
        good = part if not k else good.unionByName(part, allowMissingColumns=True)
    status = spark.createDataFrame(said, "file string, status string, error string")
    bad = [f for f, s, _ in said if s == "failed"]
    failed = rows.where(F.col("file").isin(bad)) if bad else None
    if merge_batch(good, store, batch, status.where("status = 'done'"), failed, retried) and ledger:
        week = F.max("year_week") if "year_week" in good.columns else F.lit(None).cast("string")
        per = good.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), week.alias("year_week"))
        append_log(status.join(per, "file", "left").withColumns({"n_rows": F.coalesce("n_rows", F.lit(0)), "ts": F.current_timestamp()}), ledger)
    discard(*parts)


def retry_failed(spark: SparkSession, store: str, process: Callable[[DataFrame], DataFrame], ledger: str | None = None) -> None:
    """Try the files again that failed in earlier runs, by the rows that they last came with, unless a later batch has processed them since."""
    state = _state(spark, store)
    if not state["failed"]:
        return
    parts = [spark.read.parquet(f"{store}/failed/{x}").withColumn("__at", F.lit(k)) for k, x in enumerate(state["failed"])]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    rows = rows.join(rows.groupBy("file").agg(F.max("__at").alias("__at")), ["file", "__at"])
    order = {d: k for k, d in enumerate(state["deltas"])}
    for k, x in enumerate(state["failed"]):  # a delta has the name of the rows that failed with it
        since = state["deltas"][order[x] + 1 :] if x in order else state["deltas"]
        if since:
            newer = spark.read.parquet(*[f"{store}/files/delta={d}" for d in since]).select("file").distinct()
            rows = rows.where(F.col("__at") != k).unionByName(rows.where(F.col("__at") == k).join(newer, "file", "left_anti").select(rows.columns))
    rows = keep(rows.drop("__at"), "again")
    _merged(rows, process, store, None, ledger, state["failed"])
    discard(rows)
    for x in state["failed"]:
        system, at = file_system(spark, f"{store}/failed/{x}")
        system.delete(at, True)


def intake(
    spark: SparkSession,
    source: str,
    schema: str,
    store: str,
    checkpoint: str,
    process: Callable[[DataFrame], DataFrame],
    files_per_batch: int | None = 100,
    ledger: str | None = None,
    stop: str | None = None,
) -> int:
    """Process what is new in source and merge it, after what failed in earlier runs; the number of new input rows.

    The checkpoint remembers the files that are done, so a run that was killed
    goes on where it stopped. A file that cannot be processed keeps its old rows
    and is noted in the ledger (a folder of JSON lines) with its error; the
    others go on, and the next run tries it again. stop: a path; once there is
    something, no further batch begins, and the next run goes on from there.
    All rows of a file must come in one batch; files_per_batch None makes what
    is there one batch, however many parquet files it has.
    """
    counted, stopped = [0], [False]
    if stop and exists(spark, stop):
        return 0
    retry_failed(spark, store, process, ledger)
    reader = spark.readStream.schema(schema)
    stream = (reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)).parquet(source)

    def merge(rows: DataFrame, batch: int) -> None:
        if stop and exists(spark, stop):
            stopped[0] = True
            raise RuntimeError("stop requested")
        rows = keep(rows, "arrivals")
        counted[0] += rows.count()
        _merged(rows, process, store, batch, ledger)
        discard(rows)

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    except Exception:
        if not stopped[0]:
            raise
    return counted[0]
