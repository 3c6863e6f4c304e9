"""Failures, retries, stops and writers at once of the intake."""

import pytest
from pyspark.sql import functions as F

from tagwright.plans import queries
from tagwright.sources import readers, versions
from tagwright.streaming import intake as module
from tagwright.streaming.intake import current, fold, intake, isolated, last_batch, merge_batch
from tests.oracle import SF_DIR

ROW = "file string, brand string, year_week string, country string, retailer string, n int"


@pytest.fixture()
def at(tmp_path):
    return lambda name: str(tmp_path / name)


def put(spark, source, *values):
    spark.createDataFrame([(f, "X", "2026-W01", "", "", n) for f, n in values], ROW).coalesce(1).write.mode("append").parquet(source)


def shown(spark, store):
    return {(r.file, r.n) for r in current(spark, store).collect()}


def refusing(files):
    bad = F.when(F.col("file").isin(*files), F.raise_error(F.lit("unreadable"))).otherwise(F.col("n")).cast("int")
    return lambda df: df.withColumn("n", bad)


def test_a_failed_file_is_tried_again_by_the_next_run(spark, at):
    run = lambda *bad: intake(spark, at("in"), ROW, at("store"), at("mark"), refusing(bad or ("",)), 10, at("ledger"))
    put(spark, at("in"), ("a", 1), ("b", 2))
    assert run("b") == 2 and shown(spark, at("store")) == {("a", 1)}
    assert run("b") == 0 and shown(spark, at("store")) == {("a", 1)}
    assert run() == 0 and shown(spark, at("store")) == {("a", 1), ("b", 2)}
    assert run() == 0
    noted = sorted((r.ts, r.file, r.status, r.n_rows, r.year_week) for r in readers.read_ledger(spark, at("ledger")).collect())
    assert [(f, s, n, w) for _, f, s, n, w in noted if f == "b"] == [("b", "failed", 0, None)] * 2 + [("b", "done", 1, "2026-W01")]


def test_rows_that_failed_do_not_replace_later_ones(spark, at):
    run = lambda process: intake(spark, at("in"), ROW, at("store"), at("mark"), process, 1)
    put(spark, at("in"), ("a", -1))
    run(refusing(["a"]))
    put(spark, at("in"), ("a", 5))
    seen = []

    def process(df):  # the old rows fail once more, the new ones do not
        seen.append(sorted(r.n for r in df.collect()))
        return df.withColumn("n", F.when(F.col("n") < 0, F.raise_error(F.lit("no"))).otherwise(F.col("n")).cast("int"))

    run(process)
    assert seen == [[-1], [5]] and shown(spark, at("store")) == {("a", 5)}
    run(lambda df: df)
    assert shown(spark, at("store")) == {("a", 5)}


def test_one_bad_file_of_100_costs_at_most_8_more_runs(spark):
    rows = spark.createDataFrame([(f"{i:03}", i) for i in range(100)], "file string, n int").cache()
    for bad in (["000"], ["042"], ["099"], ["000", "099"]):
        runs = []

        def process(df, bad=bad):
            files = {r.file for r in df.select("file").collect()}
            runs.append(len(files))
            if files & set(bad):
                raise ValueError("unreadable")
            return df

        good, said = isolated(rows, process)
        assert sorted(f for f, s, _ in said if s == "failed") == bad and len(said) == 100
        assert sorted(r.file for part in good for r in part.collect()) == sorted(set(f"{i:03}" for i in range(100)) - set(bad))
        assert len(runs) <= 1 + 8 * len(bad)


def test_a_lost_session_is_no_files_fault(spark, monkeypatch):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "file string, n int")

    def process(df):
        monkeypatch.setattr(module, "keep", lambda *a: (_ for _ in ()).throw(OSError("disk is full")))
        return module.keep(df)

    with pytest.raises(OSError, match="disk is full"):
        isolated(rows, process)


def test_a_stop_is_heeded_between_batches(spark, at):
    put(spark, at("in"), ("a", 1))
    put(spark, at("in"), ("b", 2))

    def process(df):
        spark.range(1).write.mode("overwrite").parquet(at("stop"))
        return df

    assert intake(spark, at("in"), ROW, at("store"), at("mark"), process, 1, stop=at("stop")) == 1
    assert len(shown(spark, at("store"))) == 1
    assert intake(spark, at("in"), ROW, at("store"), at("mark"), process, 1, stop=at("stop")) == 0
    assert intake(spark, at("in"), ROW, at("store"), at("mark"), lambda df: df, 1) == 1
    assert shown(spark, at("store")) == {("a", 1), ("b", 2)}


def test_a_batch_is_committed_once(spark, at, monkeypatch):
    rows = lambda n: spark.createDataFrame([("a", "X", "w", "", "", n)], ROW)
    plain, met = versions.publish, []

    def publish(s, root, version, what):
        if not met:  # another writer commits the same batch meanwhile
            met.append(1)
            assert merge_batch(rows(2), at("store"), 0)
        return plain(s, root, version, what)

    monkeypatch.setattr(versions, "publish", publish)
    assert not merge_batch(rows(1), at("store"), 0)
    assert shown(spark, at("store")) == {("a", 2)} and last_batch(spark, at("store")) == 0
    assert not merge_batch(rows(3), at("store"), 0)


def test_fold_keeps_what_others_bring_meanwhile(spark, at, monkeypatch):
    rows = lambda f, n: spark.createDataFrame([(f, "X", "w", "", "", n)], ROW)
    merge_batch(rows("a", 1), at("store"), 0)
    merge_batch(rows("b", 2), at("store"), 1)
    plain, met = versions.publish, []

    def publish(s, root, version, what):
        if not met:
            met.append(1)
            merge_batch(rows("a", 3), at("store"), 2)
        return plain(s, root, version, what)

    monkeypatch.setattr(versions, "publish", publish)
    fold(spark, at("store"))
    assert shown(spark, at("store")) == {("a", 3), ("b", 2)}


def test_a_delivery_of_many_parquet_files_is_one_batch(spark, at):
    batches = []
    for k in range(2):
        spark.createDataFrame([(f"f{k}", "X", "2026-W01", "", "", n) for n in range(6)], ROW).repartition(6).write.mode("append").parquet(at("in"))
        intake(spark, at("in"), ROW, at("store"), at("checkpoint"), lambda df: df, files_per_batch=None)
        batches.append(last_batch(spark, at("store")))
    assert batches == [0, 1]
    assert shown(spark, at("store")) == {(f"f{k}", n) for k in range(2) for n in range(6)}


def test_rows_of_a_file_arrive_in_several_parquet_files(spark, at, monkeypatch):
    for name in ("lineitem", "part"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").repartition(6).write.parquet(at(f"{name}.parquet"))
    parts = []

    def seen(spark, source, *args, **kwargs):
        rows = spark.read.parquet(source).select("file", F.col("_metadata.file_path").alias("part"))
        parts.append(rows.groupBy("file").agg(F.countDistinct("part").alias("n")).agg(F.min("n")).first()[0])
        return intake(spark, source, *args, **kwargs)

    monkeypatch.setattr(queries, "intake", seen)
    assert queries.incremental_intake(spark, at("")).count() > 0
    assert min(parts) > 1
