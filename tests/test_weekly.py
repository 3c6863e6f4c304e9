"""The weekly store: touched weeks only, crashes, writers at once."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagwright.sources import versions, weekly

ROW = "file string, brand string, year_week string, country string, retailer string, n int"


def rows(spark, *values):
    return spark.createDataFrame([(f, b, w, "UAE", "Lulu", n) for f, b, w, n in values], ROW)


def shown(spark, root, **more):
    return {(r.file, r.year_week, r.n) for r in weekly.read_weeks(spark, root, **more).collect()}


def bytes_of(root):
    return {str(p): hashlib.md5(p.read_bytes()).hexdigest() for p in Path(root).rglob("*.parquet")}


def test_only_touched_weeks_are_written(spark, tmp_path):
    root, out = str(tmp_path / "store"), str(tmp_path / "out")
    first = weekly.merge_weeks(rows(spark, ("a", "X", "2026-W01", 1), ("b", "X", "2026-W02", 2), ("c", "X", None, 3), ("d", "", "2026-W03", 4)), root)
    assert first == (1, ["2026-W01", "2026-W02", "unknown-week"], [])
    weekly.deliver(spark, root, out, first)
    before, folders = bytes_of(root), weekly.weeks(spark, root)
    moved = weekly.merge_weeks(rows(spark, ("a", "X", "2026-W04", 5)), root)
    assert moved == (2, ["2026-W04"], ["2026-W01"])
    assert shown(spark, root) == {("a", "2026-W04", 5), ("b", "2026-W02", 2), ("c", None, 3)}
    assert shown(spark, root, version=1) == {("a", "2026-W01", 1), ("b", "2026-W02", 2), ("c", None, 3)}
    assert before.items() <= bytes_of(root).items()
    assert all(weekly.weeks(spark, root)[w] == folders[w] for w in ("2026-W02", "unknown-week"))
    old = {p.name: p.stat().st_mtime_ns for p in Path(out, "week=2026-W02").iterdir()}
    weekly.deliver(spark, root, out, moved)
    assert {p.name for p in Path(out).iterdir() if p.is_dir()} == {"week=2026-W02", "week=2026-W04", "week=unknown-week"}
    assert old == {p.name: p.stat().st_mtime_ns for p in Path(out, "week=2026-W02").iterdir()}
    assert len(weekly.vacuum(spark, root, keep_versions=1)) == 0 and len(shown(spark, root)) == 3


def test_a_file_that_yields_nothing_loses_its_rows_and_merging_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    weekly.merge_weeks(rows(spark, ("a", "X", "2026-W01", 1), ("b", "X", "2026-W01", 2)), root)
    weekly.merge_weeks(rows(spark, ("b", "X", "2026-W01", 2)), root, spark.createDataFrame([("a",), ("b",)], "file string"))
    assert shown(spark, root) == {("b", "2026-W01", 2)}
    weekly.merge_weeks(rows(spark, ("b", "X", "2026-W01", 2)), root)
    assert shown(spark, root) == {("b", "2026-W01", 2)}
    assert weekly.merge_weeks(rows(spark, ("b", None, "2026-W01", 2)), root) == (4, [], ["2026-W01"])
    assert weekly.read_weeks(spark, root) is None
    assert len(weekly.vacuum(spark, root, keep_versions=1)) == 4


def test_a_crash_in_mid_write_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    weekly.merge_weeks(rows(spark, ("a", "X", "2026-W01", 1), ("b", "X", "2026-W02", 2)), root)
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            weekly.merge_weeks(rows(spark, ("a", "X", "2026-W02", 9)), root)
    assert shown(spark, root) == {("a", "2026-W01", 1), ("b", "2026-W02", 2)}
    assert len(weekly.vacuum(spark, root)) == 1
    weekly.merge_weeks(rows(spark, ("a", "X", "2026-W02", 9)), root)
    assert shown(spark, root) == {("a", "2026-W02", 9), ("b", "2026-W02", 2)}


def test_of_two_writers_both_merges_count(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    plain, met = versions.publish, []

    def publish(s, at, version, what):
        if not met:
            met.append(1)
            weekly.merge_weeks(rows(spark, ("b", "X", "2026-W01", 2)), root)
        return plain(s, at, version, what)

    monkeypatch.setattr(versions, "publish", publish)
    assert weekly.merge_weeks(rows(spark, ("a", "X", "2026-W01", 1)), root).version == 2
    assert shown(spark, root) == {("a", "2026-W01", 1), ("b", "2026-W01", 2)}


def test_a_large_week_is_written_by_several_tasks_in_order(spark, tmp_path):
    large = spark.range(4000).select(F.lit("f").alias("file"), F.lit("b").alias("brand"), F.lit("2026-W01").alias("year_week"), "id", F.lpad((F.col("id") % 7).cast("string"), 2, "0").alias("country"))
    weekly.merge_weeks(large, str(tmp_path / "store"))
    stored = weekly.read_weeks(spark, str(tmp_path / "store")).withColumn("part", F.col("_metadata.file_name"))
    parts = sorted((r for r in stored.groupBy("part").agg(F.min("country").alias("lo"), F.max("country").alias("hi"), F.count("*").alias("n")).collect()), key=lambda r: r.part)
    assert len(parts) == 4 and sum(r.n for r in parts) == 4000 and max(r.n for r in parts) < 2000
    assert all(a.hi <= b.lo for a, b in zip(parts, parts[1:]))
