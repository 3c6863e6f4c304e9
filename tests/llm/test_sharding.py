"""The shard store: append, compaction against a plain planner, versions, crashes and two writers."""

import collections
import threading

import pytest
from pyspark.sql import functions as F

from tagwright.llm import sharding, versions
from tagwright.llm.common import new_path
from tests.llm.test_operators import ODD, SCHEMA

TIERS = (20_000, 80_000)


def documents(spark, first, last, hashed=False):
    ids = F.xxhash64("id") if hashed else F.col("id")
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), (F.col("id") % 40).cast("int")), lambda i: F.md5((F.col("id") * 1000 + i).cast("string"))))
    return spark.range(first, last, numPartitions=4).select(ids.alias("doc_id"), text.alias("text"))


def rows_of(df):
    return collections.Counter((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def sizes(spark, root, version=None):
    return {r.file: r.n_bytes for r in sharding.manifest(spark, root, version).collect()}


def plain_plan(files, tiers, fan_in):
    """Groups of files that become one, with all files in one planning group."""
    shards = {f: [f] for f in files}
    for most in tiers:
        size = {s: sum(files[f] for f in members) for s, members in shards.items()}
        pieces, total = collections.defaultdict(list), 0
        for s in sorted((s for s in shards if size[s] < most), key=lambda s: (size[s], s)):
            pieces[total // most].append(s)
            total += size[s]
        for piece in pieces.values():
            if len(piece) >= fan_in:
                shards[min(piece)] = sum((shards.pop(s) for s in piece), [])
    return {frozenset(members) for members in shards.values() if len(members) > 1}


@pytest.mark.parametrize("fan_in", [2, 4])
def test_plan_equals_a_plain_one(spark, fan_in):
    root = new_path(spark, "shards")
    sharding.append(documents(spark, 0, 400), root, 7)
    sharding.append(documents(spark, 400, 430), root, 3)
    files = sizes(spark, root)
    merges = sharding.plan(sharding.manifest(spark, root), TIERS, fan_in).groupBy("shard").agg(F.collect_list("file").alias("files")).collect()
    want = plain_plan(files, TIERS, fan_in)
    assert {frozenset(r.files) for r in merges} == want and len(want) > 3


@pytest.mark.parametrize("hashed", [False, True])
def test_files_fill_whatever_the_ids(spark, hashed):
    root, docs = new_path(spark, "shards"), documents(spark, 0, 1000, hashed)
    sharding.append(docs, root, 5)
    small = sizes(spark, root)
    out = sharding.read_shards(spark, root, sharding.compact(spark, root, TIERS, task_bytes=200_000))
    assert rows_of(out) == rows_of(docs)
    large = sharding.manifest(spark, root).collect()
    assert len(small) >= 200 and len(large) < len(small) / 5
    assert sum(r.n_docs for r in large) == 1000 and max(r.n_bytes for r in large) < 2 * TIERS[-1]
    assert out.select("shard_id").distinct().count() == len(large)


def test_three_versions_by_append(spark):
    root = new_path(spark, "shards")
    parts = [documents(spark, a, a + 200) for a in (0, 200, 400)]
    for part in parts:
        sharding.append(part, root, 10)
        sharding.compact(spark, root, TIERS)
    want = sum((rows_of(p) for p in parts), collections.Counter())
    assert rows_of(sharding.read_shards(spark, root)) == want
    assert rows_of(sharding.read_shards(spark, root, 1)) == rows_of(parts[0])
    before = sizes(spark, root)
    added = sharding.append(documents(spark, 600, 650), root, 4)
    version = sharding.compact(spark, root, TIERS)
    after = sizes(spark, root, version)
    assert version == added + 1 and len(after) < len(sizes(spark, root, added))
    assert len(set(before) & set(after)) > len(before) / 2  # most of what was merged before stays as it is
    assert sharding.compact(spark, root, TIERS) == version  # nothing more to merge


def test_a_crash_before_the_commit_changes_nothing(spark, monkeypatch):
    root, docs = new_path(spark, "shards"), documents(spark, 0, 100)
    sharding.append(docs, root, 10)

    def dies(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(versions, "publish", dies)
    for work in (lambda: sharding.append(docs, root, 10), lambda: sharding.compact(spark, root, TIERS)):
        with pytest.raises(KeyboardInterrupt):
            work()
    monkeypatch.undo()
    assert sharding.latest_version(spark, root) == 1 and rows_of(sharding.read_shards(spark, root)) == rows_of(docs)
    assert sharding.vacuum(spark, root) == 2
    assert sharding.compact(spark, root, TIERS) == 2 and rows_of(sharding.read_shards(spark, root)) == rows_of(docs)
    assert sharding.vacuum(spark, root) == 1 and rows_of(sharding.read_shards(spark, root)) == rows_of(docs)


def test_two_writers(spark):
    root = new_path(spark, "shards")
    parts = [documents(spark, a, a + 50) for a in range(0, 200, 50)]
    threads = [threading.Thread(target=sharding.append, args=(p, root, 10)) for p in parts]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sharding.latest_version(spark, root) == 4
    assert rows_of(sharding.read_shards(spark, root)) == sum((rows_of(p) for p in parts), collections.Counter())


def test_a_merge_of_files_that_are_gone_is_refused(spark):
    root = new_path(spark, "shards")
    sharding.append(documents(spark, 0, 100), root, 10)
    merges = sharding.manifest(spark, root).select("file")
    sharding.compact(spark, root, TIERS)
    schema = documents(spark, 0, 1).schema
    with pytest.raises(sharding.Conflict):
        sharding.commit(spark, root, schema, sharding.manifest(spark, root, 1), merges)
    with pytest.raises(ValueError, match="other columns"):
        sharding.append(documents(spark, 0, 1).withColumn("more", F.lit(1)), root)


def test_odd_rows_and_clashing_names(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in ("shard_id", "shard_tier", "__file", "file", "task", "_metadata", "number", "size")})
    out = sharding.sharded(odd.repartition(5), new_path(spark, "shards"), 1, TIERS, 2)
    kept = [c for c in odd.columns if not c.startswith("shard_")]
    assert collections.Counter(tuple(r) for r in out.select(kept).collect()) == collections.Counter(tuple(r) for r in odd.select(kept).collect())
    assert dict(out.dtypes)["shard_tier"] == "int" and out.where("shard_id is null or shard_id = 'x'").isEmpty()
    empty = sharding.sharded(spark.createDataFrame([], SCHEMA), new_path(spark, "shards"))
    assert empty.count() == 0 and {"shard_id", "shard_tier"} <= set(empty.columns)


def test_only_live_files_are_opened(spark, monkeypatch):
    """After several appends the read opens the files of the version and no others; beyond a bound it goes by folders."""
    root = new_path(spark, "shards")
    for k in range(5):
        sharding.append(spark.range(40).select((F.col("id") + 40 * k).alias("doc_id"), F.lit("t" * 50).alias("text")).repartition(2), root, arrival_rows=10)
        sharding.compact(spark, root, tiers=(1 << 12, 1 << 14), fan_in=2)
    live = {r.file for r in sharding.manifest(spark, root).collect()}
    rows = sharding.read_shards(spark, root)
    assert {f.rsplit("/", 1)[1] for f in rows.inputFiles() if "shard_tier" in f} == {f.rsplit("/", 1)[1] for f in live}
    want = sorted((r.doc_id, r.shard_id) for r in rows.collect())
    monkeypatch.setattr(sharding, "LISTED_FILES", 0)
    assert sorted((r.doc_id, r.shard_id) for r in sharding.read_shards(spark, root).collect()) == want and len(want) == 200
