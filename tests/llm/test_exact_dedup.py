"""The index of the exact deduplication over several batches."""

import collections
import contextlib
import hashlib

from pyspark.sql import functions as F

from tagwright.llm import exact_dedup
from tagwright.llm.common import new_path


def batch(spark, k):
    """Texts of which some recur in other batches, with smaller and with larger ids."""
    ids = (F.lit(1000) - 10 * k + F.col("id")).alias("doc_id")
    return spark.range(40, numPartitions=3).select(ids, F.concat(F.lit("text  "), ((F.col("id") * 7 + k) % (15 + 4 * k)).cast("string")).alias("text"))


def rows_of(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_batches_give_the_rows_of_one(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "FAN_IN", 2)
    for digest_bits, batches in ((8, 2), (256, 4)):
        root, earlier = new_path(spark, "index"), None
        for k in range(batches):
            docs = batch(spark, k)
            got = exact_dedup.exact_dedup(docs, digest_bits, root, earlier)
            earlier = docs if earlier is None else earlier.unionByName(docs)
            whole = exact_dedup.exact_dedup(earlier, digest_bits)
            wanted = collections.Counter({r: n for r, n in rows_of(whole.where(F.col("doc_id").between(1000 - 10 * k, 1039 - 10 * k))).items()})
            mine = {(r.doc_id, hashlib.sha256(r.text.replace("  ", " ").encode()).hexdigest()) for r in docs.collect()}
            got = rows_of(got)
            assert set(got) == {r for r in wanted if (r[0], r[4]) in mine} and sum(got.values()) == 40
            exact_dedup.compact(spark, root, 2)
    live = exact_dedup.runs(spark, root)
    assert len(live) < 4 and max(r["level"] for r in live) >= 3


def test_runs_are_in_order_and_filters_are_read(spark):
    root = new_path(spark, "index")
    exact_dedup.exact_dedup(batch(spark, 0), 256, root)
    (run,) = exact_dedup.runs(spark, root)
    digests = [bytes(r.digest) for r in exact_dedup.read_run(spark, root, run["run"]).collect()]
    assert digests == sorted(digests) and len(digests) == run["n_rows"] == 15
    assert exact_dedup.lookup(spark, root, digests[3:5]).count() == 2
    words = spark.read.parquet(f"{root}/filters/{run['run']}")
    strange = spark.range(1000).select(F.unhex(F.sha2(F.concat(F.lit("other "), "id"), 256)).alias("digest"))
    assert exact_dedup.passing(strange, words, "digest", run["bits"]).count() < 20
    own = exact_dedup.read_run(spark, root, run["run"])
    assert exact_dedup.passing(own, words, "digest", run["bits"]).count() == 15 and exact_dedup.passing(own, words, "digest", run["bits"], False).isEmpty()


def test_a_call_that_is_made_again_counts_its_batch_once(spark, monkeypatch):
    root = new_path(spark, "index")
    first, second = batch(spark, 0), batch(spark, 1)
    exact_dedup.exact_dedup(first, 256, root, batch="one")
    want = rows_of(exact_dedup.exact_dedup(second, 256, root, first, batch="two"))
    before = rows_of(exact_dedup.read_run(spark, root, exact_dedup.runs(spark, root)[1]["run"]))

    def broken(*a):
        raise RuntimeError("killed")

    again = new_path(spark, "index")
    exact_dedup.exact_dedup(first, 256, again, batch="one")
    with monkeypatch.context() as m:
        m.setattr(exact_dedup, "classified", broken)
        for _ in range(2):
            with contextlib.suppress(RuntimeError):
                exact_dedup.exact_dedup(second, 256, again, first, batch="two")
    assert rows_of(exact_dedup.exact_dedup(second, 256, again, first, batch="two")) == want
    live = exact_dedup.runs(spark, again)
    assert [r["batches"] for r in live] == [["one"], ["two"]] and rows_of(exact_dedup.read_run(spark, again, live[1]["run"])) == before
    exact_dedup.compact(spark, again, 2)
    assert rows_of(exact_dedup.exact_dedup(second, 256, again, first, batch="two")) == want
    (merged,) = exact_dedup.runs(spark, again)
    assert merged["batches"] == ["one", "two"] and exact_dedup.vacuum(spark, again) >= 4
    digests = [bytes(r.digest) for r in exact_dedup.read_run(spark, again, merged["run"]).collect()]
    assert digests == sorted(set(digests)) and exact_dedup.read_run(spark, again, merged["run"]).agg(F.sum("n_rows")).first()[0] == 80


def test_an_index_of_one_call_is_compacted_and_looked_up(spark, monkeypatch):
    """Copies are found in runs that were compacted and by look-ups in filters; without compaction there are five runs, without filters copies are missed."""
    docs = spark.range(200, numPartitions=3).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 100).cast("string")).alias("text"))
    want = {(k, k % 100, 2, k < 100) for k in range(200)}
    shown = lambda: {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    levels, shared = [], exact_dedup.shared

    def seen(spark, root):
        levels.extend(sorted(r["level"] for r in exact_dedup.runs(spark, root)))
        return shared(spark, root)

    monkeypatch.setattr(exact_dedup, "shared", seen)
    assert shown() == want and levels == [1, 2]
    with monkeypatch.context() as m:
        m.setattr(exact_dedup, "compact", lambda *args: None)
        assert shown() == want and levels[2:] == [1] * 5
    with monkeypatch.context() as m:
        m.setattr(exact_dedup, "passing", lambda rows, words, key, bits, how=True: rows.where(F.lit(not how)))
        assert shown() != want
