"""Importance resampling towards a target distribution, by an external sort-count.

1. Streams: each task hashes the words and word pairs of its texts to buckets and
   writes them once, as packed uint16 with the end of each document.
2. Counts: streams are read back, sorted and run-length encoded; runs are summed
   in the task, so at most one row a bucket and task is shuffled.
3. Gains: a bucket's log ratio of target and corpus, one table of N_BUCKETS numbers.
4. Weights: streams are read again, and np.add.reduceat sums their gains between
   the documents' ends.
5. The draw: Gumbel noise from a hash of the id is added, and the highest scores
   are taken by their global positions (no global sort in one task).

Texts are read and hashed once. All counts are over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.arrays import NOT_ALNUM, crc32, slices, windows, words
from tagwright.llm.common import discard, keep
from tagwright.operators.ordering import ordinals

N_BUCKETS = 10_000
#: A draw takes this percentage of the documents with at least so many words; the noise is seeded.
PERCENT, LEAST_WORDS, SEED = 25, 20, 7
_STREAMS = "doc_id array<long>, row array<long>, n_words array<long>, ends array<long>, stream binary"
_SPACE = np.array([0x20], np.uint8)


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each document, the end of each in the stream, and the stream: buckets of all words and then all pairs, document after document."""
    found = words(column, NOT_ALNUM)
    n_words = np.diff(found.bounds)
    single = crc32(found.data, found.starts, found.ends)
    first, owner = windows(found.bounds, 2)
    spaces = np.zeros(len(first), np.int64)
    pairs = crc32(found.data, found.starts[first + 1], found.ends[first + 1], crc32(_SPACE, spaces, spaces + 1, single[first]))
    ends = np.cumsum(n_words + np.maximum(n_words - 1, 0))
    begins = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    stream = np.empty(int(ends[-1]) if len(ends) else 0, np.uint16)
    stream[np.arange(len(single)) + np.repeat(begins - found.bounds[:-1], n_words)] = single % N_BUCKETS
    stream[first + (begins + n_words - found.bounds[:-1])[owner]] = pairs % N_BUCKETS
    return n_words, ends, stream


def streams(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """Written blocks of packed streams of docs (doc_id, text), a few MB of text each."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n_words, ends, stream = packed(batch.column("text"))
            lists = [batch.column("doc_id"), batch.column("row"), pa.array(n_words), pa.array(ends)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x.cast(pa.int64())) for x in lists]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([stream.tobytes()], pa.binary())], ["doc_id", "row", "n_words", "ends", "stream"])

    row = F.monotonically_increasing_id() if row is None else row
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), F.col("text").cast("string").alias("text"))
    return keep(texts.mapInArrow(blocks, _STREAMS), "streams")


def bucket_counts(blocks: DataFrame) -> DataFrame:
    """bucket, n of all streams."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N_BUCKETS, np.int64)
        for batch in batches:
            for stream in batch.column("stream"):
                ordered = np.sort(np.frombuffer(stream.as_buffer(), np.uint16))
                if len(ordered):
                    begins = np.concatenate(([0], np.flatnonzero(np.diff(ordered)) + 1))
                    total[ordered[begins]] += np.diff(np.append(begins, len(ordered)))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return blocks.select("stream").mapInArrow(runs, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """A gain for each bucket, from bucket, n of both: at most N_BUCKETS rows each."""
    s, t = np.zeros(N_BUCKETS), np.zeros(N_BUCKETS)
    for counts, rows in ((s, corpus), (t, target)):
        for r in rows.collect():
            counts[r.bucket] = r.n
    n_s, n_t = s.sum(), t.sum()
    return np.array([math.floor(1000 * math.log(x)) for x in (t + 1) * (n_s + N_BUCKETS) / ((s + 1) * (n_t + N_BUCKETS))], np.int64)


def weights(blocks: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, row, n_words, n_features, weight of each document of the streams."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                doc_id, row, n_words, ends = (batch.column(c)[k].values for c in range(4))
                ends = ends.to_numpy()
                begins = np.concatenate(([0], ends[:-1]))
                n, sums = ends - begins, np.zeros(len(ends), np.int64)
                some = np.flatnonzero(n)
                if len(some):
                    sums[some] = np.add.reduceat(gain[np.frombuffer(batch.column(4)[k].as_buffer(), np.uint16)], begins[some])
                yield pa.RecordBatch.from_arrays([doc_id, row, n_words, pa.array(n), pa.array(sums // np.maximum(n, 1))], ["doc_id", "row", "n_words", "n_features", "weight"])

    return blocks.mapInArrow(rows, "doc_id long, row long, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths from a hash of the id; a null id is hashed as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def _scores(blocks: DataFrame, target: DataFrame, percent: int, least_words: int, seed: int) -> DataFrame:
    """doc_id, row, n_features, weight, score, rank of each document of written streams."""
    aimed = streams(target.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    gain = gains(bucket_counts(blocks), bucket_counts(aimed))
    scored = weights(blocks, gain).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = keep(scored, "scored")
    discard(blocks, aimed)
    columns, eligible = ["doc_id", "row", "n_features", "weight", "score"], F.col("n_words") >= least_words
    placed = ordinals(scored.where(eligible).select(columns), F.desc("score"), F.asc_nulls_last("doc_id"))
    drawn = percent * scored.where(eligible).count() // 100
    rank = F.when(F.col("ordinal") <= drawn, F.col("ordinal")).cast("long").alias("rank")
    return placed.select(*columns, rank).unionByName(scored.where(~eligible).select(*columns, F.lit(None).cast("long").alias("rank")))


def importance_scores(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs (doc_id, text); rank is null where a row is not drawn.

    target: text. Null texts have no words, on either side: weight 0, never
    drawn. An empty target or an empty table is no error. Rows that repeat an id
    share its noise and take part each, and rows without an id have one noise
    of their own; both come after smaller ids in ties, among themselves in the
    order of the input. Other columns are ignored.
    """
    return _scores(streams(docs), target, percent, least_words, seed).drop("row")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows of docs with all their columns, and rank (a column of that name is replaced)."""
    rows = keep(docs.drop("rank").withColumn("__row", F.monotonically_increasing_id()), "numbered")
    scores = _scores(streams(rows, F.col("__row")), target, percent, least_words, seed)
    drawn = scores.where("rank is not null").select(F.col("row").alias("__row"), "rank")
    return rows.join(drawn, "__row").drop("__row")


ORACLE = r"""
WITH tab AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
texts AS (SELECT 0 AS side, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
lists AS (SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
features AS (SELECT side, r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM lists),
counted AS (SELECT side, r, f, count(*) AS n FROM features GROUP BY ALL),
hex AS (SELECT f, hex(f) AS x FROM (SELECT DISTINCT f FROM counted)),
hashed AS (SELECT f, xor(list_reduce(list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i::INT, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket FROM hex, tab),
per AS (SELECT side, r, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
both_sides AS (SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM per GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS ss, coalesce(sum(t), 0)::DOUBLE AS tt FROM both_sides),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (ss + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (tt + 10000))))::BIGINT AS g FROM both_sides, totals),
weighed AS (SELECT r, sum(n * g) AS total, sum(n) AS n FROM per JOIN gain USING (bucket) WHERE side = 0 GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(total::DOUBLE / n), 0)::BIGINT AS weight,
  ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM lists LEFT JOIN weighed USING (r) WHERE side = 0),
final AS (SELECT doc_id, n_words, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, 25 * count(*) FILTER (n_words >= 20) OVER () // 100 AS k FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= k THEN place END AS rank FROM placed
"""
