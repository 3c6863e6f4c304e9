"""Importance resampling against a plain version of its definition."""

import hashlib
import math
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tagwright.llm import resampling
from tests.llm.test_operators import CLASHING, LONG, ODD, SCHEMA, lower

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(lower(text or ""))
    return words, [zlib.crc32(f.encode()) % 10_000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def plain(docs, target, percent=25, least=20, seed=7):
    docs = [(i, *features(t)) for i, t in docs]
    s, t = Counter(b for _, _, bs in docs for b in bs), Counter(b for x in target for b in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (n_s + 10_000.0) / ((s[b] + 1.0) * (n_t + 10_000.0))))
    rows = []
    for i, words, bs in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(b) for b in bs) // len(bs) if bs else 0
        rows.append([i, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)])
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, order[: percent * len(order) // 100]


def test_scores_and_draw_equal_the_plain_definition(spark):
    docs = [(i, " ".join(f"W{(i * j) % 37}x, é{j % 5}" for j in range(i % 60))) for i in range(300)] + [(i, t) for i, t, *_ in ODD] + [(900, "x" * 70 + " " + "yé" * 40)]
    target = ["w1x é1 w2x, é2 w3x", None, "", "w5x é0 w10x"]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = resampling.importance_scores(table, spark.createDataFrame([(t,) for t in target], "text string"), percent=40).collect()
    rows, drawn = plain(docs, target, percent=40)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == Counter(tuple(r[:4]) for r in rows)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(r[0], r[3]) for r in drawn]


def test_odd_rows_empty_tables_and_columns_that_clash(spark):
    odd = spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in (*CLASHING, "rank", "weight", "stream")})
    target = spark.createDataFrame([("alpha beta",)], "text string")
    out = resampling.importance_scores(odd, target)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and out.count() == len(ODD)
    by = {(r.doc_id, r.n_features) for r in out.collect()}
    assert (3, 0) in by and (4, 0) in by and (5, 119_999) in by and len(LONG.split()) == 60_000
    kept = resampling.resample(odd, target, percent=60)
    assert kept.count() == 1 and set(kept.columns) == set(odd.columns) and kept.first().text in (LONG, LONG + " end")
    none = spark.createDataFrame([], SCHEMA)
    assert resampling.importance_scores(none, target).count() == 0 and resampling.resample(none, target).count() == 0
    alone = resampling.importance_scores(odd, none).collect()
    assert len(alone) == len(ODD) and all(r.weight == 0 for r in alone if r.n_features == 0)


def test_ties_go_to_the_smaller_id_and_repeated_rows_take_part(spark):
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(i % 10, text) for i in range(100)], "doc_id long, text string").repartition(7)
    rows = sorted((r for r in resampling.importance_scores(docs, docs, percent=50).collect() if r["rank"]), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, 51))
    assert [(-r.score, r.doc_id) for r in rows] == sorted((-r.score, r.doc_id) for r in rows)
    assert Counter(Counter(r.doc_id for r in rows).values()) == Counter({10: 5})
