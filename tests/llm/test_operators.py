"""Operators against brute force on small fixtures, and their edge cases."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tagwright.llm import decontaminate, exact_dedup, language_id, license_scan, line_dedup, lm_scoring, mixing, secret_scan, sharding, simhash
from tagwright.llm.common import new_path, remainder
from tagwright.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
#: Nulls in every column, empty and very long texts, ties and repeated rows, columns with clashing names.
ODD = [
    (1, "alpha beta gamma delta\nalpha two\nthree\nfour", "en", "a", 1),
    (1, "alpha beta gamma delta\nalpha two\nthree\nfour", "en", "a", 1),
    (2, "alpha  beta gamma delta alpha two three four", "en", None, 2),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (None, "nobody's text", "en", "b", 0),
    (None, None, None, None, None),
    (5, LONG, "en", "c", 9),
    (6, LONG + " end", "en", "c", 9),
    (7, "\n\n\n\n", "de", "c", 9),
    (8, "Ünïcode … 漢字   text", "de", "c", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("norm", "sha", "digest", "fp", "copy", "rate", "shuffle_key", "below", "parts", "n", "d", "arrival", "shard_id", "shard_tier", "lines", "kept", "cuts", "n_lines", "n_removed", "score", "lang_pred", "ambiguous", "held_out", "row", "tokens", "seeds", "at")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING}).repartition(3).cache()


@pytest.fixture(scope="module")
def prose(spark):
    """Documents of a few hundred words in two made-up languages, with copies and near copies."""
    rng = np.random.default_rng(5)
    vocabularies = {"aa": [a + b for a in ("ka", "to", "mi", "ra") for b in ("na", "lu", "po", "si", "")], "bb": [a + b for a in ("sch", "ung", "ver", "ein") for b in ("heit", "lich", "en", "er", "")]}
    rows = []
    for i in range(160):
        lang = "aa" if rng.random() < 0.5 else "bb"
        words = rng.choice(vocabularies[lang], int(rng.integers(3, 200))).tolist()
        if i % 8 == 7:
            source = rows[int(rng.integers(len(rows)))]
            words, lang = source[1].split(" "), source[2]
            if i % 16 == 7 and len(words) > 2:
                words[int(rng.integers(len(words)))] = "changed"
        rows.append((i, " ".join(words), lang, f"s{i % 3}", 0))
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_every_operator_takes_empty_tables(spark, none):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert license_scan.license_scan(none).count() == 0
    assert decontaminate.contaminated(none, benchmark).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    assert sharding.sharded(none, new_path(spark, "shards")).count() == 0
    assert secret_scan.candidates(none).count() == 0
    assert language_id.predict(none, language_id.train(none, F.lit(True))).count() == 0
    assert line_dedup.line_dedup(none).count() == 0
    assert mixing.mixed(none).count() == 0
    assert lm_scoring.lm_scores(none, F.lit(False)).count() == 0
    assert simhash.simhash_groups(none).count() == 0


@pytest.mark.parametrize("digest_bits", [256, 8])
def test_exact_dedup(odd, digest_bits):
    got = collections.Counter(tuple(r) for r in exact_dedup.exact_dedup(odd, digest_bits).collect())
    import hashlib

    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in ODD]
    want = collections.Counter()
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        keep = min((j for j in ids if j is not None), default=None)
        want[i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    assert got == want


def test_line_dedup(spark, odd):
    rows = [(1, "a\nb\nc\nd\nx"), (2, "q\na\nb\nc\nd\nz"), (3, "b\nc\nd"), (4, "a\nb"), (5, "r\nr\nr\nr\nr")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ("a\nb\nc\nd\nx", 5, 0), 2: ("q\nz", 6, 4), 3: ("", 3, 3), 4: ("a\nb", 2, 0), 5: ("r", 5, 4)}
    out = line_dedup.line_dedup(odd)
    assert out.count() == len(ODD) and out.where("doc_id = 1 and n_removed > 0").count() == 0
    assert out.where("text is null").count() == 2 and out.where("norm = 'x'").count() == len(ODD)


def test_line_dedup_cuts_rows_and_not_ids(spark):
    """Rows that share an id, or have none, are cut by their own lines only."""
    rows = [(0, "a\nb\nc"), (1, "x\na\nb\nc"), (1, "k\nl\nm\nn"), (None, "a\nb\nc\nq"), (None, "r\ns\nt"), (None, "z\nr\ns\nt"), (None, None)]
    got = collections.Counter((r.doc_id, r.text) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    first, second = sorted(["r\ns\nt", "z\nr\ns\nt"], key=lambda t: __import__("hashlib").md5(t.encode()).digest())
    unnamed = [first, second.replace("r\ns\nt", "").strip("\n")]
    assert got == collections.Counter([(0, "a\nb\nc"), (1, "x"), (1, "k\nl\nm\nn"), (None, "q"), *((None, t) for t in unnamed), (None, None)])


def test_mixing_draws_rows_without_an_id_by_their_text(spark):
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.lpad(F.col("id").cast("string"), 4, "0")).alias("text"), F.lit("s").alias("source"))
    out = mixing.mixed(docs, epochs=0.5)
    assert 850 < out.count() < 1150 and out.select("shuffle_key").distinct().count() > 0.99 * out.count()


def test_mixing_makes_many_copies_in_runs(spark):
    docs = spark.createDataFrame([(1, "t", "tiny"), *((i, "t" * 100, "large") for i in range(2, 300))], "doc_id long, text string, source string")
    out = mixing.mixed(docs)
    tiny = out.where("source = 'tiny'")
    rate = tiny.select("rate").first()[0]
    assert rate > 3 * mixing.RUN and abs(tiny.count() - rate) < 6 * rate**0.5
    assert tiny.agg(F.countDistinct("copy"), F.max("copy") + 1).first() == (tiny.count(), tiny.count())


def test_mixing_counts_are_poisson_and_whole(spark, odd):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t" * 10).alias("text"), F.when(F.col("id") % 4 == 0, "small").otherwise("large").alias("source"))
    out = mixing.mixed(docs, {"small": 3.0, "large": 1.0}, epochs=2.0)
    n = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(n["small"] - 30_000) < 600 and abs(n["large"] - 10_000) < 400
    per = [r["count"] for r in out.where("source = 'small'").groupBy("doc_id").count().collect()] + [0] * (5000 - out.where("source = 'small'").select("doc_id").distinct().count())
    assert abs(np.mean(per) - 6) < 0.15 and abs(np.var(per) - 6) < 0.5
    assert out.groupBy("doc_id", "copy").count().where("count > 1").isEmpty()
    assert mixing.mixed(docs, epochs=200.0).where("doc_id < 4").count() > 400
    assert set(mixing.mixed(odd, epochs=3.0).columns) == set(odd.columns)


def plain_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("cell", [simhash.CELL, 3])
def test_simhash_against_all_pairs(spark, prose, odd, cell):
    for docs in (prose, odd):
        rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
        group = list(range(len(rows)))
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows[:i]):
                if (a ^ b).bit_count() <= 4:
                    old, new = group[i], group[j]
                    group = [new if g == old else g for g in group]
        first = {g: min((r[0] for r, h in zip(rows, group, strict=True) if h == g and r[0] is not None), default=None) for g in group}
        want = collections.Counter((r[0], f"{r[1]:016x}", first[g]) for r, g in zip(rows, group, strict=True))
        assert collections.Counter(tuple(r) for r in simhash.simhash_groups(docs, cell).collect()) == want


@pytest.mark.parametrize("layout", [simhash.SHORT, simhash.LONG, simhash.Layout(2, 4), simhash.Layout(4, 4)])
def test_anchors_cover_every_pair_of_four_bits(layout):
    rng = np.random.default_rng(1)
    for _ in range(300 if layout == simhash.SHORT else 20):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(63, int(rng.integers(0, 5)), replace=False).tolist():
            b ^= 1 << bit
        index, anchors, home = simhash.anchor_rows(np.array([a, b], np.int64), 4, layout)
        homes = set(anchors[(index == 0) & home].tolist())
        assert homes & set(anchors[index == 1].tolist())


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100}


def test_components_of_a_hub(spark, monkeypatch):
    from tagwright.llm import common

    monkeypatch.setattr(common, "HUB_ROWS", 4)
    edges = spark.createDataFrame([(7, i) for i in range(10, 60)] + [(59, 3), (200, 201)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys([3, 7, *range(10, 60)], 3), 200: 200, 201: 200}


def test_hub_join_equals_a_join(spark, monkeypatch):
    from tagwright.llm import common

    monkeypatch.setattr(common, "HUB_ROWS", 3)
    rows = spark.createDataFrame([(k, i) for i in range(30) for k in ([1, None] if i % 3 else [2, 5])], "k long, i long")
    facts = common.keep(rows.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n_rows"), F.max("i").alias("m")), "facts")
    want = sorted(tuple(r) for r in rows.join(facts.drop("n_rows"), "k").collect())
    assert sorted(tuple(r) for r in common.hub_join(rows, facts, "k").collect()) == want


def test_lm_scores_base_and_probabilities(spark, prose):
    got = {r.doc_id: r for r in lm_scoring.lm_scores(prose, remainder("doc_id", 5) == 1).collect()}
    texts = {r.doc_id: WORD.findall(lower(r.text)) + [None] for r in prose.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = collections.Counter(t for i, ts in texts.items() if not held[i] for t in ts)
    n, v = sum(counts.values()), len(counts)
    for i, ts in texts.items():
        r = got[i]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(ts), sum(t in counts for t in ts), n, held[i])
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_lm_next_symbol_distribution_sums_to_one(spark, prose):
    """Over every word, the end and an unknown word, after one word of context."""
    tree, _ = lm_scoring.learn(prose)
    tree = tree._replace(levels=tree.levels[:1])
    assert len(tree.levels[0]["states"])
    total = 0.0
    for text in [*(f"kana {w}" for w in sorted({w for r in prose.collect() for w in r.text.split()})), "kana neverseen", "kana"]:
        found = lm_scoring.symbols(pa.array([text]))
        at, hashes = found.context(1)
        context, there = np.zeros(len(found.symbols), np.uint64), np.zeros(len(found.symbols), bool)
        context[at], there[at] = hashes, True
        place, known = lm_scoring.find(tree.alphabet, found.symbols)
        root = np.where(known, tree.known(tree.counts[place]), tree.unknown())
        total += 10 ** lm_scoring.log_probability(tree, found.symbols, [context], [there], root)[1]
    assert total == pytest.approx(1.0, abs=1e-6)


def plain_scores(texts, taught, max_depth, context_share, joint_share):
    """log10 probability of each text by dictionaries of counts, depth by depth."""
    end, total = "</s>", sum(len(t) + 1 for t, teach in zip(texts, taught, strict=True) if teach)
    counts = [collections.Counter() for _ in range(max_depth + 2)]  # of runs of so many symbols within a text and its end
    for text, teach in zip(texts, taught, strict=True):
        run = [*text, end]
        for n in range(1, max_depth + 2):
            counts[n].update(tuple(run[i : i + n]) for i in range(len(run) - n + 1) if teach)
    once, twice = sum(n == 1 for n in counts[1].values()), sum(n == 2 for n in counts[1].values())
    discount = once / (once + 2 * twice) if once else 0.5
    states = {}  # context -> kept symbols' probabilities, factor of the rest

    def p(context, symbol):
        """Of a symbol after a context, by its longest retained suffix."""
        if not context:
            n = counts[1][symbol,]
            return max(n - discount, 1e-9) / total if n else discount * len(counts[1]) / total
        kept, rest = states.get(context, ({}, None))
        if rest is None:
            return p(context[1:], symbol)
        return kept[symbol] if symbol in kept else rest * p(context[1:], symbol)

    alphabet = {s for (s,), n in counts[1].items() if n >= joint_share * total}
    often = {c for c in counts[1] if c[0] in alphabet and c != (end,)}
    for depth in range(1, max_depth + 1):
        often = {c for c in often if counts[depth][c] >= context_share * total}
        entries = collections.defaultdict(dict)
        for run, n in counts[depth + 1].items():
            if run[:-1] in often and run[-1] in alphabet and n >= max(joint_share * total, lm_scoring.LEAST_COUNT):
                entries[run[:-1]][run[-1]] = n
        new = {}
        for context, some in entries.items():
            seen = counts[depth][context]
            mine = {s: max(n - lm_scoring.DISCOUNT, 1e-9) / seen for s, n in some.items()}
            parent = {s: p(context[1:], s) for s in some}
            rest = max(1 - sum(mine.values()), 1e-9) / max(1 - sum(parent.values()), 1e-9)
            gain = sum(n * math.log(mine[s] / parent[s]) for s, n in some.items()) + (seen - sum(some.values())) * math.log(rest)
            if gain >= lm_scoring.GAIN * len(some):
                new[context] = (mine, rest)
        states.update(new)
        often = {(*c, s) for c, some in entries.items() for s in some if s != end}
    return [sum(math.log10(p(tuple(([*t, end])[max(0, i - max_depth) : i]), s)) for i, s in enumerate([*t, end])) for t in texts], len(states)


@pytest.mark.parametrize(("context_share", "joint_share"), [(1e-3, 2e-4), (1e-5, 1e-6)])
def test_lm_score_against_dictionaries(spark, context_share, joint_share):
    """Texts in which some words follow each other, so that contexts of every depth are retained."""
    rng = np.random.default_rng(8)
    phrases = ["the red fox runs", "a red hen sits", "the old red fox sleeps now", "every hen runs home"]
    texts = [" ".join(x for _ in range(int(rng.integers(1, 9))) for x in (phrases[int(rng.integers(4))], f"w{int(rng.integers(30))}")).split() for _ in range(150)]
    taught = [i % 5 != 0 for i in range(150)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(docs, F.col("doc_id") % 5 == 0, 3, context_share, joint_share).collect()}
    want, states = plain_scores(texts, taught, 3, context_share, joint_share)
    assert states > 20 and [got[i] for i in range(150)] == pytest.approx(want, rel=1e-6)


def test_lm_takes_odd_rows(odd):
    out = lm_scoring.lm_scores(odd, remainder("doc_id", 5) == 1)
    assert out.count() == len(ODD) and out.where("score is null or base_score is null").isEmpty()


def test_language_id_on_held_out_documents(prose, odd):
    model = language_id.train(prose, remainder("doc_id", 5) != 0)
    rows = language_id.predict(prose, model).collect()
    assert np.mean([r.lang_pred == r.lang for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]) > 0.95
    out = {(r.doc_id, r.text and r.text[:9]): r for r in language_id.predict(odd, model).collect()}
    assert out[3, None].lang_pred == "und" and out[4, ""].lang_pred == "und" and out[7, "\n\n\n\n"].score == 0.0
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_decoding_equals_a_plain_one(prose):
    """Margins and losses bit by bit and gram by gram."""
    model = language_id.train(prose, F.lit(True))
    rows = prose.limit(40).collect()
    for r in language_id.predict(prose, model).where(F.col("doc_id").isin([r.doc_id for r in rows])).collect():
        votes = np.zeros(model.code.shape[1])
        n = 0
        for features, _ in language_id.grams(pa.array([r.text])):
            for f in features.tolist():
                votes += model.weights[f].astype(float)
                n += 1
        losses = []
        for k in range(len(model.languages)):
            agree = [max(-4.0, min(4.0, model.code[k, b] * votes[b] / max(n, 1) / model.scale[b])) for b in range(len(votes))]
            losses.append(sum(model.trust[k, b] * math.exp(-a) for b, a in enumerate(agree)))
        shares = [math.exp(-language_id.SHARPNESS * (x - min(losses))) for x in losses]
        assert r.lang_pred == model.languages[int(np.argmin(losses))] and r.score == pytest.approx(max(shares) / sum(shares), rel=1e-5)


def test_language_id_on_the_documents(spark):
    """The contract's split: held-out accuracy, and rows without an id."""
    from tagwright.llm.queries import QUERIES
    from tests.oracle import SF_DIR

    lang = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang is not null").select("doc_id", "lang")
    held = QUERIES["op6_language_id"](spark, SF_DIR).where("held_out and lang_pred <> 'und'").join(lang, "doc_id")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held.count() > 20 and right > 0.95


@pytest.mark.parametrize("n", [1, 2, 4, 6, 9, 40])
def test_codewords_differ(n):
    code = language_id.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n and (n < 2 or all(0 < (c > 0).sum() < n for c in code.T))


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack"


def test_decontamination_finds_reordered_passages(spark, odd):
    w = ITEM.split()
    docs = [
        (1, f"before {ITEM} after"),
        (2, " ".join(["x", *w[10:], "filler words here", *w[:10]])),
        (3, " ".join(w[:7]) + " nothing else of it"),
        (4, "The QUICK brown, fox -- jumps over the lazy dog; while seven wizards make toxic brew!"),
        (5, " ".join(reversed(w))),
        (6, "tiny item"),
        (7, None),
    ]
    items = [(10, ITEM), (11, "tiny item"), (12, ""), (13, None), (None, "x")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == {(1, 10), (2, 10), (4, 10), (6, 11)}
    assert got[1, 10].coverage == 1.0 and got[2, 10].n_tiles == 2 and got[2, 10].coverage == 1.0
    assert decontaminate.contaminated(odd, spark.createDataFrame(items, "item_id long, text string")).count() == 0


def plain_tiles(item, text, least):
    im, tm, out = [False] * len(item), [False] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and not im[i + n] and not tm[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < least:
            return out
        im[i : i + n], tm[t : t + n] = [True] * n, [True] * n
        out.append((i, t, n))


def test_tiling_equals_the_plain_algorithm():
    rng = np.random.default_rng(3)
    for _ in range(60):
        item, text = rng.integers(0, 4, int(rng.integers(3, 20))).astype(np.uint64), rng.integers(0, 4, int(rng.integers(0, 40))).astype(np.uint64)
        got = decontaminate.tiles(item, text, 3)
        assert got == plain_tiles(item.tolist(), text.tolist(), 3)


def plain_coverage(item, text, least=decontaminate.MIN_MATCH):
    size = min(least, len(item))
    return sum(n for _, _, n in plain_tiles(item, text, size)) / len(item)


def test_decontamination_against_all_pairs(spark):
    """Items and documents of few words, so that seeds are shared by many of both."""
    rng = np.random.default_rng(11)
    common = [f"c{i}" for i in range(8)]
    items = [(100 + k, [*common, *(f"w{x}" for x in rng.integers(0, 60, int(rng.integers(3, 14))))] if k % 3 else [f"w{x}" for x in rng.integers(0, 60, int(rng.integers(2, 24)))]) for k in range(18)]
    items += [(200, common), (201, ["same"] * 14), (101, items[0][1]), (202, [*common[:6], *common[:6]])]
    docs = []
    for d in range(60):
        words = []
        for _ in range(int(rng.integers(1, 5))):
            source = items[int(rng.integers(len(items)))][1]
            at, n = int(rng.integers(max(1, len(source) // 2))), int(rng.integers(1, 20))
            words += [*source[at : at + n], *(f"x{x}" for x in rng.integers(0, 9, int(rng.integers(0, 3))))]
        docs.append((d, words + common * (d % 2)))
    want = {}
    for d, text in docs:
        for i, item in items:
            if (held := plain_coverage(item, text)) >= decontaminate.COVERAGE:
                want[d, i] = max(held, want.get((d, i), 0))
    table = lambda rows, name: spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string")
    got = decontaminate.contaminated(table(docs, "doc_id"), table(items, "item_id")).collect()
    assert {(r.doc_id, r.item_id): r.coverage for r in got} == pytest.approx(want) and len(got) == len(want) > 30


def test_license_scan(spark, odd):
    mit = license_scan.TEMPLATES["MIT"][2]
    docs = [
        (1, "x y. Released under the MIT License.\nz"),
        (2, "head " * 300 + mit.upper() + " tail" * 300),
        (3, " ".join(w for i, w in enumerate(mit.split()) if i != 25)),
        (4, " ".join(mit.split()[:20])),
        (5, "all rights reserved"),
        (6, "released under my own terms"),
    ]
    got = {(r.doc_id, r.license_id) for r in license_scan.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(1, "MIT"), (2, "MIT"), (3, "MIT"), (5, "all-rights-reserved")}
    assert license_scan.license_scan(odd).count() == 0


def license_shingles(words):
    k = min(license_scan.SHINGLE, len(words))
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]


def test_license_scan_against_every_window(spark):
    """What a window of a template's length holds is found; what is found lies within that window and an eighth on either side."""
    rng, parts = np.random.default_rng(17), re.compile(r"[a-z0-9]+")
    notices = license_scan.notices()
    pairs_of = [{(notice[i - 1], notice[i]) for i in at} for (_, notice), at in zip(notices, license_scan.telling(notices), strict=True)]
    assert all(notice == parts.findall(" ".join(notice)) for _, notice in notices)
    docs = []
    for d in range(4 * len(notices)):
        words = notices[d % len(notices)][1].copy()
        for _ in range(int(rng.integers(0, 4))):
            at = int(rng.integers(len(words)))
            words[at : at + int(rng.integers(0, 3))] = ["changed"] * int(rng.integers(0, 2))
            words = words or ["gone"]
        around = [f"f{x}" for x in rng.integers(0, 50, 40)]
        docs.append((d, " ".join([*around[: int(rng.integers(40))], *words, *around])))
    got = {(r.doc_id, r.license_id) for r in license_scan.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    least, most = set(), set()
    for d, text in docs:
        words = parts.findall(text)
        for (name, notice), telling in zip(notices, pairs_of, strict=True):
            wanted = set(license_shingles(notice))
            k = min(license_scan.SHINGLE, len(notice))
            mine, n = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)], len(license_shingles(notice))
            step = max(1, n // 8)

            def holds(a, b, mine=mine, wanted=wanted, telling=telling, words=words, k=k):
                a = max(a, 0)
                return len(wanted & set(mine[a:b])) / len(wanted) >= license_scan.CONTAINMENT and telling <= set(zip(words[a : b + k - 1], words[a + 1 : b + k - 1], strict=False))

            for at in range(len(mine)):
                if holds(at, at + n):
                    least.add((d, name))
                if holds(at - step, at + n + step):
                    most.add((d, name))
    # a template that lies within another license's gives way to it
    longer = {(d, a) for d, a in least - got if any(b != a and (d, b) in got for _, b in ((0, n) for n, w in notices if any(" ".join(v) in " ".join(w) for m, v in notices if m == a)))}
    assert least - longer <= got <= most and len(least) > 50


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_each_notice_is_its_own_license(name):
    index = license_scan.Index(license_scan.templates(license_scan.TEMPLATES))
    for text in license_scan.TEMPLATES[name]:
        hashes = license_scan.words(pa.array([f"before it {text} after it"]), license_scan.NOT_ALNUM).hashes()
        assert {m[0] for m in index.matches(hashes, license_scan.CONTAINMENT)} == {name}


def test_other_versions_are_other_licenses():
    index = license_scan.Index(license_scan.templates(license_scan.TEMPLATES))
    found = lambda t: {m[0] for m in index.matches(license_scan.words(pa.array([t]), license_scan.NOT_ALNUM).hashes(), license_scan.CONTAINMENT)}
    gpl, cc = license_scan.TEMPLATES["GPL-3.0"][1], license_scan.TEMPLATES["CC-BY-4.0"][1]
    assert found(gpl.replace("version 3", "version 1")) == set() and found(gpl.replace("version 3", "version 2")) == {"GPL-2.0"}
    assert found(gpl.replace("General", "Affero General")) == {"AGPL-3.0"}
    assert found(cc.replace("4.0", "3.0")) == set() and found(cc.replace("Attribution", "Attribution-NoDerivatives")) == set()
    assert found(license_scan.TEMPLATES["Apache-2.0"][0].replace("2.0", "1.1")) == set()


BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
AS_IS = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
NEITHER = "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"


@pytest.mark.parametrize(
    ("text", "licenses"),
    [
        (BSD + AS_IS, {"BSD-2-Clause"}),
        (BSD + "3. " + NEITHER.format("the copyright holder") + AS_IS, {"BSD-3-Clause"}),
        (BSD + NEITHER.format("Acme Inc.") + AS_IS, {"BSD-3-Clause"}),
        (BSD + "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the University. 4. " + NEITHER.format("the University") + AS_IS, {"BSD-4-Clause"}),
        (GRANT + ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED", {"MIT"}),
        (GRANT + '. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING', {"MIT-0"}),
        (FEE + ", provided that the above copyright notice and this permission notice appear in all copies.", {"ISC"}),
        (FEE + '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE', {"0BSD"}),
        ("GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation. The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most software and other practical works are designed to take away your freedom to share and change the works.", {"GPL-3.0"}),
        ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991", {"GPL-2.0"}),
        ("GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007", {"AGPL-3.0"}),
        ("// SPDX-License-Identifier: MIT\nint main", {"MIT"}),
        ("// SPDX-License-Identifier: MIT-0\nint main", {"MIT-0"}),
        ("# SPDX-License-Identifier: GPL-3.0-or-later", {"GPL-3.0"}),
        ("# SPDX-License-Identifier: CC-BY-NC-SA-4.0", {"CC-BY-NC-SA-4.0"}),
        ("# SPDX-License-Identifier: Artistic-2.0", set()),
        (BSD, set()),
        ("Permission is hereby denied to any person obtaining a copy of this software.", set()),
    ],
)
def test_licenses_of_a_family_are_told_apart(text, licenses):
    index = license_scan.Index(license_scan.templates(license_scan.TEMPLATES))
    hashes = license_scan.words(pa.array(["lorem ipsum " * 20 + text + " dolor sit" * 20]), license_scan.NOT_ALNUM).hashes()
    assert {m[0] for m in index.matches(hashes, license_scan.CONTAINMENT)} == licenses


def test_secret_scan(spark, odd):
    model = secret_scan.train(spark)
    findings = secret_scan.labelled_findings(600, seed=99)
    docs = spark.createDataFrame([(i, f"{r.before}{r.candidate}\" and so on", None, r.path, None) for i, r in enumerate(findings.itertuples())], SCHEMA)
    found = {r.doc_id for r in secret_scan.secret_scan(docs, model).collect()}
    right = np.mean([(i in found) == bool(r.label) for i, r in enumerate(findings.itertuples())])
    assert right > 0.93
    assert secret_scan.secret_scan(odd, model).count() == 0
