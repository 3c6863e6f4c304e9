import pytest
from pyspark.sql import functions as F

from tagwright.llm.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF_DIR, assert_same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR), ORACLE_SQL[name])


def test_pipeline_keeps_what_it_should(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        before = kept.count()
        kept = stage(spark, kept, SF_DIR)
        assert kept.columns == docs.columns and 0.7 * before < kept.count() <= before
    out = corpus_pipeline.run(spark, SF_DIR)
    assert set(docs.columns) <= set(out.columns)
    assert out.join(kept.select("doc_id").distinct(), "doc_id", "left_anti").isEmpty()


def test_sharding_query_returns_every_document_once(spark):
    import hashlib

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = QUERIES["op4_sharding"](spark, SF_DIR).collect()
    md5 = lambda t: None if t is None else hashlib.md5(t.encode()).hexdigest()
    assert sorted((r.doc_id, r.text_md5) for r in rows) == sorted((r.doc_id, md5(r.text)) for r in docs)
    assert all(r.shard_id.startswith("data/") and r.shard_tier >= 0 for r in rows)


def plain_candidates(text):
    """Spans of a text, byte by byte: values after a sign or a secret word, known prefixes, and long runs with a digit."""
    from tagwright.llm import secret_scan

    gap, close = b" \t\r\n\x0b\x0c", b".,;:)]}-"
    token = set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.-")
    spans, runs, n = set(), set(), len(text)

    def bare(at, first_not=b""):
        end = at
        while end < n and text[end] not in gap + b"\"'" and not (end == at and text[end] in first_not):
            end += 1
        trimmed = end
        while trimmed > at and text[trimmed - 1] in close:
            trimmed -= 1
        return at, trimmed, end

    def blanks(at):
        while at < n and text[at] in b" \t":
            at += 1
        return at

    at = 0
    while at < n:  # what is assigned; a search goes on behind a value
        if text[at] in b"=:":
            for begin in dict.fromkeys((blanks(at + 1), *range(blanks(at + 1), at, -1))):
                quote = text[begin : begin + 1]
                if quote in (b'"', b"'") and quote:
                    end = begin + 1
                    while end < n and text[end] not in quote + b"\r\n":
                        end += 1
                    if end < n and text[end : end + 1] == quote and end > begin + 1:
                        spans.add((begin + 1, end))
                        at = end
                        break
                    begin += 1
                a, b, end = bare(begin)
                if end > a:
                    spans.add((a, b))
                    at = end - 1
                    break
        at += 1
    lowered = text.lower()
    for word in secret_scan.SECRET_WORDS:
        for k in range(n):
            if lowered.startswith(word.encode(), k):
                begin = blanks(k + len(word))
                if begin > k + len(word):
                    while begin < n and text[begin] in b"\"'([{<":
                        begin += 1
                    a, b, end = bare(begin, b"=:")
                    if end > a:
                        spans.add((a, b))
    for prefix in secret_scan.PREFIXES:
        for k in range(n):
            if text.startswith(prefix.encode(), k) and (not k or text[k - 1] not in token):
                end = k + len(prefix)
                while end < n and text[end] in token:
                    end += 1
                if end > k + len(prefix):
                    runs.add((k, k + len(text[k:end].rstrip(b".-"))))
    spans = {(a, b) for a, b in spans | runs if b - a >= 6 and sum(c >= 128 or chr(c).isalnum() for c in text[a:b]) >= 4}
    at = 0
    while at < n:
        end = at
        while end < n and text[end] in token:
            end += 1
        size = len(text[at:end].rstrip(b".-"))
        if size >= 12 and any(48 <= c <= 57 for c in text[at:end]):
            spans.add((at, at + size))
        at = max(end, at + 1)
    return spans


def test_secret_candidates_by_plain_expressions(spark):
    """Every run of token characters with a digit, and every marked value, of each whole text, found byte by byte."""
    from tagwright.llm import secret_scan

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    hand = ['token = "abc123def"', "token == x9", "password: hunter2, then", "the key (see below)", "secret - none", "a=b", "key = '' x", "api_key: 'open", "Bearer \t<QmFzZTY0>"]
    docs = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame([(-i - 1, t, None) for i, t in enumerate(hand)], "doc_id long, text string, source string"))
    rows = docs.collect()
    want = {(r.doc_id, a, b - a) for r in rows for a, b in plain_candidates((r.text or "").encode())}
    got = {(r.doc_id, r.at, r.size) for r in secret_scan.candidates(docs).select("doc_id", "at", "size").collect()}
    named = {(i, a, n) for i, a, n in got ^ want}
    assert not named, [(i, a, n, next(r.text.encode()[a : a + n] for r in rows if r.doc_id == i), (i, a, n) in got) for i, a, n in sorted(named)[:20]]
    assert len(got) > 10


def test_secret_findings_of_the_tables(spark):
    """Findings and not documents: the tables hold `token = "..."` of 40 hexadecimal digits."""
    import re

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    planted = {(i, m.start(1), 40) for i, t in texts.items() for m in re.finditer(rb'token = "([0-9a-f]{40})"', t)}
    found = {(r.doc_id, r.at, r.size) for r in QUERIES["op5_secret_scan"](spark, sf).collect()}
    print("precision", len(found & planted) / len(found), "recall", len(found & planted) / len(planted), [texts[i][a : a + n] for i, a, n in found - planted])
    assert len(planted) > 5 and len(found & planted) >= 0.95 * max(len(found), len(planted)) and all(n >= 6 for _, _, n in found)


def test_secret_scan_of_an_empty_table_learns_and_finds_nothing(spark):
    from tagwright.llm import secret_scan

    assert secret_scan.secret_scan(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0


def test_texts_without_a_letter_are_undetermined(spark):
    from tagwright.llm import language_id

    docs = spark.createDataFrame([(i, t, x) for i, (t, x) in enumerate([("the house and the cat", "en"), ("das haus und die katze", "de")] * 5)], "doc_id long, text string, lang string")
    model = language_id.train(docs, F.lit(True))
    odd = ["½ ½", "²² ³", "ⅷ", "12 _ 3", "…", "٣٤", "a", "ª", "漢", "é"]
    got = {r.doc_id: r.lang_pred for r in language_id.predict(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), model).collect()}
    assert [got[i] == "und" for i in range(len(odd))] == [not any(c.isalpha() for c in t) for t in odd]
