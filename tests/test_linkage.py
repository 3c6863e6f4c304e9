"""Pages of the layout families, with answers worked out by hand."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwright.functions.text import flag_text
from tagwright.operators import linkage
from tagwright.operators.catalog import clean_catalog, code_metadata
from tagwright.operators.linkage import expand_glued, extract_rows
from tagwright.operators.matching import match
from tagwright.operators.similarity import Block
from tagwright.plans import queries
from tagwright.sources.staging import keep
from tests.oracle import SF_DIR

CATALOG = [
    (1, "Samsung", "REF", "Top mount", "RT50CG6404S9/AE"),
    (2, "Samsung", "REF", "Side by side", "RS70F65Q1F"),
    (3, "LG", "WM", "Front load", "F4R5VYG2T"),
    (4, "LG", "REF", "Top mount", "GRC342SLBB"),
]


# A page a file: text, center x, center y, and conf if it is not 0.99.
PAGES = {
    "badge": [("2099", 100, 100), ("D2999", 200, 100), ("-30%", 300, 100), ("550L1 Dual", 150, 820), ("RT50CG6404S9", 150, 900)],
    "financing": [("1299", 100, 100), ("1599", 100, 160), ("tabby", 80, 300), ("D104", 150, 300), ("230", 120, 600), ("GRC342SLBB", 130, 900)],
    "garble": [("5299", 100, 100), ("47999", 100, 160, 0.74), ("4599", 100, 220), ("650", 300, 400), ("LITRES", 300, 440), ("RS70F65Q1F", 200, 700)],
    "below": [("RS70F65Q1F", 150, 100), ("NET-607L", 150, 150), ("WAS8999", 120, 800), ("D5499D5199", 150, 860), ("WORTHD1999", 150, 900)],
    "foreign": [("QQ99ZZ88X", 100, 500), ("999", 100, 100)],
    "shared": [("1299", 100, 100), ("1599", 100, 160), ("GRC342SLBB", 100, 500), ("F4R5VYG2T", 100, 560)],
    "columns": [("1299", 100, 100), ("1599", 100, 160), ("2299", 900, 100), ("2599", 900, 160), ("GRC342SLBB", 480, 500), ("F4R5VYG2T", 900, 500)],
    "empty": [(" ", 1, 1)],
}
TOKEN = "file string, page int, tok_id long, text string, conf double, x0 double, y0 double, x1 double, y1 double"


def tokens_of(spark, pages):
    rows = [(file, 1, i, t[0], t[3] if len(t) > 3 else 0.99, t[1] - 40.0, t[2] - 15.0, t[1] + 40.0, t[2] + 15.0) for file, page in pages.items() for i, t in enumerate(page)]
    return spark.createDataFrame(rows, TOKEN)


@pytest.fixture(scope="module")
def catalog(spark):
    return clean_catalog(spark.createDataFrame(CATALOG, "ord long, brand_raw string, category_raw string, sub_raw string, code_raw string")).cache()


@pytest.fixture(scope="module")
def found(spark, catalog):
    positions = spark.createDataFrame([("below", "below")], "file string, price_position string")
    rows = extract_rows(tokens_of(spark, PAGES).cache(), catalog, positions).withColumn("text", flag_text(F.col("flags")))
    return {(r.file, r.model): r for r in rows.collect()}


def test_prices_above_with_badge(found):
    r = found["badge", "RT50CG6404S9"]
    assert (r.matched_code, r.rrp, r.promo, r.badge, r.confidence, r.capacity, r.text) == ("RT50CG6404S9", 2999.0, 2099.0, 30, 0.97, "550 L", "")
    assert (r.brand, r.category, r.cluster_dy) == ("SAMSUNG", "REF", -800.0)


def test_financing_and_image_junk(found):
    r = found["financing", "GRC342SLBB"]
    assert (r.rrp, r.promo, r.confidence, r.text) == (1599.0, 1299.0, 0.85, "")


def test_stack_with_garble_is_rescued(found):
    r = found["garble", "RS70F65Q1F"]
    assert (r.rrp, r.promo, r.member, r.capacity) == (5299.0, 4799.0, "Member price 4599", "650 L")
    assert [f.code for f in r.flags] == ["rescued"] and "4799" in r.text and "'47999'" in r.text


def test_prices_below_and_glued(found):
    r = found["below", "RS70F65Q1F"]
    assert (r.rrp, r.promo, r.member, r.capacity) == (8999.0, 5499.0, "Member price 5199", "607 L net")


def test_page_without_matches(found):
    r = found["foreign", "QQ99ZZ88X"]
    assert r.matched_code is None and r.out_of_category and r.flags[0].code == "out_of_category" and r.promo == 999.0


def test_shared_cluster_is_flagged(found):
    shared = {code: [f.detail for f in found["shared", code].flags if f.code == "shared_cluster"] for code in ("GRC342SLBB", "F4R5VYG2T")}
    assert shared["GRC342SLBB"] == [] and len(shared["F4R5VYG2T"]) == 1 and "GRC342SLBB" in shared["F4R5VYG2T"][0]


def test_two_columns_pair_off(found):
    assert found["columns", "GRC342SLBB"].promo == 1299.0 and found["columns", "F4R5VYG2T"].promo == 2299.0


def test_nothing_else_is_found(found):
    assert len(found) == 9


def test_glued_tokens_keep_their_order(spark):
    got = expand_glued(tokens_of(spark, {"f": [("D5499D5199", 100, 100), ("WASD8999!", 100, 100), ("WORTH5", 1, 1), ("77", 1, 1)]})).orderBy("tok_id", "part").collect()
    assert [(r.text, r.part, r.x0, r.x1) for r in got] == [("D5499", 0, 60.0, 100.0), ("D5199", 1, 100.0, 140.0), ("8999", 0, 60.0, 140.0), ("77", 0, -39.0, 41.0)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous = 0
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], previous + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_match_ladder_against_a_plain_one(spark, catalog):
    stems = sorted({c[4].split("/")[0] for c in CATALOG})
    tokens = ["RT50CG6404S9", "RT5OCG64O4S9", "RT50CG6404", "XX", "AB123", "GRC342SLB", "ZZZZZZZZZ", "F4R5VYG2T9", "R570F65Q1F", "A" * 80]
    df = spark.createDataFrame([(t,) for t in tokens], "norm string")
    got = {r.norm: r for r in match(df, catalog).collect()}
    same = str.maketrans("OILSBZG", "0115826")
    for t in tokens:
        r = got[t]
        legal = [s for s in stems if s.translate(same) == t.translate(same)]
        score, best = max((200 * lcs(t, s) / (len(t) + len(s)), [-ord(c) for c in s], s) for s in stems)[::2]
        want = ("none", None) if len(t) < 3 else ("exact", t) if t in stems else ("none", None) if len(t) <= 5 else ("confusion", legal[0]) if legal else ("fuzzy", best) if score >= 85 else ("none", None)
        assert (r.method, r.matched_code) == want, t
        if want[0] == "fuzzy":
            assert r.confidence == pytest.approx(score / 100)


def test_similarity_at_every_vector_width():
    names = sorted({c[4].split("/")[0] for c in CATALOG} | {"A1" * 9, "RS70F65Q1F" * 5})
    block = Block(names)
    for code in ("R5", "RT50CG6404S9", "A1" * 8, "RS70F65Q1F" * 3 + "A1", "A1" * 31 + "Z", "RS70F65Q1F" * 8):
        assert block.lcs(code).tolist() == [lcs(code, n) for n in names], code


@pytest.mark.parametrize("name, exchanges", [("link_overlap", 2), ("capacity_near", 3)])
def test_boxes_are_dealt_by_page_once_to_tasks_that_follow_the_tiles(spark, monkeypatch, name, exchanges):
    monkeypatch.setattr(queries, "TILES_A_TASK", 500)
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    found = re.findall(r"(?<!Reused)Exchange hashpartitioning\((.*), (\d+)\)", plan)
    assert len(found) == exchanges and all("page#" in keys and "tok_id" not in keys and n == "12" for keys, n in found), plan


def test_rows_without_a_code_are_no_single_key_of_the_metadata(spark):
    rows = spark.range(400).select("id", F.when(F.col("id") % 4 == 0, F.concat(F.lit("S"), (F.col("id") % 8).cast("string"))).alias("matched_code"))
    known = spark.createDataFrame([("S0", "a", "b", "c", "S0", 1), ("S4", "d", "e", "f", "S4", 2)], "stem string, brand string, category string, sub string, norm_code string, ord long")
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        got = code_metadata(rows, known).withColumn("at", F.spark_partition_id()).collect()
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert len(got) == 400 and {(r.matched_code, r.brand) for r in got} == {(None, None), ("S0", "a"), ("S4", "d")}
    assert len({r.at for r in got if r.matched_code is None}) == 4


def test_page_tokens_are_the_boxes(spark):
    """One explode a tile gives the rows of the view box_obs."""
    boxes = queries._boxes(spark, SF_DIR).join(queries.view(spark, SF_DIR, "catalog_raw").select("ord", "code_raw"), F.expr("kind = 'code' and val = ord"), "left")
    words = F.expr("case kind when 'code' then code_raw when 'was' then 'D' || val when 'now' then '' || val when 'chip' then '' || val when 'unit' then if(val = 1, 'KG', 'LITRES') when 'member' then 'DG MEMBER' else 'tabby' end")
    order = F.expr("slot * 10 + array_position(array('code', 'was', 'now', 'chip', 'unit', 'member', 'fin'), kind)")
    want = boxes.select(F.col("page").cast("int"), order.alias("tok_id"), words.alias("text"), "conf", (F.col("cx") - 30).alias("x0"), (F.col("cy") - 15).alias("y0"))
    got = queries.page_tokens(spark, SF_DIR).select(want.columns)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_pages_fold_as_one_by_one():
    """Against the fold written token by token; pages of no, one and many tokens, and a token without a center."""
    random = np.random.default_rng(7)
    lengths = [0, 1, 300, 2, 0, 40, 41]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    xs, ys = random.integers(0, 4000, bounds[-1]).astype(float), random.integers(0, 3000, bounds[-1]).astype(float)
    xs[5] = np.nan
    want = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        clusters = []
        for x, y in zip(xs[a:b], ys[a:b], strict=True):
            near = [i for i, (sx, sy, n) in enumerate(clusters) if abs(x - sx / n) <= linkage.R.CLUSTER_DX and abs(y - sy / n) <= linkage.R.CLUSTER_DY]
            at = near[0] if near else len(clusters)
            clusters[at:] = [(clusters[at][0] + x, clusters[at][1] + y, clusters[at][2] + 1), *clusters[at + 1 :]] if near else [(x, y, 1)]
            want.append(at)
    assert linkage.cluster_numbers(xs, ys, bounds).tolist() == want


def test_only_tokens_with_codes_are_joined(spark, catalog, monkeypatch):
    """Words are made once and written; what is written has no token without a word like a code."""
    written = {}

    def kept(df, name):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(linkage, "keep", kept)
    linkage.model_codes(linkage.placed(tokens_of(spark, PAGES)), catalog).collect()
    assert {r.tok_id for r in written["page-words"].where("file = 'badge'").select("tok_id").collect()} == {1, 3, 4}


def test_only_what_bears_on_prices_is_written_for_the_clusters(spark, monkeypatch):
    written = {}

    def kept(df, name):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(queries, "keep", kept)
    assert queries.QUERIES["price_clusters"](spark, SF_DIR).count() > 0
    table = written["page-tokens"]
    assert not {"conf", "y1"} & set(table.columns) and table.where("text = 'DG MEMBER' or text rlike '^R[A-Z]'").isEmpty()


def test_clusters_rest_on_what_bears_on_prices(spark):
    texts = ["2099", "D2999", "-31%", "WASD8999!", "D5499E5199", "WORTHD1999", "650", "LITRES", "75", "KG", "NET550", "gro\u00df", "tabby D104", "RB12C34", "DG 5", "GROSS-607L", "550L1", "12,500.50", "EMI"]
    rows = [("f", 1, k, t, 0.9, 40.0 * (k % 4), 70.0 * (k // 4), 40.0 * (k % 4) + 60, 70.0 * (k // 4) + 30) for k, t in enumerate(texts)]
    tokens = linkage.placed(spark.createDataFrame(rows, "file string, page int, tok_id long, text string, conf double, x0 double, y0 double, x1 double, y1 double"))
    some = tokens.where(linkage.bears_on_prices(F.col("text")))
    found = lambda t: sorted(linkage.price_clusters(linkage.price_tokens(t, linkage.capacity_chips(t))).select("tok_id", "part", "text", "cluster", "price").collect())
    assert found(some) == found(tokens) and len(found(some)) > 3 and some.count() < tokens.count()
