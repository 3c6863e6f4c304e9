import pytest
from pyspark.sql import functions as F

from tagwright.functions import dates, text
from tagwright.functions.prices import rescued_price, resolve_prices
from tagwright.operators.context import resolve_context, with_profile


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


PRICES = [
    # prices, percents, glyph, members -> rrp, promo, pct, confidence, why, member
    ([2099.0, 2999.0], [30], False, [], (2999.0, 2099.0, 30, 0.97, None, None)),
    ([2099.0, 2999.0], [50], False, [], (2999.0, 2099.0, 50, 0.55, "badge_mismatch", None)),
    ([799.0], [], False, [], (None, 799.0, None, 0.75, "single_price", None)),
    ([799.0], [20], False, [], (None, 799.0, 20, 0.75, "single_price", None)),
    ([799.0, 999.0], [], True, [], (999.0, 799.0, None, 0.88, None, None)),
    ([799.0, 999.0], [], False, [], (999.0, 799.0, None, 0.85, None, None)),
    ([783.0, 799.0, 999.0], [], False, [], (999.0, 799.0, None, 0.82, None, 783.0)),
    ([783.0, 799.0, 999.0], [20], False, [], (999.0, 783.0, 20, 0.97, None, None)),
    ([700.0, 783.0, 799.0, 999.0], [], False, [], (999.0, 700.0, None, 0.60, "ambiguous_pair", None)),
    ([230.0, 2999.0], [], False, [], (2999.0, 230.0, None, 0.40, "implausible_discount", None)),
    ([], [], False, [], (None, None, None, 0.0, "no_price", None)),
    ([999.0, 783.0], [], False, [783.0], (999.0, None, None, 0.5, "now_unreadable", 783.0)),
    ([783.0], [], False, [783.0], (None, None, None, 0.3, "only_member", 783.0)),
    ([999.0, 799.0, 783.0], [], True, [783.0], (999.0, 799.0, None, 0.88, None, 783.0)),
    ([12.5, 15.75], [21], False, [], (15.75, 12.5, 21, 0.97, None, None)),
    (None, None, None, None, (None, None, None, 0.0, "no_price", None)),
]


def test_price_resolution(spark):
    schema = "n int, prices array<double>, percents array<int>, glyph boolean, members array<double>"
    df = spark.createDataFrame([(i, *case[:4]) for i, case in enumerate(PRICES)], schema)
    got = {r.n: r.resolution for r in resolve_prices(df).collect()}
    for i, case in enumerate(PRICES):
        r = got[i]
        assert (r.rrp, r.promo, r.pct, r.confidence, r.why and r.why.code, r.member) == case[4], case


@pytest.mark.parametrize("garble, low, high, want", [("47999", 4500.0, 5299.0, 4799.0), ("207999", 783.0, 1099.0, 799.0), ("D12", 1.0, 9.0, None), ("", 1.0, 9.0, None)])
def test_rescued_price(spark, garble, low, high, want):
    assert one(spark, rescued_price(F.lit(garble), F.lit(low), F.lit(high))) == want


DATES = [
    (["Offer 10 July - 16 July 2026"], None, ("2026-07-10", "2026-07-16", "")),
    (["from 3 to 9 Jul"], 2026, ("2026-07-03", "2026-07-09", "year_inferred")),
    (["09/07/2026 - 15/07/2026"], None, ("2026-07-09", "2026-07-15", "")),
    (["09/07/26", "to", "15/07/26"], None, ("2026-07-09", "2026-07-15", "")),
    (["no dates"], 2026, (None, None, "no_dates")),
    (["18 - 7 July 2026"], None, (None, None, "ambiguous_range")),
    (["28 Dec till 3 January, 2026"], None, ("2026-12-28", "2027-01-03", "wraps")),
    (["3 - 9 Jul", "3 - 9 Jul 2026"], None, (None, None, "no_year")),
    (["31 Jun - 31 Jul 2026", "1/7/2026 - 2/7/2026"], None, ("2026-07-01", "2026-07-02", "")),
    (["16/07/2026 - 15/07/2026"], None, (None, None, "ambiguous_range")),
    ([], 2026, (None, None, "no_dates")),
]


def test_promo_dates(spark):
    df = spark.createDataFrame([(i, *case[:2]) for i, case in enumerate(DATES)], "n int, texts array<string>, hint int")
    got = {r.n: r.p for r in df.select("n", dates.promo_dates(F.col("texts"), F.col("hint")).alias("p")).collect()}
    for i, case in enumerate(DATES):
        p = got[i]
        assert (p.start and str(p.start), p.end and str(p.end), ",".join(w.code for w in p.why)) == case[2], case


@pytest.mark.parametrize("day, want", [("2027-01-01", "2026-W53"), ("2026-07-09", "2026-W28"), (None, "")])
def test_year_week(spark, day, want):
    assert one(spark, dates.year_week(F.lit(day).cast("date"))) == want


@pytest.mark.parametrize(
    "file, override, want",
    [
        ("BAH_LULU_W28.pdf", None, ("Bahrain", "BHD", 3, "Lulu", "filename")),
        ("UAE_C4.pdf", None, ("UAE", "AED", 2, "Carrefour", "filename")),
        ("Temporary Printing Window.pdf", None, ("UNKNOWN", "", None, "UNKNOWN", "unresolved")),
        ("Temporary Printing Window.pdf", "Oman", ("Oman", "OMR", 3, "UNKNOWN", "override")),
        ("x_sharaf.pdf", "ksa", ("KSA", "SAR", 2, "SharafDG", "override")),
        ("uae.pdf", "nowhere", ("UNKNOWN", "", None, "UNKNOWN", "override")),
    ],
)
def test_context(spark, file, override, want):
    df = spark.createDataFrame([(file, override)], "source_file string, o string")
    r = resolve_context(df, override="o").first()
    assert (r.country, r.currency, r.decimals, r.retailer, r.resolved_by) == want


def test_profile_chain(spark):
    files = spark.createDataFrame([("Lulu", "Kuwait"), ("Lulu", "UAE"), ("Other", "UAE")], "retailer string, country string")
    profiles = spark.createDataFrame([("Lulu", 3.0, "above"), ("Lulu/Kuwait", 4.0, "below")], "name string, zoom double, price_position string")
    got = {(r.retailer, r.country): (r.profile, r.zoom, r.price_position) for r in with_profile(files, profiles).collect()}
    assert got == {("Lulu", "Kuwait"): ("Lulu/Kuwait", 4.0, "below"), ("Lulu", "UAE"): ("Lulu", 3.0, "above"), ("Other", "UAE"): ("DEFAULT", 3.0, "above")}


@pytest.mark.parametrize(
    "fn, given, want",
    [
        (text.normalize_code, " (rt50 cg6404s9/ae). ", "RT50CG6404S9"),
        (text.normalize_code, "•abc-", "ABC"),
        (text.capacity, "550L1 Dual", "550 L"),
        (text.capacity, "8/5 kg", "8/5 kg"),
        (text.capacity, "607 Litres Net", "607 L net"),
        (text.capacity, "LED 4K", None),
        (text.price_value, "D2,999.50", 2999.5),
        (text.price_value, "AED 99", None),
        (text.title_case, "BLACK+DECKER o2-cool", "Black+Decker O2-Cool"),
        (text.percents, "-31% or 5 %", [31, 5]),
        (text.find_prices, "was 1,299.00 now 999 save 20%", [1299.0, 999.0]),
    ],
)
def test_text(spark, fn, given, want):
    assert one(spark, fn(F.lit(given))) == want


@pytest.mark.parametrize("word", ["24X500ML", "1+1", "MNT150G", "20GPROTEIN", "50DDDDD", "TABBY1050", "POWER:600W", "WAS8999", "D5499D5199", "NET-607L", "1.89LX2"])
def test_pack_sizes(spark, word):
    assert one(spark, text.is_pack_size(F.lit(word)))
