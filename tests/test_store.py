from pyspark.sql import functions as F

from tagwright.operators import quality, store
from tagwright.sources import readers, writers
from tagwright.streaming.intake import current, intake

ROW = "file string, brand string, year_week string, country string, retailer string, n int"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROW)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_merge_is_idempotent_and_drops_files_that_yield_nothing(spark):
    old = rows(spark, ("a", "X", "2026-W01", "UAE", "Lulu", 1), ("b", "X", "2026-W01", "UAE", "Lulu", 2))
    new = rows(spark, ("a", "Y", "2026-W02", "UAE", "Lulu", 3), ("a", None, "2026-W02", "UAE", "Lulu", 4))
    once = store.merge_by_file(old, new)
    assert as_set(once) == {("b", "X", "2026-W01", "UAE", "Lulu", 2), ("a", "Y", "2026-W02", "UAE", "Lulu", 3)}
    assert as_set(store.merge_by_file(once, new)) == as_set(once)
    processed = spark.createDataFrame([("a",), ("b",)], "file string")
    assert {r.file for r in store.merge_by_file(old, new, processed).collect()} == {"a"}
    assert tuple(store.merge_summary(old, new).first()) == (1, 1, 1, 1)


def test_weeks_that_are_gone_go(spark, tmp_path):
    path = str(tmp_path / "weeks")
    writers.write_weeks(rows(spark, ("a", "X", "2026-W01", "", "", 1), ("b", "X", None, "", "", 2)), path)
    assert {r.week for r in spark.read.parquet(path).collect()} == {"2026-W01", "unknown-week"}
    writers.write_weeks(rows(spark, ("a", "X", "2026-W02", "", "", 1)), path)
    assert {r.week for r in spark.read.parquet(path).collect()} == {"2026-W02"}


def test_intake_processes_each_file_once(spark, tmp_path):
    source, at, mark = (str(tmp_path / x) for x in ("in", "store", "checkpoint"))
    run = lambda: intake(spark, source, ROW, at, mark, lambda df: df, files_per_batch=1)
    rows(spark, ("a", "X", "w", "", "", 1)).coalesce(1).write.mode("append").parquet(source)
    assert run() == 1
    rows(spark, ("a", "X", "w", "", "", 5), ("b", "X", "w", "", "", 2)).coalesce(1).write.mode("append").parquet(source)
    assert run() == 2
    assert run() == 0
    assert {(r.file, r.n) for r in current(spark, at).collect()} == {("a", 5), ("b", 2)}


def test_validation_blanks_impossible_capacities(spark):
    schema = "matched_code string, brand string, category string, capacity string, rrp double, promo double, confidence double, currency string"
    cases = [
        ("R1", "X", "REF", "8 kg", 2000.0, 1500.0, 0.9, "AED", ("", "ref_kg", 0.5)),
        ("R1", "X", "REF", "5000 L", 2000.0, 1500.0, 0.9, "AED", ("", "ref_range", 0.5)),
        ("W1", "X", "WM", "8/5 kg", 2000.0, 1500.0, 0.9, "AED", ("8/5 kg", "", 0.9)),
        ("W1", "X", "WM", "80/5 kg", 2000.0, 1500.0, 0.9, "AED", ("", "wm_range", 0.5)),
        ("W1", "", "WM", None, 100.0, 100.0, 0.4, "AED", ("", "metadata_missing,promo_not_below,promo_below_floor,regular_below_floor", 0.4)),
        (None, None, None, None, None, None, None, None, ("", "", None)),
    ]
    got = quality.validate_rows(spark.createDataFrame([c[:8] for c in cases], schema).coalesce(1)).collect()
    assert [(r.capacity, ",".join(p.code for p in r.problems), r.confidence) for r in got] == [c[8] for c in cases]


def test_drift(spark):
    schema = "matched long, below_share double, clean_rate double, priced_rate double, rescue_count long, price_position string"
    cases = [(6, 1.0, 0.83, 1.0, 0, "below"), (6, 1.0, 0.83, 1.0, 0, "above"), (6, 0.0, 0.4, 0.6, 3, "below"), (0, None, None, None, 0, "above")]
    got = quality.drift_verdicts(spark.createDataFrame(cases, schema).coalesce(1)).collect()
    assert [[v.code for v in r.verdicts] for r in got] == [[], ["drift_below"], ["drift_above", "low_clean", "unpriced", "rescues"], []]


def test_readers(spark, tmp_path):
    (tmp_path / "c.csv").write_bytes("Brand,Product Category,Sub Category,Model Code,Model Local Name\nCafé,REF,x,0123,y\n".encode("cp1252"))
    encoding = readers.text_encoding(spark, str(tmp_path / "c.csv"))
    r = readers.read_catalog(spark, str(tmp_path / "c.csv"), encoding).first()
    assert (encoding, r.brand_raw, r.code_raw) == ("windows-1252", "Café", "0123")
    (tmp_path / "p.json").write_text('{"profiles": {"Lulu": {"zoom": 3.0, "price_position": "above", "notes": "n"}}}')
    assert tuple(readers.read_profiles(spark, str(tmp_path / "p.json")).first()) == ("Lulu", 3.0, "above")
    (tmp_path / "x.json").write_text('{"bom_to_model": {"A": "B"}}')
    assert tuple(readers.read_crosswalk(spark, str(tmp_path / "x.json")).first()) == ("A", "B")
    (tmp_path / "h.jsonl").write_text('{"ts": "2", "retailer": "Lulu"}\nbroken\n{"ts": "3", "retailer": "Emax"}\n')
    assert [r.ts for r in readers.read_health(spark, str(tmp_path / "h.jsonl")).collect()] == ["3", "2"]
    assert readers.read_health(spark, str(tmp_path / "h.jsonl"), retailer="Lulu").count() == 1
    (tmp_path / "w" / "s").mkdir(parents=True)
    (tmp_path / "w" / "s" / "b.pdf").write_bytes(b"x")
    assert [r.file for r in readers.list_files(spark, str(tmp_path / "w")).collect()] == ["b.pdf"]


def test_output_has_its_columns(spark, tmp_path):
    none = F.array().cast("array<struct<code:string,detail:string>>")
    row = spark.range(1).select(
        F.lit("UAE_C4_W30.pdf").alias("source_file"), F.lit("SharafDG").alias("retailer"), F.lit("UAE").alias("country"), F.lit("AED").alias("currency"),
        F.lit("2026-07-09").cast("date").alias("start"), F.lit("2026-07-15").cast("date").alias("end"), none.alias("date_flags"), F.lit(2026).alias("year_hint"),
        F.lit("SAMSUNG").alias("brand"), F.lit("R1").alias("model"), F.lit("REF").alias("category"), F.lit("x").alias("sub"), F.lit("").alias("capacity"),
        F.lit(2999.0).alias("rrp"), F.lit(2099.0).alias("promo"), F.lit(20).alias("badge"), F.lit("").alias("details"), F.lit(3).alias("page"), none.alias("flags"),
    )
    out = store.output_rows(row)
    assert not readers.missing_headers(out)
    r = out.first().asDict()
    assert (r["Retailer"], r["Country / Region"], r["Year-Week"], r["Promo Start Date"], r["Brand"]) == ("Sharaf DG", "United Arab Emirates", "2026-W28", "09/07/2026", "Samsung")
    assert (r["Discount Amount"], r["Discount %"], r['Promo Price ("now")']) == ("900.000", "30.0%", "2099.000")
    assert "badge says -20% but computed 30.0%" in r["Notes / Flags"] and "filename says W30" in r["Notes / Flags"]
    writers.write_output(out, str(tmp_path / "o"))
    assert spark.read.csv(str(tmp_path / "o"), header=True).count() == 1


def test_notes_are_joined_texts(spark):
    """Notes are built without arrays of flags (the plan has two, of the flags that are given); blank and missing ones are left out."""
    given = "array<struct<code:string,detail:string>>"
    row = spark.sql(f"""SELECT 'a_W07.pdf' AS source_file, 'Emax' AS retailer, 'UAE' AS country, 'AED' AS currency, DATE '2026-01-05' AS start, DATE '2026-01-09' AS `end`,
     CAST(array(struct('x', ''), struct('y', NULL)) AS {given}) AS date_flags, 2026 AS year_hint, 'LG' AS brand, 'M' AS model, 'REF' AS category, '' AS sub, '' AS capacity,
     100.0D AS rrp, 80.0D AS promo, 30 AS badge, '' AS details, 1 AS page, CAST(array(struct('o', 'odd')) AS {given}) AS flags""")
    out = store.output_rows(row)
    want = "odd; badge says -30% but computed 20.0%; filename says W07 but promo dates on page give W02 — page dates used"
    assert out.first()["Notes / Flags"] == want
    assert store.output_rows(row.withColumn("flags", F.lit(None).cast(given))).first()["Notes / Flags"] is None
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "array_compact" not in plan and "badge says -" in plan
