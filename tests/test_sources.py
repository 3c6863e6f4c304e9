"""Sources, sinks and the batch: encodings, outputs read back, replaced stores, failures of single files."""

import pytest
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.operators import linkage, store
from tagwright.sources import readers, staging, writers
from tagwright.streaming.intake import current, fold, intake, last_batch, planned

ROW = "file string, brand string, year_week string, country string, retailer string, n int"
HEAD = "Brand,Product Category,Sub Category,Model Code,Model Local Name\n"


@pytest.mark.parametrize(("encoding", "said"), [("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("cp1252", "windows-1252"), ("cp1256", "windows-1256")])
def test_a_catalog_is_read_in_its_own_encoding(spark, tmp_path, encoding, said):
    name = "گچ" if encoding == "cp1256" else "Kühlgerät"
    path = tmp_path / "catalog.csv"
    path.write_bytes((HEAD + f"LG,ref,x,GRC1,{name}\n").encode(encoding))
    assert readers.text_encoding(spark, str(path)) == said
    row = readers.read_catalog(spark, str(path)).first()
    assert (row.brand_raw, row.code_raw, row.name_raw) == ("LG", "GRC1", name)


def test_the_first_source_that_is_there(spark, tmp_path):
    names = ("Model List.csv", "Model List.parquet")
    assert readers.find_source(spark, str(tmp_path), names).endswith(names[1])
    (tmp_path / names[0]).write_text(HEAD)
    assert readers.find_source(spark, str(tmp_path), names).endswith(names[0])


def outputs(spark, *weeks):
    rows = spark.createDataFrame([(w, f'a "b", c\nd {i}') for i, w in enumerate(weeks)], "w string, note string")
    return rows.select(*[F.col("w" if h == "Year-Week" else "note").alias(h) if h in ("Year-Week", "Notes / Flags") else F.lit("").alias(h) for h in R.HEADERS])


def test_outputs_are_read_back_as_they_were(spark, tmp_path):
    one, two = outputs(spark, "2026-W01", "2026-W02"), outputs(spark, "2026-W03")
    for k, rows in enumerate((one, two)):
        writers.write_output(rows.coalesce(1), str(tmp_path / str(k)))
    first = next((tmp_path / "0").glob("part-*.csv")).read_bytes()
    assert first.startswith("﻿".encode() + b"Leaflet / File Name,")
    back = readers.read_outputs(spark, str(tmp_path / "0"), str(tmp_path / "1"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in one.unionByName(two).collect())


def test_an_upload_replaces_the_store_and_archives_the_old_one(spark, tmp_path):
    path, archive = str(tmp_path / "store"), str(tmp_path / "archive" / "store-1")
    writers.replace_store(outputs(spark, "2026-W01"), path, archive)
    writers.replace_store(outputs(spark, "2026-W02", ""), path, archive)
    assert {r.week for r in spark.read.parquet(path).collect()} == {"2026-W02", "unknown-week"}
    assert {r.week for r in spark.read.parquet(archive).collect()} == {"2026-W01"}
    with pytest.raises(ValueError, match="Currency"):
        writers.replace_store(outputs(spark, "2026-W03").drop("Currency"), path, archive)


def test_token_audit(spark, tmp_path):
    tokens = spark.createDataFrame([("f", 1, 2, "b"), ("f", 1, 1, "a"), ("g", 2, 1, "c")], "file string, page int, tok_id long, text string")
    writers.write_token_audit(tokens, str(tmp_path / "audit"))
    text = [p.read_text() for p in (tmp_path / "audit" / "file=f" / "page=1").glob("*.csv")]
    assert text == ["tok_id,text\n1,a\n2,b\n"]


def test_a_file_that_fails_is_noted_and_the_others_go_on(spark, tmp_path):
    source, at, mark, ledger = (str(tmp_path / x) for x in ("in", "store", "checkpoint", "ledger"))
    put = lambda *values: spark.createDataFrame(list(values), ROW).coalesce(1).write.mode("append").parquet(source)
    bad = F.when(F.col("n") < 0, F.raise_error(F.lit("unreadable"))).otherwise(F.col("n")).cast("int")
    run = lambda: intake(spark, source, ROW, at, mark, lambda df: df.withColumn("n", bad), 10, ledger)
    put(("a", "X", "w", "", "", 1), ("b", "X", "w", "", "", 2))
    assert run() == 2
    put(("a", "X", "w", "", "", -1), ("b", "X", "w", "", "", 4), ("c", "", "w", "", "", 5))
    assert run() == 3
    assert {(r.file, r.n) for r in current(spark, at).collect()} == {("a", 1), ("b", 4)}
    noted = {(r.file, r.status, r.n_rows) for r in readers.read_ledger(spark, ledger).collect()}
    assert noted == {("a", "done", 1), ("b", "done", 1), ("a", "failed", 0), ("b", "done", 1), ("c", "done", 1)}
    before = last_batch(spark, at)
    fold(spark, at)
    assert last_batch(spark, at) == before and {(r.file, r.n) for r in current(spark, at).collect()} == {("a", 1), ("b", 4)}
    put(("b", None, "w", "", "", 9), ("d", "Y", "w", "", "", 6))
    assert run() == 2
    assert {(r.file, r.n) for r in current(spark, at).collect()} == {("a", 1), ("d", 6)}


def test_a_dry_run_names_what_would_be_processed(spark, tmp_path):
    for name in ("2026-w28/a.pdf", "2026-w28/b.pdf", "2026-w29/c.pdf", "2026-w29/d.txt"):
        (tmp_path / "leaflets" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "leaflets" / name).write_bytes(b"x")
    source, ledger = str(tmp_path / "leaflets"), str(tmp_path / "ledger")
    names = lambda **more: {r.file for r in planned(spark, source, ledger, **more).collect()}
    assert names() == {"a.pdf", "b.pdf", "c.pdf"} and names(week="2026-w29") == {"c.pdf"}
    writers.append_log(spark.createDataFrame([("a.pdf", "done"), ("b.pdf", "failed")], "file string, status string"), ledger)
    assert names() == {"b.pdf", "c.pdf"} and names(force=True, week="2026-w28") == {"a.pdf", "b.pdf"}


def test_staging_needs_a_shared_folder_off_one_machine(spark, monkeypatch):
    context = type("Context", (), {"master": "spark://host:7077", "getConf": lambda self: type("Conf", (), {"get": lambda self, k: None})()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(type("Session", (), {"sparkContext": context})())
    table = staging.keep(spark.range(3), "short-lived")
    staging.discard(table)
    assert not staging.exists(spark, table.inputFiles()[0].rsplit("/", 1)[0])


def test_a_page_is_folded_as_a_whole_in_reading_order(spark):
    """Whatever tasks its tokens come from; against a plain fold of means that move."""
    import random

    pick, rows = random.Random(3), []
    for page in range(30):
        rows += [(f"f{page % 3}", page, t, 0, str(pick.randrange(100, 999)), float(pick.randrange(0, 1500)), float(pick.randrange(0, 700))) for t in range(pick.randrange(1, 25))]
    want = {}
    for file, page, t, _, _, x, y in sorted(rows, key=lambda r: r[:3]):
        sums = want.setdefault((file, page), ([], {}))[0]
        k = next((k for k, (a, b, n) in enumerate(sums) if abs(x - a / n) <= R.CLUSTER_DX and abs(y - b / n) <= R.CLUSTER_DY), len(sums))
        a, b, n = sums[k] if k < len(sums) else (0.0, 0.0, 0)
        sums[k:k + 1] = [(a + x, b + y, n + 1)]
        want[file, page][1][t] = k
    pick.shuffle(rows)
    tokens = spark.createDataFrame(rows, "file string, page int, tok_id long, part int, text string, cx double, cy double").repartition(5)
    got = {}
    for r in linkage.price_clusters(tokens).collect():
        got.setdefault((r.file, r.page), {})[r.tok_id] = r.cluster
    assert got == {k: v[1] for k, v in want.items()}


def test_run_counters(spark):
    rows = spark.createDataFrame([("f", "R1", []), ("f", "R1", ["x"]), ("f", None, ["x"]), ("f", "", [])], "file string, matched_code string, flag_codes array<string>")
    assert tuple(store.run_counters(rows).first()) == ("f", 1, 1, 2)


def test_a_folder_of_four_encodings_in_one_read(spark, tmp_path):
    head = HEAD.strip().split(",")
    files = {"a.csv": ("utf-8", "Kühlgerät", head), "b.csv": ("utf-8-sig", "Größe", head[::-1]), "c.csv": ("cp1252", "Café €", head), "d.csv": ("cp1256", "گچ", head[2:] + head[:2])}
    for name, (encoding, local, columns) in files.items():
        row = {"Brand": "LG", "Product Category": "ref", "Sub Category": '"x, y"', "Model Code": f"0{name}", "Model Local Name": local}
        text = ",".join(columns) + "\n" + "".join(",".join(row[c] + (str(k) if c == "Model Code" else "") for c in columns) + "\n" for k in range(3)) + "\n"
        (tmp_path / name).write_bytes(text.encode(encoding))
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    got = readers.read_catalog(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(r.source_file, r.code_raw, r.name_raw, r.sub_raw, r.brand_raw) for r in got] == [(n, f"0{n}{k}", files[n][1], "x, y", "LG") for n in sorted(files) for k in range(3)]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before
    assert {r.encoding for r in readers.file_encodings(spark, str(tmp_path)).collect()} == {"UTF-8", "windows-1252", "windows-1256"}


def test_a_changed_page_under_an_old_name_is_read_again(spark):
    from tagwright.operators import prefilter

    pages = spark.createDataFrame([("f", 1, "same"), ("f", 2, "new text"), ("f", 3, None), ("g", 1, "first")], "file string, page int, text string")
    old = spark.createDataFrame([("f", 1, "same"), ("f", 2, "old text"), ("f", 3, ""), ("h", 1, "gone")], "file string, page int, text string")
    keyed = lambda df, version: df.select("file", "page", prefilter.content_key(F.col("text"), version).alias("key"))
    names = lambda df: {(r.file, r.page) for r in df.collect()}
    assert names(prefilter.unread(keyed(pages, "v1"), keyed(old, "v1"))) == {("f", 2), ("g", 1)}
    assert len(names(prefilter.unread(keyed(pages, "v2"), keyed(old, "v1")))) == 4
    assert names(prefilter.still_valid(keyed(old, "v1"), keyed(pages, "v1"))) == {("f", 1), ("f", 3)}


def test_positions_are_global_and_ties_keep_the_order_of_the_input(spark):
    from tagwright.operators.ordering import ordinals

    rows = [(i % 3 if i % 4 else None, i) for i in range(200)]
    table = staging.keep(spark.createDataFrame(rows, "k int, i int").coalesce(1), "rows")
    got = [(r.k, r.i) for r in sorted(ordinals(table, F.asc_nulls_first("k")).collect(), key=lambda r: r.ordinal)]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(r.ordinal for r in ordinals(table, F.desc("k")).collect()) == list(range(1, 201))
    assert ordinals(staging.keep(table.limit(0), "none"), F.asc("k")).count() == 0
