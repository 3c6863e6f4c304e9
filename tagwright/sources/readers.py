"""Readers of the inputs: raw catalogs, token caches, profiles, ledgers, health logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.operators.ordering import ordinals
from tagwright.sources.staging import exists, keep

#: Files whose encodings are broadcast, else joined by a shuffle.
MANY_FILES = 100_000
TOKENS = "file string, page int, tok_id long, text string, conf double, x0 double, y0 double, x1 double, y1 double"
LEDGER = "file string, status string, n_rows long, year_week string, ts timestamp, error string"
HEALTH = "ts string, file string, retailer string, country string, year_week string, matched long, clean long, clean_rate double, priced_rate double, capacity_rate double, below_share double, rescue_count long, no_cluster_count long, verdicts array<string>"
CATALOG_NAMES = {"Brand": "brand_raw", "Product Category": "category_raw", "Sub Category": "sub_raw", "Model Code": "code_raw", "Model Local Name": "name_raw"}


def _high(encoding: str) -> tuple[str, str]:
    """Characters that Latin-1 gives the bytes from 128, and those that the encoding gives them (where it gives any)."""
    pairs = [(chr(b), bytes([b]).decode(encoding, "ignore")) for b in range(128, 256)]
    return tuple(map("".join, zip(*[(x, y) for x, y in pairs if y], strict=True)))


def decoded(line: Column, encoding: Column) -> Column:
    """A line, read as bytes, in its encoding: UTF-8 or one of the Windows code pages."""
    latin = F.decode(line.cast("binary"), "ISO-8859-1")
    return F.when(encoding == "UTF-8", line).when(encoding == "windows-1252", F.translate(latin, *_high("cp1252"))).otherwise(F.translate(latin, *_high("cp1256")))


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """path, encoding of each file: UTF-8 if its bytes are valid; else Windows-1252 unless a byte has no meaning there; else Windows-1256, which gives every byte one."""
    odd = ~F.is_valid_utf8("value")
    undefined = F.hex(F.col("value").cast("binary")).rlike("^(..)*(81|8D|8F|90|9D)")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), (odd & undefined).alias("undefined"), odd.alias("odd"))
    encoding = F.when(~F.bool_or("odd"), "UTF-8").when(F.bool_or("undefined"), "windows-1256").otherwise("windows-1252")
    return lines.groupBy("path").agg(encoding.alias("encoding"))


def text_encoding(spark: SparkSession, path: str) -> str:
    """The encoding of the files of a path, where they have one in common; of several the one that gives most bytes a meaning."""
    found = [r.encoding for r in file_encodings(spark, path).select("encoding").distinct().collect()]
    return max(found, default="UTF-8", key=("UTF-8", "windows-1252", "windows-1256").index)


def read_catalog(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Raw catalogs in CSV, all text, with ord in reading order, file after file.

    Each file is read in its own encoding, which is found out where it is not
    given, and by its own header, a line that names the model code; its columns
    may be in any order. Cells have no line breaks. No session setting is changed.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), "value")
    found = keep(file_encodings(spark, path), "encodings") if encoding is None else None
    lines = lines.withColumn("encoding", F.lit(encoding)) if found is None else lines.join(F.broadcast(found) if found.count() <= MANY_FILES else found, "path")
    lines = keep(ordinals(keep(lines.select("path", "_block", decoded(F.col("value"), F.col("encoding")).alias("line")), "lines"), F.asc("path"), F.asc("_block"), name="ord"), "lines")
    width = lines.agg(F.max(F.size(F.split("line", ",")))).first()[0] or 1
    cells = F.array(*[F.col(f"_c.c{k}") for k in range(width)])
    parsed = F.from_csv("line", ", ".join(f"c{k} string" for k in range(width)), {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    rows = lines.withColumn("line", F.regexp_replace("line", "^\ufeff", "")).where("trim(line) <> ''").withColumn("_c", parsed).withColumn("_cells", cells)
    rows = rows.withColumn("_header", F.coalesce(F.array_contains("_cells", "Model Code"), F.lit(False)))
    headers = rows.where("_header").groupBy("path").agg(F.min_by("_cells", "ord").alias("_names"))
    # a header names few columns, so there is one short row a file
    rows = rows.where("not _header").join(headers, "path")
    cell = lambda name: F.get("_cells", F.array_position("_names", name) - 1)
    named = [F.when(F.coalesce(F.array_position("_names", name), F.lit(0)) > 0, cell(name)).alias(column) for name, column in CATALOG_NAMES.items()]
    return rows.select(*named, "ord", F.element_at(F.split("path", "/"), -1).alias("source_file"))


def find_source(spark: SparkSession, folder: str, names: tuple[str, ...] = ("Model List.csv",), default: str | None = None) -> str:
    """Path of the first name that is there, else the default (the last name)."""
    for name in names:
        if exists(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    return f"{folder}/{default or names[-1]}"


def read_outputs(spark: SparkSession, *paths: str) -> DataFrame:
    """The rows of output files, with or without a byte order mark, one after the other; all text, empty and not null."""
    schema = ", ".join(f"`{h}` string" for h in R.HEADERS)
    return spark.read.schema(schema).options(header=True, enforceSchema=True, escape='"', multiLine=True).csv(list(paths)).na.fill("")


def read_tokens(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A token cache; blank tokens are dropped."""
    return spark.read.schema(TOKENS).options(header=True).format(fmt).load(path).where("trim(text) <> ''")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """name, zoom, price_position of a profiles file."""
    profile = "struct<zoom:double,price_position:string>"
    doc = spark.read.schema(f"profiles map<string,{profile}>").json(path, multiLine=True)
    return doc.select(F.explode("profiles").alias("name", "p")).select("name", "p.zoom", "p.price_position")


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("bom_to_model map<string,string>").json(path, multiLine=True).select(F.explode("bom_to_model").alias("bom", "model"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).json(path)


def read_health(spark: SparkSession, path: str, retailer: str | None = None, country: str | None = None) -> DataFrame:
    """Health records, newest first; lines that are no records are dropped."""
    rows = spark.read.schema(HEALTH).option("mode", "DROPMALFORMED").json(path).where("ts is not null")
    for name, value in (("retailer", retailer), ("country", country)):
        rows = rows.where(F.col(name) == value) if value else rows
    return rows.orderBy(F.desc("ts"))


def list_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """path, file, length of the files below a folder."""
    found = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern).load(path)
    return found.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "length").orderBy("path")


def missing_headers(rows: DataFrame) -> list[str]:
    """Columns of the output format that an uploaded table lacks."""
    return [h for h in R.HEADERS if h not in rows.columns]
