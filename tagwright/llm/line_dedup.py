"""Removal of repeated passages of three lines or more, in DataFrame operations.

Every three consecutive lines are hashed. A window that occurs more than once
keeps its first occurrence (smallest id, then position); the lines that later
occurrences cover are merged into intervals and cut out of their documents. A
document is an id together with a hash of its text, so that rows which share an
id, or have none, are cut by their own lines only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagwright.llm.common import hub_join, keep

LINES = 3


def _lines(text: str):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _text_key(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def repeated_windows(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, pos of each later occurrence of a window that repeats."""
    last = F.size("lines") - LINES
    hashes = F.transform(
        F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.unhex(F.md5(F.array_join(F.slice("lines", i + 1, LINES), "\n"))),
    )
    spots = docs.select("doc_id", _text_key("text").alias("text_key"), _lines("text").alias("lines"))
    spots = keep(spots.select("doc_id", "text_key", F.posexplode(hashes).alias("pos", "window")), "line-windows")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key", "pos")
    first = spots.groupBy("window").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n_rows"))
    first = keep(first.where("n_rows > 1"), "line-repeated")
    later = hub_join(spots, first, "window").where(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "text_key", "pos").distinct()


def covered_intervals(windows: DataFrame) -> DataFrame:
    """doc_id, text_key, cuts: array of (lo, hi) line numbers, merged and in order."""
    document = "doc_id", "text_key"
    along = Window.partitionBy(*document).orderBy("pos")
    apart = F.coalesce(F.col("pos") - F.lag("pos").over(along) > LINES, F.lit(True))
    islands = windows.withColumn("island", F.sum(apart.cast("int")).over(along))
    cuts = islands.groupBy(*document, "island").agg(F.min("pos").alias("lo"), (F.max("pos") + LINES - 1).alias("hi"))
    return cuts.groupBy(*document).agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("cuts"))


def line_dedup(docs: DataFrame) -> DataFrame:
    """docs with its text cut, and n_lines, n_removed (columns of these names are replaced).

    Windows need three lines, so shorter texts stay as they are; null counts as
    one empty line and stays null. Lines of white space are lines like any
    other. Rows of the same id and text are one document: the same window at the
    same line is one occurrence, and all of them stay or are cut alike. Rows that
    share an id only are documents of their own. Rows of a null id come after
    all others, by the hash of their text.
    """
    cuts = covered_intervals(repeated_windows(docs)).withColumnsRenamed({"doc_id": "cut_id", "text_key": "cut_key"})
    docs = docs.drop("n_lines", "n_removed")
    rows = docs.select(F.struct(*docs.columns).alias("__row"))
    rows = rows.join(cuts, F.col("__row.doc_id").eqNullSafe(F.col("cut_id")) & (_text_key("__row.text") == F.col("cut_key")), "left")
    whole = F.coalesce("__row.text", F.lit(""))
    n = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    lines = _lines("__row.text")
    pieces = F.zip_with(
        F.concat(F.array(F.lit(0)), F.transform("cuts", lambda c: c["hi"] + 1)),
        F.concat(F.transform("cuts", lambda c: c["lo"]), F.array(n)),
        lambda s, e: F.struct((s + 1).alias("at"), F.greatest(e - s, F.lit(0)).alias("n")),
    )
    # bound as a lambda's variable, so that the lines are split once and not for each piece
    kept = F.flatten(F.transform(F.array(lines), lambda all_lines: F.flatten(F.transform(pieces, lambda p: F.slice(all_lines, p["at"], p["n"])))))
    cut = F.col("cuts").isNotNull() & F.col("__row.text").isNotNull()
    text = F.when(cut, F.array_join(kept, "\n")).otherwise(F.col("__row.text")).alias("text")
    gone = F.aggregate("cuts", F.lit(0), lambda total, c: total + F.greatest(F.least(c["hi"] + 1, n) - c["lo"], F.lit(0)))
    return rows.select(
        *[text if c == "text" else F.col(f"__row.`{c}`") for c in docs.columns],
        n.alias("n_lines"),
        F.when(cut, gone).otherwise(0).alias("n_removed"),
    )


ORACLE = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
t AS (SELECT doc_id, pos, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS win FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM t WHERE win IS NOT NULL),
c AS (SELECT DISTINCT doc_id, pos + o AS pos FROM r, (SELECT unnest(range({LINES})) AS o) WHERE nth > 1),
k AS (SELECT e.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
             coalesce(string_agg(e.line, chr(10) ORDER BY e.pos) FILTER (WHERE c.pos IS NULL), '') AS kept
      FROM e LEFT JOIN c USING (doc_id, pos) GROUP BY 1)
SELECT doc_id, CAST(n_lines AS INTEGER) AS n_lines, CAST(n_removed AS INTEGER) AS n_removed, md5(kept) AS text_md5 FROM k
"""
