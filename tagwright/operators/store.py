"""Output rows, routing, and the idempotent store by week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.functions.dates import duration_days, file_week, iso_year
from tagwright.functions.text import brand_display, fixed, flag_text, mapped
from tagwright.operators.ordering import ordinals


def discount(rows: DataFrame) -> DataFrame:
    """rows (rrp, promo, badge) with amount, percent and badge_off: more than 1.5 points between badge and prices."""
    both = F.col("rrp").isNotNull() & F.col("promo").isNotNull() & (F.col("rrp") > 0)
    percent = F.when(both, (F.col("rrp") - F.col("promo")) / F.col("rrp") * 100)
    off = F.coalesce(F.abs(percent - F.col("badge")) > 1.5, F.lit(False))
    return rows.withColumns({"amount": F.when(both, F.col("rrp") - F.col("promo")), "percent": percent, "badge_off": off})


def output_rows(rows: DataFrame) -> DataFrame:
    """The 21 text columns. rows: source_file, retailer, country, currency, start, end, date_flags, year_hint, brand, model, category, sub, capacity, rrp, promo, badge, details, page, flags."""
    # what several texts name is computed once a row, so they are texts and no arrays of flags
    rows = discount(rows)
    rows = rows.withColumns({"_week": F.weekofyear("start"), "_tagged": file_week(F.col("source_file")), "_shown": fixed(F.col("percent"), 1)})
    week, tagged, shown = F.col("_week"), F.col("_tagged"), F.col("_shown")
    found = F.col("start").isNotNull() & F.col("end").isNotNull()
    from_name = ~found & tagged.isNotNull() & F.col("year_hint").isNotNull()
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    said = (
        F.when(F.col("badge_off"), F.concat(F.lit("badge says -"), F.col("badge").cast("string"), F.lit("% but computed "), shown, F.lit("%"))),
        F.when(F.col("promo").isNotNull() & F.col("amount").isNull(), "no regular price on leaflet — discount not computable"),
    )
    weeks = (
        F.when(found & (tagged != week), F.concat(F.lit("filename says W"), two(tagged), F.lit(" but promo dates on page give W"), two(week), F.lit(" — page dates used"))),
        F.when(from_name, "promo dates not printed — week taken from filename"),
    )
    told = lambda c: F.when(F.size(c) > 0, F.nullif(flag_text(F.col(c)), F.lit("")))
    notes = F.when(F.col("flags").isNotNull() & F.col("date_flags").isNotNull(), F.concat_ws("; ", told("flags"), *said, told("date_flags"), *weeks))
    week_no = F.when(found, week).when(from_name, tagged)
    year_week = F.when(found, F.concat_ws("-W", iso_year(F.col("start")).cast("string"), two(week))).when(from_name, F.concat_ws("-W", F.col("year_hint").cast("string"), two(tagged)))
    none = F.lit("")
    text = lambda c: F.coalesce(c.cast("string"), none)
    percent = F.when(F.col("percent").isNotNull(), F.concat(shown, F.lit("%"))).otherwise("")
    values = (
        F.col("source_file"), mapped(F.col("retailer"), R.RETAILER_DISPLAY), mapped(F.col("country"), R.COUNTRY_DISPLAY), text(week_no), text(year_week),
        F.coalesce(F.date_format("start", "dd/MM/yyyy"), none), F.coalesce(F.date_format("end", "dd/MM/yyyy"), none), text(duration_days(F.col("start"), F.col("end"))),
        F.coalesce(brand_display(F.col("brand")), none), text(F.col("model")), text(F.col("category")), text(F.col("sub")), text(F.col("capacity")),
        fixed(F.col("rrp"), 3), fixed(F.col("promo"), 3), fixed(F.col("amount"), 3), percent, text(F.col("details")), text(F.col("page")),
        notes, text(F.col("currency")),
    )
    return rows.select(*[v.alias(h) for v, h in zip(values, R.HEADERS, strict=True)])


def route(rows: DataFrame, brand: str = "brand", out_of_category: str = "out_of_category") -> DataFrame:
    """rows with route: matched, review or out_of_scope."""
    has = F.coalesce(F.col(brand), F.lit("")) != ""
    return rows.withColumn("route", F.when(has, "matched").when(F.col(out_of_category), "out_of_scope").otherwise("review"))


def merge_by_file(existing: DataFrame, incoming: DataFrame, processed: DataFrame | None = None) -> DataFrame:
    """existing rows of files not processed now, and the incoming rows that have a brand.

    processed: all files of this run, so that a file which now yields nothing
    loses its old rows; by default the files that incoming names. Merging the
    same rows again changes nothing.
    """
    files = (processed if processed is not None else incoming).select("file").distinct()
    return existing.join(files, "file", "left_anti").unionByName(incoming.where(F.coalesce("brand", F.lit("")) != ""), allowMissingColumns=True)


def merge_summary(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row: n_added, n_replaced, n_skipped, n_files."""
    has = F.coalesce("brand", F.lit("")) != ""
    files = incoming.select("file").distinct()
    replaced = existing.join(files, "file", "left_semi").agg(F.count(F.lit(1)).alias("n_replaced"))
    counts = incoming.agg(F.count_if(has).alias("n_added"), F.count_if(~has).alias("n_skipped"), F.countDistinct("file").alias("n_files"))
    return counts.join(F.broadcast(replaced))  # one row each


def store_order(rows: DataFrame) -> DataFrame:
    """Rows by week, country, retailer and file, blanks first."""
    return rows.orderBy(*[F.coalesce(c, F.lit("")) for c in ("year_week", "country", "retailer", "file")])


def store_positions(rows: DataFrame) -> DataFrame:
    """rows with position (1, 2, ...) in the order of the store; rows that are equal in it keep the order of the input."""
    return ordinals(rows, *[F.coalesce(c, F.lit("")).asc() for c in ("year_week", "country", "retailer", "file")], name="position")


def weekly_counts(rows: DataFrame) -> DataFrame:
    week = F.when(F.coalesce("year_week", F.lit("")) == "", "unknown-week").otherwise(F.col("year_week"))
    return rows.groupBy(week.alias("week")).agg(F.count(F.lit(1)).alias("n"))


def run_counters(rows: DataFrame, by: str = "file") -> DataFrame:
    """Of each file: rows without a code (gaps), with a code and flags, with a code and none. rows: matched_code, flag_codes (array)."""
    matched, flagged = F.coalesce("matched_code", F.lit("")) != "", F.size("flag_codes") > 0
    return rows.groupBy(by).agg(F.count_if(matched & ~flagged).alias("n_ok"), F.count_if(matched & flagged).alias("n_flagged"), F.count_if(~matched).alias("n_gaps"))


def store_stats(rows: DataFrame) -> DataFrame:
    weeks = F.array_sort(F.collect_set(F.when(F.col("year_week") != "", F.col("year_week"))))
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("file").alias("n_files"), F.array_join(weeks, ",").alias("weeks"))


def fleet_status(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """files with status of the ledger (file, status, n_rows), `pending` where it has none."""
    return files.join(ledger, "file", "left").withColumns({"status": F.coalesce("status", F.lit("pending")), "n_rows": F.coalesce("n_rows", F.lit(0))})


def status_counts(fleet: DataFrame) -> DataFrame:
    return fleet.agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("done", "pending", "failed")])


def todo(files: DataFrame, ledger: DataFrame, force: bool = False, week: str | None = None) -> DataFrame:
    """Files not done yet; with force, all. week: only those below a folder of that name (files has path then)."""
    chosen = files if week is None else files.where(F.col("path").contains(f"/{week}/"))
    return chosen if force else chosen.join(ledger.where("status = 'done'").select("file").distinct(), "file", "left_anti")
