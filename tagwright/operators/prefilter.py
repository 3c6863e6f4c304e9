"""Which pages deserve a full read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.functions.text import is_code_shaped, is_strong_code, normalize_code


def skim_pages(tokens: DataFrame, stems: DataFrame | None = None, keywords: str = f"(?i){R.KEYWORDS}", quorum: int = R.KEYWORD_QUORUM) -> DataFrame:
    """file, page -> n_tokens, n_keywords, has_code, has_shape, tier. tokens: file, page, text. stems: stem of the catalog.

    A token gives one row, or one for each of its words that are shaped like a
    code; the rest of its words are not looked at further than for a digit.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.transform(F.regexp_extract_all(text, F.lit(r"\S*\d\S*"), 0), normalize_code)
    shaped = F.filter(words, lambda w: is_code_shaped(w, 6))
    rows = tokens.select("file", "page", text.rlike(keywords).alias("_keyword"), F.posexplode_outer(shaped).alias("_at", "_word"))
    if stems is None:
        rows = rows.withColumn("_known", F.lit(False))
    else:
        rows = rows.join(stems.select(F.col("stem").alias("_word"), F.lit(True).alias("_known")).distinct(), "_word", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    first, named = F.coalesce(F.col("_at") == 0, F.lit(True)), F.col("_word").isNotNull()
    found = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    counts = rows.groupBy("file", "page").agg(
        F.count_if(first).alias("n_tokens"),
        F.count_if(first & F.col("_keyword")).alias("n_keywords"),
        found(named & F.col("_known")).alias("has_code"),
        found(named & ~F.col("_known") & is_strong_code(F.col("_word"))).alias("has_shape"),
    )
    tier = F.when(F.col("n_keywords") >= quorum, "keywords").when(F.col("has_code"), "code").when((F.col("n_keywords") >= 1) & F.col("has_shape"), "weak")
    return counts.withColumn("tier", F.coalesce(tier, F.lit("none")))


def candidate_pages(skimmed: DataFrame) -> DataFrame:
    """file, page: hits and their neighbours within the file's pages."""
    pages = skimmed.groupBy("file").agg(F.max("page").alias("n_pages"))
    near = skimmed.where("tier <> 'none'").select("file", F.explode(F.sequence(F.col("page") - 1, F.col("page") + 1)).alias("page"))
    return near.join(pages, "file").where("page between 1 and n_pages").select("file", "page").distinct()


def with_date_pages(candidates: DataFrame, files: DataFrame, first: int = 3) -> DataFrame:
    """candidates and the first pages of every file, once each."""
    dated = files.select("file", F.explode(F.sequence(F.lit(1), F.lit(first))).alias("page"))
    return candidates.unionByName(dated.withColumn("page", F.col("page").cast(candidates.schema["page"].dataType))).distinct()


def text_layer(pages: DataFrame) -> DataFrame:
    """file -> avg_words, verdict, busiest_page. pages: file, page, n_words."""
    average = F.avg("n_words")
    verdict = F.when(average >= 30, "digital").when(average <= 3, "scan").otherwise("mixed")
    return pages.groupBy("file").agg(average.alias("avg_words"), verdict.alias("verdict"), F.max_by("page", F.struct("n_words", -F.col("page"))).alias("busiest_page"))


def page_numbers(spec: Column, n_pages: Column) -> Column:
    """'1,3-5' -> [1, 3, 4, 5], in order, within the pages; empty parts are skipped."""
    parts = F.filter(F.transform(F.split(spec, ","), lambda p: F.trim(p)), lambda p: p != "")
    first, last = (lambda p: F.split_part(p, F.lit("-"), F.lit(1)).cast("int")), (lambda p: F.coalesce(F.split_part(p, F.lit("-"), F.lit(2)).try_cast("int"), F.split_part(p, F.lit("-"), F.lit(1)).cast("int")))
    numbers = F.flatten(F.transform(parts, lambda p: F.when(first(p) <= last(p), F.sequence(first(p), last(p))).otherwise(F.array().cast("array<int>"))))
    return F.filter(numbers, lambda n: (n >= 1) & (n <= n_pages))


def uncached(pages: DataFrame, cached: DataFrame) -> DataFrame:
    """Pages whose tokens are not there yet."""
    return pages.join(cached, ["file", "page"], "left_anti")


def content_key(content: Column, version: str) -> Column:
    """Key of a cached result: what it was made from, and the version of what made it."""
    return F.sha2(F.concat(F.lit(f"{version}|"), F.coalesce(content, F.lit(""))), 256)


def unread(pages: DataFrame, cache: DataFrame) -> DataFrame:
    """pages (file, page, key) without a cached result of their key: new ones, and those whose content or version has changed under their name."""
    return pages.join(cache.select("file", "page", "key").distinct(), ["file", "page", "key"], "left_anti")


def still_valid(cache: DataFrame, pages: DataFrame) -> DataFrame:
    """cache without the results that no page has a use for: pages that are gone, or have another content or version now."""
    return cache.join(pages.select("file", "page", "key").distinct(), ["file", "page", "key"], "left_semi")
