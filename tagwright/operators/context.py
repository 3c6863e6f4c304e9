"""What a file name says: country, currency, retailer, profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright import reference_data as R
from tagwright.functions.text import file_tokens


def _table(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _first(tokens: Column, table: Column) -> Column:
    return F.get(F.filter(F.transform(tokens, lambda t: table[t]), lambda v: v.isNotNull()), 0)


def resolve_context(files: DataFrame, file: str = "source_file", override: str | None = None) -> DataFrame:
    """files with country, currency, decimals, retailer, resolved_by; the first token of the name with a meaning counts.

    override: a column with a country or an alias; null where there is none.
    """
    tokens = file_tokens(F.col(file))
    countries, currencies = _table(R.COUNTRY_ALIASES), _table(R.CURRENCY_OF_COUNTRY)
    named = _first(tokens, countries)
    given = F.col(override) if override else F.lit(None).cast("string")
    forced = F.when(currencies[given].isNotNull(), given).otherwise(countries[F.lower(given)])
    has_override = given.isNotNull() & (given != "")
    country = F.coalesce(F.when(has_override, forced).otherwise(named), F.lit("UNKNOWN"))
    by = F.when(has_override, "override").when(named.isNotNull(), "filename").otherwise("unresolved")
    out = files.withColumns({"country": country, "retailer": F.coalesce(_first(tokens, _table(R.RETAILER_ALIASES)), F.lit("UNKNOWN")), "resolved_by": by})
    out = out.withColumn("currency", F.coalesce(currencies[F.col("country")], F.lit("")))
    return out.withColumn("decimals", _table(R.DECIMALS_OF_CURRENCY)[F.col("currency")])


def with_profile(files: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """files (retailer, country) with profile, zoom, price_position: of retailer/country, else of the retailer, else the default."""
    spark = files.sparkSession
    if profiles is None:
        profiles = spark.createDataFrame([(k, *v) for k, v in R.PROFILES.items()], "name string, zoom double, price_position string")
    exact, general = (profiles.select(F.col("name").alias(f"_{k}"), F.struct(F.col("name").alias("profile"), "zoom", "price_position").alias(f"_{k}_profile")) for k in ("exact", "general"))
    zoom, position = R.DEFAULT_PROFILE
    default = F.struct(F.lit("DEFAULT").alias("profile"), F.lit(zoom).alias("zoom"), F.lit(position).alias("price_position"))
    joined = files.join(exact, F.concat_ws("/", "retailer", "country") == F.col("_exact"), "left").join(general, F.col("retailer") == F.col("_general"), "left")
    return joined.withColumn("_profile", F.coalesce("_exact_profile", "_general_profile", default)).select(*files.columns, "_profile.*")
