"""Was, now and member prices of one product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.functions.text import bound, flag

FLAG = "struct<code:string,detail:string>"


def _outcome(rrp, promo, pct, confidence, why=None, member=None) -> Column:
    number = lambda x, t: (F.lit(None) if x is None else x if isinstance(x, Column) else F.lit(x)).cast(t)
    return F.struct(
        number(rrp, "double").alias("rrp"),
        number(promo, "double").alias("promo"),
        number(pct, "int").alias("pct"),
        number(confidence, "double").alias("confidence"),
        (F.lit(None) if why is None else why).cast(FLAG).alias("why"),
        number(member, "double").alias("member"),
    )


def _pair(low: Column, high: Column, n: Column, middle: Column, pct: Column, glyph: Column, tolerance: float) -> Column:
    """Two or more different prices without member prices among them."""
    implied = high * (1 - pct / 100)
    error = F.when(low != 0, F.abs(implied - low) / low).otherwise(1.0)
    text = lambda c: c.cast("string")
    return (
        F.when(
            pct.isNull() & (low < 0.25 * high),
            _outcome(high, low, None, 0.40, flag("implausible_discount", "too large a reduction to believe: ", text(low), " from ", text(high))),
        )
        .when(pct.isNull() & (n == 2), _outcome(high, low, None, F.when(glyph, 0.88).otherwise(0.85)))
        .when(pct.isNull() & (n == 3), _outcome(high, middle, None, 0.82, None, low))
        .when(pct.isNull(), _outcome(high, low, None, 0.60, flag("ambiguous_pair", "which price is which is open: ", text(n), " prices and no percentage")))
        .when(error <= tolerance, _outcome(high, low, pct, 0.97))
        .otherwise(_outcome(high, low, pct, 0.55, flag("badge_mismatch", "the percentage does not fit: ", text(high), " less ", text(pct), "% is ", text(F.bround(implied).cast("long")), ", not ", text(F.bround(low).cast("long")))))
    )


def resolve_prices(df: DataFrame, prices: str = "prices", percents: str = "percents", glyph: str = "glyph", members: str = "members", tolerance: float = 0.03) -> DataFrame:
    """df with `resolution`: rrp, promo, pct, confidence, why (a flag or null), member.

    prices, members: arrays of double; percents: array of int, of which the
    first counts; glyph: whether a price had a currency letter. Nulls and empty
    arrays count as nothing found.
    """
    none = F.array().cast("array<double>")
    rest = F.array_sort(F.array_except(F.coalesce(F.col(prices), none), F.coalesce(F.col(members), none)))
    df = df.withColumns({"_rest": rest, "_pct": F.get(F.coalesce(F.col(percents), F.array().cast("array<int>")), 0), "_member": F.array_min(F.coalesce(F.col(members), none)), "_glyph": F.coalesce(F.col(glyph), F.lit(False))})
    n, low, high, middle = F.size("_rest"), F.get("_rest", 0), F.array_max("_rest"), F.get("_rest", 1)
    df = df.withColumn("_pair", F.when(n >= 2, _pair(low, high, n, middle, F.col("_pct"), F.col("_glyph"), tolerance)))
    has_member = F.col("_member").isNotNull()
    single = F.when(
        F.col("_pct").isNull(), _outcome(None, low, None, 0.75, flag("single_price", "one price alone"))
    ).otherwise(_outcome(None, low, F.col("_pct"), 0.75, flag("single_price", "one price with a percentage")))
    resolution = (
        F.when(has_member & (n >= 2), F.col("_pair").withField("member", F.col("_member")))
        .when(has_member & (n == 1), _outcome(low, None, None, 0.5, flag("now_unreadable", "the price for all is missing, the one for members is there"), F.col("_member")))
        .when(has_member, _outcome(None, None, None, 0.3, flag("only_member", "no price but the one for members"), F.col("_member")))
        .when(n == 0, _outcome(None, None, None, 0.0, flag("no_price", "without a price")))
        .when(n == 1, single)
        .otherwise(F.col("_pair"))
    )
    return df.withColumn("resolution", resolution).drop("_rest", "_pct", "_member", "_glyph", "_pair")


def rescued_price(garble: Column, floor: Column, ceiling: Column) -> Column:
    """Smallest run of 3 to 5 digits in [floor, ceiling), or null."""

    def smallest(digits: Column) -> Column:
        at = F.sequence(F.lit(1), F.greatest(F.length(digits) - 2, F.lit(1)))
        # a run at the end may be shorter than asked for, but then it is one of the shorter runs
        runs = F.flatten(F.transform(at, lambda i: F.array(*[F.substr(digits, i, F.lit(n)).try_cast("double") for n in (3, 4, 5)])))
        return F.when(F.length(digits) >= 3, F.array_min(F.filter(runs, lambda v: (v >= floor) & (v < ceiling))))

    return bound(F.regexp_replace(garble, r"\D", ""), smallest)
