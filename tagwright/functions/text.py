"""Column functions over token texts and codes."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagwright import reference_data as R

_EDGE = r"[.,:;()\[\]{}\-–—•]+"


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_code(c: Column) -> Column:
    """Upper case, no spaces, up to the first slash, no punctuation at the ends."""
    stem = F.split_part(F.replace(stripped(F.upper(c)), F.lit(" "), F.lit("")), F.lit("/"), F.lit(1))
    return F.regexp_replace(stem, f"^{_EDGE}|{_EDGE}$", "")


def canonical(c: Column) -> Column:
    """Codes that scanners may take for each other have one canonical form."""
    return F.translate(c, R.CONFUSED, R.READ_AS)


def count_of(c: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{chars}]", ""))


def is_pack_size(c: Column) -> Column:
    return reduce(or_, [c.rlike(p) for p in R.PACK_SIZE])


def is_code_shaped(c: Column, least: int = 5) -> Column:
    return (F.length(c) >= least) & ~c.rlike(r"^\d+$") & c.rlike(r"\d")


def is_strong_code(c: Column) -> Column:
    return (F.length(c) >= 7) & (count_of(c, "0-9") >= 2) & (count_of(c, r"\p{L}") >= 2) & ~is_pack_size(c)


def price_value(c: Column) -> Column:
    """The number of a price token, else null."""
    whole, cents = F.replace(F.regexp_extract(c, R.PRICE_TOKEN, 1), F.lit(","), F.lit("")), F.regexp_extract(c, R.PRICE_TOKEN, 2)
    return F.when(whole != "", F.concat(whole, F.lit("."), F.when(cents == "", "0").otherwise(cents)).try_cast("double"))


def percents(c: Column) -> Column:
    return F.transform(F.regexp_extract_all(c, F.lit(R.PERCENT), 1), lambda x: x.cast("int"))


def find_prices(c: Column, decimals: int = 2) -> Column:
    """All price-shaped substrings that are no percentages."""
    pattern = rf"(?<![\w.])((?:\d{{1,3}}(?:,\d{{3}})+|\d+)(?:\.\d{{1,{decimals}}})?)(?![\w])(?!\s*%)"
    return F.transform(F.regexp_extract_all(c, F.lit(pattern), 1), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("double"))


def capacity(c: Column) -> Column:
    """'8/5 kg', '550 L gross', or null."""
    number, unit = F.regexp_extract(c, R.CAPACITY, 1), F.upper(F.regexp_extract(c, R.CAPACITY, 2))
    low = F.lower(c)
    litres = F.concat(F.lit(" L"), F.when(low.contains("net"), " net").when(low.contains("gross"), " gross").otherwise(""))
    return F.when(number != "", F.concat(number, F.when(unit.startswith("KG"), " kg").otherwise(litres)))


def capacity_unit(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.contains("kg"), "kg").when(low.contains("l"), "L").otherwise("")


def file_tokens(c: Column) -> Column:
    """Words of a file name without its extension, in lower case."""
    stem = F.lower(F.regexp_replace(c, r"\.[A-Za-z0-9]+$", ""))
    return F.filter(F.split(stem, "[^A-Za-z0-9]+"), lambda t: t != "")


def title_case(c: Column) -> Column:
    """Each run of letters begins with a capital."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1), lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def brand_display(c: Column) -> Column:
    return F.when(F.length(c) <= 3, c).otherwise(title_case(c))


def fixed(c: Column, places: int) -> Column:
    """Half-up decimal text, empty for null."""
    return F.coalesce(F.round(c.cast("decimal(30,10)"), places).cast(f"decimal(24,{places})").cast("string"), F.lit(""))


def mapped(c: Column, table: dict[str, str]) -> Column:
    """table[c], or c itself."""
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(pairs[c], c)


def flag(code: str, *parts) -> Column:
    """A typed flag: what is wrong, and its text."""
    return F.struct(F.lit(code).alias("code"), F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]).alias("detail"))


def flags(*items: tuple[Column, Column]) -> Column:
    """The flags whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(condition, f) for condition, f in items]))


def flag_text(c: Column) -> Column:
    return F.array_join(F.filter(F.transform(c, lambda f: f["detail"]), lambda d: d != ""), "; ")
