"""Mixing sources to target weights by Poisson replication, in DataFrame operations.

A document of source s is repeated Poisson(rate_s) times. The rate brings the
expected characters of each source to its share of the total. The count comes
from inverting the Poisson distribution at a hash of seed and id (of the text
where there is no id), so it depends on nothing else; replicas are dealt to
partitions by a hash and sorted by it, which is a global shuffle. A document of
very many copies is first cut into runs of copies, which are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagwright.llm.common import broadcast_up_to, keep, unit_hash

#: Sources of a mixture are broadcast up to this many, else joined by a shuffle.
BROADCAST_SOURCES = 20_000
#: Rates above this are drawn as a sum of independent parts, which bounds a table of the inverse.
PART_RATE = 64.0
#: Bits of a shuffle key, and of them those by which replicas are dealt to partitions.
KEY_BITS, DEALT_BITS = 52, 16
#: Copies of a document that one task makes; more are made by several.
RUN = 4096


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0) -> DataFrame:
    """source, mass, rate. weights: shares of the sources named; others count 1.0 each.

    epochs: expected size of the mixture in sizes of docs. A source without
    characters has rate 1.
    """
    weights = dict(weights or {})
    masses = keep(docs.groupBy("source").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("mass")), "mix-masses")
    given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else None
    weighed = masses.withColumn("weight", F.coalesce(given[F.col("source")], F.lit(1.0)) if given is not None else F.lit(1.0))
    total = weighed.agg(F.sum("mass").alias("all_mass"), F.sum("weight").alias("all_weight"))
    share = F.col("weight") / F.col("all_weight")
    return (
        weighed.join(F.broadcast(total))  # one row
        .select("source", "mass", F.when(F.col("mass") > 0, share * F.col("all_mass") * epochs / F.col("mass")).otherwise(1.0).alias("rate"))
    )


def cumulative(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until it is 1 but for rounding."""
    last = (rate + 12 * F.sqrt(rate) + 24).cast("int")
    terms = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all")),
        lambda a, k: F.struct(
            (a["p"] * rate / k).alias("p"), (a["c"] + a["p"] * rate / k).alias("c"), F.concat(a["all"], F.array(a["c"] + a["p"] * rate / k)).alias("all")
        ),
        lambda a: a["all"],
    )
    return F.when(rate > 0, terms).otherwise(F.array(F.lit(1.0)))


def _copies(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows n times each, with copy. Rows of more than RUN copies, where a rate allows for any, are dealt to tasks in runs."""
    to = lambda n: F.sequence(F.lit(0), n - 1)
    if table.where(F.col("rate") > RUN / 2).isEmpty():
        return rows.withColumn("copy", F.explode(to(F.col("n"))))
    runs = rows.where(F.col("n") > RUN).withColumn("run", F.explode(to(F.ceil(F.col("n") / RUN).cast("int"))))
    runs = runs.withColumn("spot", F.xxhash64("run", "__row.doc_id", "__row.text")).repartition("spot").drop("spot")
    first = F.col("run") * RUN
    runs = runs.withColumn("copy", F.explode(F.sequence(first, F.least(F.col("n"), first + RUN) - 1))).drop("run")
    return rows.where(F.col("n") <= RUN).withColumn("copy", F.explode(to(F.col("n")))).unionByName(runs)


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, epochs: float = 1.0, seed: int = 0) -> DataFrame:
    """docs repeated and shuffled, with copy (0, 1, ...), rate and shuffle_key (columns of these names are replaced).

    Null texts have no characters; null is a source like any other. Rows that
    repeat an id get the same count. Rows of a null id are drawn by their text,
    so that equal texts among them get the same count; those of a null text are
    drawn together. An empty table gives an empty mixture. The shuffled order is
    that of shuffle_key.
    """
    docs = docs.drop("copy", "rate", "shuffle_key")
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int")
    table = keep(
        rates(docs, weights, epochs).select(F.col("source").alias("of_source"), "rate", parts.alias("parts"), cumulative(F.col("rate") / parts).alias("below")),
        "mix-rates",
    )
    rows = docs.select(F.struct(*docs.columns).alias("__row"))
    rows = rows.join(broadcast_up_to(table, BROADCAST_SOURCES), F.col("__row.source").eqNullSafe(F.col("of_source")))
    unnamed = F.concat(F.lit("text:"), F.md5(F.coalesce("__row.text", F.lit(""))))
    doc_id = F.coalesce(F.col("__row.doc_id").cast("string"), unnamed)

    def drawn(part: Column) -> Column:
        u = (unit_hash(F.lit(f"{seed}"), part.cast("string"), doc_id) + 0.5) / F.lit(2.0**KEY_BITS)
        return F.size(F.filter("below", lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda n, part: n + drawn(part))
    rows = _copies(rows.withColumn("n", count).where("n > 0"), table)
    rows = rows.withColumn("shuffle_key", unit_hash(F.lit(f"{seed}"), F.lit("order"), F.col("copy").cast("string"), doc_id))
    rows = rows.select(*[F.col(f"__row.`{c}`") for c in docs.columns], "copy", "rate", "shuffle_key")
    return rows.repartition(F.shiftright("shuffle_key", KEY_BITS - DEALT_BITS)).sortWithinPartitions("shuffle_key")


ORACLE = f"""
WITH RECURSIVE m AS (SELECT source, sum(length(coalesce(text, ''))) AS mass FROM documents GROUP BY 1),
r AS (SELECT source, mass, CASE WHEN mass > 0 THEN 1.0::DOUBLE / (SELECT count(*)::DOUBLE FROM m) * (SELECT sum(mass)::DOUBLE FROM m) / mass ELSE 1.0 END AS rate FROM m),
c AS (SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS below FROM r
      UNION ALL SELECT source, rate, k + 1, p * rate / (k + 1), below + p * rate / (k + 1) FROM c WHERE k < CAST(floor(rate + 12 * sqrt(rate) + 24) AS INTEGER)),
a AS (SELECT source, rate, list(below ORDER BY k) AS belows FROM c GROUP BY 1, 2),
d AS (SELECT doc_id, documents.source, text, rate, belows, (('0x' || substr(md5('0|1|' || doc_id), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
      FROM documents JOIN a ON documents.source IS NOT DISTINCT FROM a.source),
n AS (SELECT *, len(list_filter(belows, lambda b: b <= u)) AS n FROM d),
x AS (SELECT doc_id, source, text, rate, unnest(range(n)) AS copy FROM n)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, round(rate, 6) AS rate,
       ('0x' || substr(md5('0|order|' || copy || '|' || doc_id), 1, 13))::BIGINT AS shuffle_key, md5(text) AS text_md5
FROM x
"""
